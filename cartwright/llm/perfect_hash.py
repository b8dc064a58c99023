"""Minimal perfect hashes of bounded sets of byte strings, by hash and displace, with the keys stored for verification."""

import numpy as np
import xxhash

#: Mean keys per bucket: at three, buckets of several keys fill about 85 of 100 slots and the last pairs still find room quickly.
BUCKET_KEYS = 3
_TRIES = 64
_MOST_TRIES = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def hashes(keys, salt):
    return np.fromiter((xxhash.xxh3_64_intdigest(key, seed=salt) for key in keys), np.uint64, count=len(keys))


def _places(hashed, displacement, size):
    """Slots of hashes under displacements, as integers below size."""
    mixed = hashed + displacement.astype(np.uint64) * _STEP
    mixed = (mixed ^ (mixed >> _SHIFT)) * _MIX
    mixed = (mixed ^ (mixed >> _SHIFT)) * _MIX
    return ((mixed ^ (mixed >> _SHIFT)) % np.uint64(size)).astype(np.int64)


def _buckets(hashed, count):
    return ((hashed >> np.uint64(40)) % np.uint64(count)).astype(np.int64)


def _displace(hashed, size):
    """Displacement per bucket, or None if some bucket finds no room. Buckets of one key hold their slot as -1 - slot."""
    count = size // BUCKET_KEYS + 1
    bucket = _buckets(hashed, count)
    order = np.argsort(bucket, kind="stable")
    begins = np.searchsorted(bucket[order], np.arange(count + 1))
    lengths = np.diff(begins)
    free = np.ones(size, bool)
    found = np.zeros(count, np.int32)
    for number in np.argsort(-lengths, kind="stable"):
        length = lengths[number]
        if length < 2:
            break
        members = hashed[order[begins[number] : begins[number + 1]]]
        for first in range(0, _MOST_TRIES, _TRIES):
            tried = np.arange(first, first + _TRIES)
            slots = _places(members[None, :], tried[:, None], size)
            apart = (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
            fits = np.flatnonzero(apart & free[slots].all(axis=1))
            if len(fits):
                found[number] = tried[fits[0]]
                free[slots[fits[0]]] = False
                break
        else:
            return None
    singles = np.flatnonzero(lengths == 1)
    found[singles] = -1 - np.flatnonzero(free)[: len(singles)]
    return found


def build(keys):
    """(salt, displacements, slot of each key) for distinct byte strings. Salts are tried until the hash fits."""
    size = len(keys)
    for salt in range(1 << 10):
        hashed = hashes(keys, salt)
        if len(np.unique(hashed)) < size:
            continue
        displacements = _displace(hashed, size)
        if displacements is not None:
            return salt, displacements, look_up(hashed, displacements, size)
    raise ValueError("the keys are not distinct")


def look_up(hashed, displacements, size):
    """Slots of hashes taken with the table's salt; a string that is no key gets the slot of some key."""
    displacement = displacements[_buckets(hashed, len(displacements))]
    alone = displacement < 0
    return np.where(alone, -1 - displacement.astype(np.int64), _places(hashed, np.where(alone, 0, displacement), size))
