"""Token ids as the tokenizers library gives them, with the library's answers remembered for words that return.

A byte-level BPE whose pattern is the usual one (an optional space in front of letters, digits or other signs) never
merges across a space that a visible character follows: no alternative of the pattern holds a space anywhere but first. Text
is therefore cut there, and the concatenated ids of the cuts are the ids of the text. Special strings hold no space and are
found inside cuts as they are in the whole. Other tokenizer files get whole texts.
"""

import json
import os
import re
import sys
from array import array
from functools import lru_cache
from operator import attrgetter
from struct import pack

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

#: A space before a sign that every Unicode version counts as visible.
BOUNDARY = re.compile(r" (?=[!-~\w])")
_OTHER_SPACE = re.compile(r" (?![!-~\w])")
_BREAK = re.compile(r"(?<=[!-~\w])\n(?=[!-~\w])")
#: Letters up to here are letters in every Unicode version.
_LAST_OLD_LETTER = "ɏ"
#: For Arrow: a space that no ASCII sign and no old Latin letter follows. Texts that hold one are cut by BOUNDARY.
_ODD_SPACE = " ([^!-~À-ÖØ-öø-ɏ]|$)"
#: Signs that end a unit as a match of their own: neither letters, digits nor white space, and no letter follows.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MEMORY = 120_000
_LONGEST_KEPT = 64
_token_id = attrgetter("id")


def default_path(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters():
    """The printable stand-in for each byte in byte-level vocabularies: itself where printable, else 256 onwards in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (byte for byte in range(256) if byte not in printable)
    table = {byte: chr(byte) for byte in printable}
    table.update({byte: chr(256 + i) for i, byte in enumerate(others)})
    return table


class _Memory(dict):
    """Ids of units by their text without the leading `lead`. The older half is kept aside and given up in turn."""

    def __init__(self, answer, lead):
        super().__init__()
        self.answer, self.lead, self.older = answer, lead, {}

    def __missing__(self, word):
        ids = self.older.get(word)
        if ids is None:
            ids = self.answer(self.lead + word)
        if len(word) <= _LONGEST_KEPT and (len(word) < 2 or "\n" not in word):
            if len(self) >= MEMORY:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class LibraryEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        splitter = described.get("pre_tokenizer") or {}
        self.specials = [token["content"] for token in described.get("added_tokens") or []]
        self.cuttable = (
            splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space")
            and not described.get("normalizer")
            and all(not re.search(r"\s", special) for special in self.specials)
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in described.get("added_tokens") or [])
        )
        self._model = self.library.model
        self._letters = _byte_letters()
        self._space = self._letters[32]
        self._alphabetic_special = any(special.isalpha() for special in self.specials)
        self._special = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)").search
        self._inner, self._first = _Memory(self._unit, " "), _Memory(self._unit, "")

    def _library_ids(self, text):
        return self.library.encode(text, add_special_tokens=False).ids

    def _word(self, text):
        """Ids of letters with or without a space before them: one match of the pattern, handed to the model directly."""
        if text.isascii():
            letters = self._space + text[1:] if text[0] == " " else text
        else:
            letters = text.encode().decode("latin-1").translate(self._letters)
        ids = array("I", map(_token_id, self._model.tokenize(letters)))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _unit(self, text):
        stem = text.rstrip(_SIGNS)
        word = stem[1:] if stem[:1] == " " else stem
        short = word.isalpha() and len(word) <= _LONGEST_KEPT and (word.isascii() or max(word) <= _LAST_OLD_LETTER)
        if short and len(stem) == len(text) and not self._alphabetic_special:
            return self._word(text)
        if short and not self._special(text):
            if len(stem) == len(text):
                return self._word(text)
            known = self._inner if stem[:1] == " " else self._first
            return known[word] + self._first[text[len(stem) :]]
        if "\n" in text and not self._special("\n"):
            # A line break between visible signs is a match of its own.
            lead, *lines = _BREAK.split(text)
            if lines:
                known = self._inner if lead[:1] == " " else self._first
                head = known[lead[1:] if lead[:1] == " " else lead]
                return head + b"".join(self._first["\n"] + self._first[line] for line in lines)
        ids = self._library_ids(text)
        return pack(f"<{len(ids)}I", *ids)

    def ids(self, text):
        """The ids of a text, four bytes each."""
        if not self.cuttable:
            return np.asarray(self._library_ids(text), dtype="<u4").tobytes()
        if not text:
            return b""
        first, *words = BOUNDARY.split(text) if _OTHER_SPACE.search(text) else text.split(" ")
        return self._first[first] + b"".join(map(self._inner.__getitem__, words))

    def ids_of_column(self, column):
        """The ids of each text of a string column, as arrays in its order; null counts as empty.

        Arrow cuts the texts and numbers the distinct units, so that each is looked up once per call, and numpy lays out the
        ids. Texts with unusual spaces are worked off one by one.
        """
        column = pc.fill_null(column.cast(pa.string()), "")
        odd = pc.match_substring_regex(column, _ODD_SPACE) if self.cuttable else pa.repeat(True, len(column))
        found = np.empty(len(column), object)
        for place, text in zip(np.flatnonzero(odd).tolist(), column.filter(odd).to_pylist(), strict=True):
            found[place] = np.frombuffer(self.ids(text), "<u4")
        usual = pc.split_pattern(column.filter(pc.invert(odd)), " ")
        if not len(usual):
            return found
        bounds = usual.offsets.to_numpy()
        units = usual.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        unit, names = units.indices.to_numpy().astype(np.int64), units.dictionary.to_numpy(zero_copy_only=False).tolist()
        heads = [names[i] for i in unit[bounds[:-1]].tolist()]
        unit[bounds[:-1]] = len(names) + np.arange(len(heads))
        inside = np.bincount(unit, minlength=len(names))[: len(names)] > 0
        known = [self._inner[name] if used else b"" for name, used in zip(names, inside.tolist(), strict=True)]
        known += map(self._first.__getitem__, heads)
        pool, sizes = np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) // 4
        counts = sizes[unit]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = pool[np.repeat((np.cumsum(sizes) - sizes)[unit] - ends[:-1], counts) + np.arange(ends[-1])]
        cuts = ends[bounds].tolist()
        for place, start, stop in zip(np.flatnonzero(pc.invert(odd)).tolist(), cuts[:-1], cuts[1:], strict=True):
            found[place] = ids[start:stop]
        return found

    def count(self, text):
        return len(self.ids(text)) // 4


@lru_cache(maxsize=4)
def encoder_for(path):
    """One encoder per file and Python worker."""
    return LibraryEncoder(path)


@lru_cache(maxsize=4)
def plain_library_for(path):
    """A tokenizer of its own per file and Python worker, to which special strings are ordinary text."""
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return library
