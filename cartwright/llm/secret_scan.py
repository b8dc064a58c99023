"""Secrets in texts: base patterns, and encoded candidates that are reported only after their structure has been parsed.

Base kinds are `assign` (a name such as password or api_key with a value), `access` (access key ids) and `hex` (long runs of
lower-case hex digits). Candidates in base64 (either alphabet, armoured or bare) and hex are decoded and confirmed as

* `key`: a private key. DER must nest exactly, every length minimal and within its parent, as PKCS#1, SEC1, DSA, PKCS#8 (the inner
  key is parsed by its algorithm) or encrypted PKCS#8; the OpenSSH container's counted strings must fill it;
* `signed`: a token of three base64url parts whose header and payload are JSON objects, the header naming its `alg`;
* `wrapped`: printable text that itself holds an assign or access match or one of the above, through at most LEVELS codings.

Public keys and certificates have other structures and are not reported. Offsets are code points, ends are exclusive.
"""

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa

from cartwright.llm import frames

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
#: Runs are maximal, so asking for the length within the pattern drops the same matches as asking afterwards.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGNED_LEAST = 6
KINDS = ("assign", "access", "hex", "key", "signed", "wrapped")
LEVELS = 3

_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]{6,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{16,})")
_BEGIN, _END = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----"), "-----END "
_HEX_DIGITS = re.compile(r"[0-9A-Fa-f]+")
_PRINTABLE = bytes([9, 10, 13, *range(32, 127)])
_INTEGER, _BITS, _OCTETS, _OID, _SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30

# DER object identifiers of key algorithms and of password-based encryption.
_RSA_OID = bytes.fromhex("2a864886f70d010101")
_EC_OID = bytes.fromhex("2a8648ce3d0201")
_EDWARDS_OIDS = (bytes.fromhex("2b656e"), bytes.fromhex("2b656f"), bytes.fromhex("2b6570"), bytes.fromhex("2b6571"))
_PASSWORD_OIDS = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def base_matches(text):
    """(kind, start, end) of the base patterns, in order of kinds."""
    found = []
    if ":" in text or "=" in text:
        for match in ASSIGN.finditer(text):
            if match.end(2) - match.start(2) >= ASSIGNED_LEAST:
                found.append(("assign", *match.span()))
    if "AKIA" in text:
        found.extend(("access", *match.span()) for match in ACCESS.finditer(text))
    found.extend(("hex", *match.span()) for match in HEX.finditer(text))
    return found


# ---- key encodings -------------------------------------------------------------------------------------------------


def _element(data, at, end):
    """(tag, start, stop) of the DER element at `at`, or None if its length is malformed, not minimal or beyond `end`."""
    if at + 2 > end:
        return None
    tag, length, start = data[at], data[at + 1], at + 2
    if length >= 0x80:
        width = length & 0x7F
        if not 1 <= width <= 8 or start + width > end or data[start] == 0:
            return None
        length = int.from_bytes(data[start : start + width], "big")
        if length < 0x80:
            return None
        start += width
    return (tag, start, start + length) if start + length <= end else None


def _elements(data, start, end, most=16):
    """The elements that fill data[start:end] exactly, or None; key structures have few members."""
    found = []
    while start < end:
        element = _element(data, start, end)
        if element is None or len(found) == most:
            return None
        found.append(element)
        start = element[2]
    return found


def _members(data, start, end):
    """The members of the one SEQUENCE that fills the range, else None."""
    outer = _element(data, start, end)
    return _elements(data, outer[1], outer[2]) if outer and outer[0] == _SEQUENCE and outer[2] == end else None


def _number(data, element):
    return int.from_bytes(data[element[1] : element[2]], "big", signed=True)


def _content(data, element):
    return data[element[1] : element[2]]


def _is_integers_key(data, members):
    """PKCS#1 (version, modulus and seven more) or DSA (version 0 and five more)."""
    if len(members) not in (6, 9) or any(tag != _INTEGER or start == stop for tag, start, stop in members):
        return False
    version, *numbers = (_number(data, member) for member in members)
    return version == 0 and min(numbers) > 0 and numbers[0].bit_length() >= 256


def _is_curve_key(data, members):
    """SEC1: version 1, the private number, then tagged parameters and public point."""
    if len(members) < 2 or members[0][0] != _INTEGER or _number(data, members[0]) != 1 or members[1][0] != _OCTETS:
        return False
    return 16 <= members[1][2] - members[1][1] <= 72 and all(
        tag in (0xA0, 0xA1) and _elements(data, start, stop) for tag, start, stop in members[2:]
    )


def _is_wrapped_key(data, members):
    """PKCS#8: version, algorithm, and the octets of a key of that algorithm."""
    if len(members) < 3 or [member[0] for member in members[:3]] != [_INTEGER, _SEQUENCE, _OCTETS]:
        return False
    algorithm = _elements(data, *members[1][1:])
    if not algorithm or algorithm[0][0] != _OID or _number(data, members[0]) not in (0, 1):
        return False
    name, (_, start, stop) = _content(data, algorithm[0]), members[2]
    inner = _members(data, start, stop)
    if name == _RSA_OID:
        return bool(inner) and len(inner) == 9 and _is_integers_key(data, inner)
    if name == _EC_OID:
        return bool(inner) and _is_curve_key(data, inner)
    whole = _element(data, start, stop)
    if name in _EDWARDS_OIDS:
        return bool(whole) and whole[0] == _OCTETS and whole[2] == stop and whole[2] - whole[1] in (32, 56, 57)
    return bool(whole) and whole[2] == stop


def _is_encrypted_key(data, members):
    if [member[0] for member in members] != [_SEQUENCE, _OCTETS]:
        return False
    scheme = _elements(data, *members[0][1:])
    size = members[1][2] - members[1][1]
    return bool(scheme) and scheme[0][0] == _OID and _content(data, scheme[0]).startswith(_PASSWORD_OIDS) and size >= 16 and size % 8 == 0


def _counted(data, at):
    """(string, next place) of a string behind its length in four bytes, or None."""
    stop = at + 4 + int.from_bytes(data[at : at + 4], "big")
    return (data[at + 4 : stop], stop) if at + 4 <= stop <= len(data) and at + 4 <= len(data) else None


def _is_openssh_key(data):
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return False
    at, strings = len(magic), []
    for _ in range(3):
        found = _counted(data, at)
        if not found:
            return False
        strings.append(found[0])
        at = found[1]
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 64:
        return False
    for _ in range(keys + 1):
        found = _counted(data, at)
        if not found or not found[0]:
            return False
        at = found[1]
    private = found[0]
    return at == len(data) and (strings[0] != b"none" or (len(private) % 8 == 0 and private[:4] == private[4:8]))


def is_private_key(data):
    if _is_openssh_key(data):
        return True
    members = _members(data, 0, len(data)) if data[:1] == b"\x30" else None
    return bool(members) and (
        _is_integers_key(data, members) or _is_curve_key(data, members) or _is_wrapped_key(data, members)
        or _is_encrypted_key(data, members)
    )


# ---- candidates ----------------------------------------------------------------------------------------------------


def decoded(run):
    """The bytes of a base64 run in one of the two alphabets, or None."""
    body = run.rstrip("=")
    padding = len(run) - len(body)
    if len(body) % 4 == 1 or (padding and (len(body) + padding) % 4):
        return None
    if "-" in body or "_" in body:
        if "+" in body or "/" in body:
            return None
        body = body.replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part):
    raw = decoded(part)
    try:
        value = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _armoured(text):
    """(start, end) of armoured private keys whose body parses. A body ends at the next row of dashes, so this is linear."""
    found, at = [], 0
    while match := _BEGIN.search(text, at):
        at = match.end()
        close = text.find("-----", at)
        label = f"{_END}{match.group(1)}-----"
        if close < 0:
            break
        if not text.startswith(label, close):
            continue
        body = re.sub(r"\\[nr]|[\s,'\"]", "\n", text[at:close])
        lines = [line for line in body.split("\n") if line]
        if "ENCRYPTED" in lines:
            # Headers of the older encrypted form: the body is cipher text, confirmed by its vector and whole blocks.
            lines = lines[lines.index("ENCRYPTED") + 1 :]
            vector = bool(lines) and lines[:1] == ["DEK-Info:"] and len(lines) > 2 and _HEX_DIGITS.fullmatch(lines[2])
            data = decoded("".join(lines[3:])) if vector else None
            confirmed = bool(data) and len(data) % 8 == 0
        else:
            data = decoded("".join(lines))
            confirmed = bool(data) and is_private_key(data)
        if confirmed:
            at = close + len(label)
            found.append((match.start(), at))
    return found


def _signed(text):
    """(start, end) of signed tokens; after a false start the search goes on behind its first part."""
    found, at = [], 0
    while match := _TOKEN.search(text, at):
        header, payload = _json_object(match.group(1)), None
        if header and isinstance(header.get("alg"), str):
            payload = _json_object(match.group(2))
        if payload is not None and decoded(match.group(3)):
            found.append(match.span())
            at = match.end()
        else:
            at = match.end(1)
    return found


def _is_wrapping(data, level):
    """Whether decoded bytes are printable text with a secret in it."""
    if not data.isascii() or data.translate(None, _PRINTABLE):
        return False
    text = data.decode("ascii")
    return any(kind != "hex" for kind, _, _ in base_matches(text)) or bool(confirmed_matches(text, level + 1))


def confirmed_matches(text, level=1):
    """(kind, start, end) of encoded secrets whose structure parses; candidates inside a reported one are not reported again."""
    found = [("key", *span) for span in _armoured(text)] if "-----BEGIN " in text else []
    if ".e" in text or "ey" in text or "ew" in text:
        found.extend(("signed", *span) for span in _signed(text))
    taken = sorted((start, end) for _, start, end in found)
    place = 0
    for match in _RUN.finditer(text):
        start, end = match.span()
        while place < len(taken) and taken[place][1] <= start:
            place += 1
        if place < len(taken) and taken[place][0] < end:
            continue
        run = match.group()
        forms = [decoded(run)]
        if len(run) % 2 == 0 and _HEX_DIGITS.fullmatch(run):
            forms.append(bytes.fromhex(run))
        for data in filter(None, forms):
            if is_private_key(data):
                found.append(("key", start, end))
                break
            if level < LEVELS and _is_wrapping(data, level):
                found.append(("wrapped", start, end))
                break
    return found


def joined(matches):
    ordered = sorted(matches, key=lambda match: (match[1], KINDS.index(match[0]), match[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def scan(docs):
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null and empty texts have no spans, an empty string and its digest. Repeated rows and null ids are scanned like any other.
    An empty table gives no rows.
    """

    def run(batches):
        for batch in frames.bounded(batches):
            counts, digests, spans = {kind: [] for kind in KINDS[:3]}, [], []
            for text in frames.texts(batch.column(1)):
                base = base_matches(text)
                for kind, column in counts.items():
                    column.append(sum(match[0] == kind for match in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + confirmed_matches(text)))
            yield frames.record(
                {
                    "doc_id": batch.column(0), "n_assign": pa.array(counts["assign"], pa.int64()),
                    "n_access": pa.array(counts["access"], pa.int64()), "n_hex": pa.array(counts["hex"], pa.int64()),
                    "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string()),
                }
            )

    schema = f"doc_id {frames.id_type(docs)}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return frames.map_arrow(docs.select("doc_id", "text"), run, schema)
