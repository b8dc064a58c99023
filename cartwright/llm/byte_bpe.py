"""Byte-level BPE encoding and decoding by the tiktoken library with a local rank file.

Long texts are first cut at places that are match ends of the splitting pattern whatever surrounds them: before a space that a
visible character follows, and around long runs of white space. Each cut is encoded alone, so the library's pattern matcher
never walks a text of unbounded length.
"""

import base64
import hashlib
import re
from functools import lru_cache

import pyarrow as pa

from cartwright.llm import frames
from cartwright.llm.encoding import BOUNDARY

LONG = 65_536
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_RUN = re.compile(rf"[{_SPACE}]{{1000,}}")


@lru_cache(maxsize=2)
def codec(path, pattern):
    """The library's encoding for a rank file; one per Python worker."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _cuts(text, length):
    """Pieces of about `length` characters whose ends are match ends in the whole text."""
    begin = 0
    while len(text) - begin > length:
        found = BOUNDARY.search(text, begin + length)
        if not found:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


def encode(encoding, text, long=LONG):
    """Ids of a text, as encode_ordinary gives them."""
    if len(text) <= long:
        return encoding.encode_ordinary(text)
    ids, begin = [], 0
    for run in _LONG_RUN.finditer(text):
        # The pattern takes a run as one match, without its last character if something visible follows.
        end = run.end() if run.end() == len(text) else run.end() - 1
        for cut in _cuts(text[begin : run.start()], long // 4):
            ids.extend(encoding.encode_ordinary(cut))
        ids.extend(encoding._encode_single_piece(text[run.start() : end]))
        begin = end
    for cut in _cuts(text[begin:], long // 4):
        ids.extend(encoding.encode_ordinary(cut))
    return ids


def decode(encoding, ids):
    """The raw bytes of the ids."""
    return encoding.decode_bytes(ids)


def encode_documents(docs, path, pattern, long=LONG):
    """doc_id, ids (array) and text length in bytes per document; the general form. Null text gives an empty list."""

    def run(batches):
        encoding = codec(path, pattern)
        for batch in frames.bounded(batches):
            ids = [encode(encoding, text, long) for text in frames.texts(batch.column(1))]
            yield frames.record({"doc_id": batch.column(0), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return frames.map_arrow(docs.select("doc_id", "text"), run, f"doc_id {frames.id_type(docs)}, ids array<int>")


def decode_documents(encoded, path, pattern):
    """doc_id and the decoded bytes of each list of ids."""

    def run(batches):
        encoding = codec(path, pattern)
        for batch in frames.bounded(batches):
            decoded = [decode(encoding, ids or []) for ids in batch.column(1).to_pylist()]
            yield frames.record({"doc_id": batch.column(0), "bytes": pa.array(decoded, pa.binary())})

    return frames.map_arrow(encoded.select("doc_id", "ids"), run, f"doc_id {frames.id_type(encoded)}, bytes binary")


def digest_documents(docs, path, pattern, long=LONG):
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: each text encoded, the ids decoded again, both hashed in one pass.

    Null text is empty text: no ids, the digests of nothing. One row per input row, repeated rows and null ids included.
    """

    def run(batches):
        encoding = codec(path, pattern)
        names = [str(i) for i in range(encoding.max_token_value + 1)]
        for batch in frames.bounded(batches):
            counts, of_ids, of_bytes = [], [], []
            for text in frames.texts(batch.column(1)):
                ids = encode(encoding, text, long)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(decode(encoding, ids)).hexdigest())
            yield frames.record(
                {"doc_id": batch.column(0), "n_tokens": counts, "ids_sha256": of_ids, "decoded_sha256": of_bytes}
            )

    schema = f"doc_id {frames.id_type(docs)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return frames.map_arrow(docs.select("doc_id", "text"), run, schema)
