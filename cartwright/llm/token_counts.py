"""Token counts of whole documents as a tokenizer library gives them.

Huge documents are encoded in overlapping chunks with offsets, so that no call of the library holds more than a chunk, and the
counts are spliced in the overlap. A splice point is proven when it is a token start in both encodings and the text has a
space there that a visible character follows: no token of a byte-level BPE crosses such a place, so both encodings agree
with the encoding of the whole text from there on. If an overlap holds no such place, it is doubled; when it has grown over
the whole chunk, the chunk is encoded together with the next one.
"""

from functools import lru_cache

import numpy as np

from cartwright.llm import frames
from cartwright.llm.encoding import BOUNDARY, encoder_for

HUGE = 32_768
CHUNK = 16_384
OVERLAP = 256


def _starts(library, text):
    return np.fromiter((start for start, _ in library.encode(text, add_special_tokens=False).offsets), dtype=np.int64)


def _splice(text, low, high, left, right):
    """The proven common token start nearest to the middle of the overlap, or None."""
    places = np.fromiter((match.start() for match in BOUNDARY.finditer(text, low, high + 1)), dtype=np.int64)
    places = places[(places > low) & (places < high)]
    common = np.intersect1d(np.intersect1d(places, left), right)
    return int(common[np.abs(common - (low + high) // 2).argmin()]) if len(common) else None


def count_huge(library, text, chunk=CHUNK, overlap=OVERLAP):
    """Tokens of a long text by spliced chunks; equals the library's count of the whole text."""
    total, begin, end = 0, 0, min(chunk, len(text))
    starts = _starts(library, text[:end])
    while end < len(text):
        width = overlap
        while True:
            low = max(begin, end - width)
            if low == begin:
                # No proven place within the chunk: encode it together with the next one.
                end = min(len(text), end + max(chunk, end - begin))
                starts = begin + _starts(library, text[begin:end])
                break
            right_end = min(len(text), low + max(chunk, 2 * width))
            right = low + _starts(library, text[low:right_end])
            place = _splice(text, low, end, starts, right)
            if place is None:
                width *= 2
                continue
            total += int(np.count_nonzero(starts < place))
            begin, end, starts = place, right_end, right[right >= place]
            break
    return total + len(starts)


@lru_cache(maxsize=2)
def _sentence_pieces(path):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _counter(path, huge, chunk, overlap):
    if path.endswith(".model"):
        pieces = _sentence_pieces(path)
        return lambda text: len(pieces.encode(text, num_threads=1))
    encoder = encoder_for(path)

    def count(text):
        if encoder.cuttable and len(text) > huge:
            return count_huge(encoder.library, text, chunk, overlap)
        return encoder.count(text)

    return count


def count_tokens(docs, path, limit=512, huge=HUGE, chunk=CHUNK, overlap=OVERLAP):
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) per document.

    Null text counts as empty (0 tokens). Special strings inside texts are handled as the library does by default. Rows are
    counted one by one: repeated rows and null ids give one row each, an empty table gives none, other columns are not read.
    """
    column = frames.id_type(docs)

    def run(batches):
        count = _counter(path, huge, chunk, overlap)
        for batch in frames.bounded(batches):
            values = frames.texts(batch.column(1))
            counts = [count(text) for text in values]
            yield frames.record(
                {
                    "doc_id": batch.column(0),
                    "n_bytes": [len(text.encode()) for text in values],
                    "n_tokens": counts,
                    "over_limit": [n > limit for n in counts],
                }
            )

    schema = f"doc_id {column}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return frames.map_arrow(docs.select("doc_id", "text"), run, schema)
