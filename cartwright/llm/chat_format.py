r"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one text, encoded once with character offsets, and the sorted spans of its assistant turns are
intersected with the token spans by binary search. The template is, per turn,

    ### role: text</turn>\n

In texts a backslash stands before every backslash, before `###` and before `</turn>`; in roles before colons as well. Reading
back drops one backslash before any character, so the escape is reversible whatever the texts hold.
"""

import hashlib
import re
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cartwright.llm import frames
from cartwright.llm.encoding import plain_library_for

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)


def escape(text, pattern=_CONTROL):
    return pattern.sub(lambda match: "\\" + match.group(), text)


def unescape(text):
    return _ESCAPED.sub(r"\1", text)


def render(turns):
    """The formatted text of (role, text) pairs."""
    return "".join(OPEN + escape(role, _ROLE_CONTROL) + MIDDLE + escape(text) + CLOSE for role, text in turns)


def parse(formatted):
    """Spans in a formatted text: (role, begin, end) per turn; begin and end enclose the escaped text."""
    spans, at = [], 0
    while at < len(formatted):
        match = _TURN.match(formatted, at)
        if not match:
            raise ValueError(f"no turn at character {at}")
        spans.append((unescape(match.group(1)), match.start(2), match.end(2)))
        at = match.end()
    return spans


def mask_tokens(spans, starts, ends):
    """Per span (begin, end): the range of tokens that overlap it, by binary search in the sorted token offsets."""
    begins = np.fromiter((begin for begin, _ in spans), np.int64, len(spans))
    stops = np.fromiter((end for _, end in spans), np.int64, len(spans))
    first = np.searchsorted(ends, begins, side="right")
    last = np.searchsorted(starts, stops, side="left")
    return first, np.where(stops > begins, np.maximum(first, last), first)


def masked_text(formatted, spans, starts, ends):
    """The text under the loss mask: each span cut to the tokens that cover it."""
    first, last = mask_tokens(spans, starts, ends)
    pieces = []
    for (begin, end), low, high in zip(spans, first.tolist(), last.tolist(), strict=True):
        if high > low:
            pieces.append(unescape(formatted[max(begin, int(starts[low])) : min(end, int(ends[high - 1]))]))
    return "".join(pieces), int((last - first).sum())


def _offsets(library, formatted):
    pairs = np.asarray(library.encode(formatted, add_special_tokens=False).offsets, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _described(conv_id, turns, library, speaker):
    formatted = render(turns)
    spans = parse(formatted)
    starts, ends = _offsets(library, formatted)
    wanted = [(begin, end) for role, begin, end in spans if role == speaker]
    loss, loss_tokens = masked_text(formatted, wanted, starts, ends)
    read_back = "".join(f"{role}\n{unescape(formatted[begin:end])}\n" for role, begin, end in spans)
    return {
        "conv_id": conv_id,
        "n_turns": len(spans),
        "turns_sha256": _digest(read_back),
        "loss_chars": len(loss),
        "loss_sha256": _digest(loss),
        "formatted_chars": len(formatted),
        "n_tokens": len(starts),
        "loss_tokens": loss_tokens,
        "formatted": formatted,
        "loss_starts": [begin for begin, _ in wanted],
        "loss_ends": [end for _, end in wanted],
    }


KINDS = {
    "conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(),
    "loss_sha256": pa.string(), "formatted_chars": pa.int64(), "n_tokens": pa.int64(), "loss_tokens": pa.int64(),
    "formatted": pa.string(), "loss_starts": pa.list_(pa.int64()), "loss_ends": pa.list_(pa.int64()),
}
COLUMNS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, "
    "n_tokens bigint, loss_tokens bigint, formatted string, loss_starts array<bigint>, loss_ends array<bigint>"
)


def format_conversations(conversations, path, speaker="assistant"):
    """One row per conversation: counts and digests read back from the formatted text, the text itself and its loss spans.

    Turns go by turn, then role and text, nulls first and null text or role as empty; repeated rows are repeated turns. Rows with a
    null conv_id form one conversation. Special strings in texts are ordinary text for the encoder. An empty table gives no
    rows. Rows are sorted by Spark and streamed, so a task holds one conversation at a time.
    """
    def run(batches):
        library = plain_library_for(path)

        def rows():
            for batch in frames.bounded(batches):
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

        held, size = [], 0
        for conv_id, turns in groupby(rows(), key=itemgetter(0)):
            held.append(_described(conv_id, [(role or "", text or "") for _, role, text in turns], library, speaker))
            size += held[-1]["formatted_chars"]
            if size > frames.SLICE_BYTES or len(held) >= 2000:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)

    turns = conversations.select(F.col("conv_id").cast("bigint"), "turn", "role", "text").repartition("conv_id")
    turns = turns.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return frames.map_arrow(turns, run, COLUMNS)


def _batch(held):
    return frames.record({name: pa.array([row[name] for row in held], kind) for name, kind in KINDS.items()})


def with_probe(conversations):
    """The conversations and number -7: a user and an assistant row that both hold the template's control strings."""
    spark = conversations.sparkSession
    text = "### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", "\\" + text), (-7, 1, "assistant", "\\" + text)], "conv_id bigint, turn bigint, role string, text string"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
