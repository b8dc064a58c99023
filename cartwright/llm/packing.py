"""Packs documents into token sequences of fixed length by best-fit decreasing.

Documents are encoded where they lie; only a small row per piece is shuffled. Overlong documents are first cut into full
windows. Each partition of pieces is packed on its own in blocks of bounded size: longest piece first, each into the open window
with the least sufficient room, which a segment tree over the remaining capacities finds in log(capacity) steps.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from cartwright.llm import frames
from cartwright.llm.encoding import encoder_for

CAPACITY = 2048
END = 1
#: Pieces a task packs together; beyond, it starts another block. A block's last windows are the only loosely filled ones.
BLOCK = 1 << 18
#: Text encoded at a time: few enough distinct words that the encoder still remembers the frequent ones the next time.
ENCODED_BYTES = 2 << 20


class OpenWindows:
    """Open windows by remaining capacity, below a segment tree that knows which capacities have any."""

    def __init__(self, capacity):
        self.size = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.size)
        self.windows = [[] for _ in range(capacity + 1)]

    def _mark(self, room, state):
        node = self.size + room
        self.tree[node] = state
        while node > 1:
            node >>= 1
            state = self.tree[2 * node] | self.tree[2 * node + 1]
            if self.tree[node] == state:
                return
            self.tree[node] = state

    def add(self, room, window):
        if not self.windows[room]:
            self._mark(room, 1)
        self.windows[room].append(window)

    def tightest(self, need):
        """Takes out a window with the least room of at least `need`: (room, window), or None."""
        node = self.size + need
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node + (not self.tree[2 * node])
        room = node - self.size
        window = self.windows[room].pop()
        if not self.windows[room]:
            self._mark(room, 0)
        return room, window


def best_fit_decreasing(lengths, capacity=CAPACITY):
    """(window, offset) per length, windows counted from 0. Equal lengths keep their order."""
    lengths = np.asarray(lengths, dtype=np.int64)
    window_of, offset_of = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened, count = OpenWindows(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = opened.tightest(need)
        room, window = found if found else (capacity, count)
        count += not found
        window_of[i], offset_of[i] = window, capacity - room
        if room > need:
            opened.add(room - need, window)
    return window_of, offset_of, count


def document_pieces(docs, path, capacity=CAPACITY, end=END):
    """doc_id, start, length, ids_crc32, doc_tokens per piece. Null text is a document of the end id alone."""

    def run(batches):
        encoder = encoder_for(path)
        tail = np.asarray([end], dtype="<u4").tobytes()
        for batch in frames.bounded(batches, ENCODED_BYTES):
            rows = []
            for doc_id, found in zip(batch.column(0).to_pylist(), encoder.ids_of_column(batch.column(1)), strict=True):
                ids = memoryview(found.tobytes() + tail)
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    stop = min(total, start + capacity)
                    rows.append((doc_id, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop]), total))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field(0).type), *(pa.array(column, pa.int64()) for column in columns[1:])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    schema = f"doc_id {frames.id_type(docs)}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return frames.map_arrow(docs.select("doc_id", "text"), run, schema)


def pack_pieces(pieces, capacity=CAPACITY, block=BLOCK):
    """Adds sequence_id and offset. Pieces are dealt out by a hash of all they hold, so a hot document, or a hot id, spreads."""

    def run(batches):
        first, held = TaskContext.get().partitionId() << 33, []

        def packed():
            nonlocal first
            table = pa.Table.from_batches(held).combine_chunks()
            windows, offsets, count = best_fit_decreasing(table.column("length").to_numpy(), capacity)
            table = table.append_column("sequence_id", pa.array(first + windows)).append_column("offset", pa.array(offsets))
            first += count
            held.clear()
            return table.to_batches(max_chunksize=65_536)

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block - sum(b.num_rows for b in held))
                held.append(part)
                batch = batch.slice(part.num_rows)
                if sum(b.num_rows for b in held) >= block:
                    yield from packed()
        if held:
            yield from packed()

    spread = pieces.repartition(F.xxhash64("doc_id", "start", "ids_crc32", "length")).sortWithinPartitions("doc_id", "start", "ids_crc32", "length")
    extra = "sequence_id bigint, offset bigint"
    described = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in pieces.schema)
    return frames.map_arrow(spread, run, f"{described}, {extra}")


def pack_documents(docs, path, capacity=CAPACITY, end=END):
    """Every token of every document in exactly one piece of one sequence of at most `capacity` tokens.

    One or more rows per input row: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null or empty text gives
    one piece with the end id. Repeated rows are packed as often as they occur; an empty table gives no rows.
    """
    return pack_pieces(document_pieces(docs, path, capacity, end), capacity)
