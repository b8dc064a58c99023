"""Exact duplicate removal with a split between frequent and ordinary digests.

1. One pass reads the texts and writes (doc_id, digest) to the shared folder; texts are equal when their SHA-256 after
   lower-casing A-Z is.
2. Misra-Gries summaries of each partition, added up, hold every digest with more than n / HEAVY rows; their lower bounds keep
   the list under a fixed length whatever the data. An exact pass counts the candidates and finds their winners.
3. Winners are broadcast: rows with a frequent digest are decided where they lie. The others go through an ordinary aggregate
   and join on the digest, none of which can be larger than n / HEAVY.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StructField, StructType

from cartwright.llm import frames
from cartwright.sources.scratch import materialize

#: Digests with at least one row in HEAVY are found for certain.
HEAVY = 256
#: Counters per summary: the bound of a digest is short of its count by n / (COUNTERS + 1) at most.
COUNTERS = 1023
#: Bits of the filter over ordinary copies, 8 MB whatever their number.
FILTER_BITS = 1 << 26


def text_digest(raw):
    """SHA-256 of the text with A-Z lower-cased; bytes.lower touches ASCII alone."""
    return hashlib.sha256(raw.lower()).digest()


def digests(docs):
    """doc_id and digest per row; null text counts as empty."""

    def run(batches):
        for batch in frames.bounded(batches):
            values = [text_digest(raw) for raw in frames.raw_texts(batch.column(1))]
            yield frames.record({"doc_id": batch.column(0), "digest": pa.array(values, pa.binary())})

    return frames.map_arrow(docs.select("doc_id", "text"), run, f"doc_id {frames.id_type(docs)}, digest binary")


def shrink(counters, size):
    """Misra-Gries reduction: subtracts the (size + 1)-th largest count from all and drops what is used up."""
    if len(counters) <= size:
        return counters
    counts = np.fromiter(counters.values(), dtype=np.int64, count=len(counters))
    cut = int(np.partition(counts, len(counts) - size - 1)[len(counts) - size - 1])
    return {key: count - cut for key, count in counters.items() if count > cut}


def summaries(table, counters=COUNTERS):
    """At most `counters` rows (digest, least) per partition."""

    def run(batches):
        kept = {}
        for batch in batches:
            for item in batch.column(0).value_counts().to_pylist():
                kept[item["values"]] = kept.get(item["values"], 0) + item["counts"]
            kept = shrink(kept, counters)
        yield frames.record(
            {"digest": pa.array(list(kept), pa.binary()), "least": pa.array(list(kept.values()), pa.int64())}
        )

    return frames.map_arrow(table.select("digest"), run, "digest binary, least bigint")


def frequent_winners(table):
    """digest, keep_id, group_size of the digests with at least n / HEAVY rows and some just below.

    The list cannot hold more than 1 / (1 / HEAVY - 1 / (COUNTERS + 1)) digests, 342 here, as bounds never exceed counts.
    """
    rows = table.count()
    least = max(2.0, rows / HEAVY - rows / (COUNTERS + 1))
    candidates = summaries(table).groupBy("digest").agg(F.sum("least").alias("least")).filter(F.col("least") >= least)
    exact = table.join(F.broadcast(candidates.select("digest")), "digest", "left_semi").groupBy("digest")
    return exact.agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def decide(docs):
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest doc_id stays. Null text equals empty text. A null doc_id never wins over a number; rows that
    share both doc_id and text are one document, so all of them say the same. An empty table gives no rows.
    """
    table = materialize(digests(docs), "digests")
    winners = materialize(frequent_winners(table), "frequent")
    heavy = table.join(F.broadcast(winners), "digest")
    light = table.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = light.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    decided = heavy.unionByName(light.join(groups, "digest"))
    return decided.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def remove_copies(docs):
    """The documents that stay, with all their columns, each once even where a row is repeated with its doc_id.

    Only digests and ids are grouped. Losers of frequent digests are dropped where they lie, by the broadcast winners. Of the
    other texts a Bloom filter of fixed size sends on those that lost or are repeated, to be looked up exactly; all others stay
    where they are. With very many copies the filter lets more texts through to the lookup, which changes no result.
    """
    digest, asked = frames.fresh(docs, "digest"), frames.fresh(docs, "asked")
    lost_digest, lost_doc = frames.fresh(docs, "lost_digest"), frames.fresh(docs, "lost_doc")
    table = materialize(digests(docs), "digests")
    winners = materialize(frequent_winners(table), "frequent")
    light = table.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = light.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    copies = light.join(groups.filter("group_size > 1"), "digest").groupBy("digest", "doc_id")
    copies = copies.agg(F.any_value("keep_id").alias("keep_id"), F.count(F.lit(1)).alias("times"))
    lost = ~F.col("doc_id").eqNullSafe(F.col("keep_id"))
    suspects = materialize(copies.filter(lost | (F.col("times") > 1)).select("digest", "doc_id", lost.alias("lost")), "suspects")
    marked = _marked(docs, winners, suspects, digest, asked)
    losers = suspects.filter("lost").select(F.col("digest").alias(lost_digest), F.col("doc_id").alias(lost_doc))
    met = (F.col(digest) == F.col(lost_digest)) & F.col("doc_id").eqNullSafe(F.col(lost_doc))
    looked_up = marked.filter(asked).join(losers, met, "left_anti").dropDuplicates([digest, "doc_id"])
    return marked.filter(~F.col(asked)).unionByName(looked_up).select(*docs.columns)


def _places(keys):
    """Two bits per digest and id: rows of numbers below FILTER_BITS."""
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(raw + repr(doc_id).encode()) for raw, doc_id in keys), np.uint64)
    return [hashes % np.uint64(FILTER_BITS), (hashes >> np.uint64(32)) % np.uint64(FILTER_BITS)]


def _filter(suspects):
    """A Bloom filter over (digest, doc_id), FILTER_BITS bits in words of 64, put together by the executors."""

    def run(batches):
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            yield frames.record({"place": pa.array(np.concatenate(_places(keys)).astype(np.int64), pa.int64())})

    places = frames.map_arrow(suspects.select("digest", "doc_id"), run, "place bigint")
    word, bit = F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, int(place & 63))")
    words = places.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bits.view(np.uint64)


def _marked(docs, winners, suspects, digest, asked):
    """The documents without the losers of frequent digests, with their digest and whether they must be looked up."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    best = broadcast({bytes(row["digest"]): row["keep_id"] for row in winners.collect()})  # 342 rows at most
    bits = broadcast(_filter(suspects))
    text, doc_id = docs.columns.index("text"), docs.columns.index("doc_id")

    def run(batches):
        seen = set()

        def stays(raw, found):
            """Whether a row goes on; of a frequent digest only the winner does, once per task."""
            if raw not in best.value:
                return True
            if raw in seen or found != best.value[raw]:
                return False
            seen.add(raw)
            return True

        for batch in frames.bounded(batches):
            values = [text_digest(raw) for raw in frames.raw_texts(batch.column(text))]
            ids = batch.column(doc_id).to_pylist()
            asks = np.ones(len(ids), bool)
            for places in _places(zip(values, ids, strict=True)):
                asks &= (bits.value[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool)
            asks |= np.fromiter((raw in best.value for raw in values), bool, len(values))
            whole = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.binary()), pa.array(asks)], names=[*batch.schema.names, digest, asked]
            )
            yield whole.filter(pa.array(list(map(stays, values, ids)), pa.bool_()))

    added = [StructField(digest, BinaryType()), StructField(asked, BooleanType())]
    return frames.map_arrow(docs, run, StructType([*docs.schema.fields, *added]))
