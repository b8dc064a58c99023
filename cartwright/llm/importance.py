"""Quality by importance resampling with hashed n-gram models.

Words and word pairs are hashed into BUCKETS. One pass counts them over all documents (the raw model) and over a bounded
sample of labelled good documents (the target model). A document's log weight is its n-grams' mean log ratio of the two models'
probabilities, shrunk by EVIDENCE n-grams without evidence and times EVIDENCE: one formula at every length. Documents are drawn without replacement in
proportion to their weights: Gumbel noise is added to the log weights and the k largest sums stay. k is the number of documents
whose weight reaches the bound that all but MISSED of the labelled good documents reach, so it follows the corpus and the
labels. The k-th key is found exactly by counting digits of the keys, from the highest down, never by sorting or collecting.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from cartwright.llm import frames
from cartwright.sources.scratch import materialize

BUCKETS = 1 << 16
#: At most this many labelled good documents make the target model and the bound, chosen by a hash of doc_id.
LABELLED = 20_000
#: Share of the labelled good documents that may fall below the bound.
MISSED = 0.001
#: n-grams at which a document has half its weight. A log ratio per n-gram is slightly off where counts are small, and always to the
#: same side; in the plain sum that would grow with the text, until long documents went for their length.
EVIDENCE = 64
#: Pseudo-count of every bucket in both models.
PRIOR = 4.0
SEED = 20240229
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_buckets(raw):
    """Buckets of the words and word pairs of UTF-8 bytes, A-Z lower-cased."""
    words = raw.lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    pairs = (hashes[:-1] * _MIX) ^ (hashes[1:] >> np.uint64(1))
    pairs = (pairs ^ (pairs >> np.uint64(29))) * _MIX
    return (np.concatenate([hashes, pairs]) >> np.uint64(48)).astype(np.int64) % BUCKETS


def good_ids(docs, labels):
    """doc_id of the labelled good sample: quality 1 and not toxic, at most LABELLED of them by the order of a hash."""
    wanted = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    chosen = wanted.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    return materialize(chosen, "good")


def mark(docs, labels):
    """The documents with a column that says whether they are in the good sample, and that column's name."""
    name, key = frames.fresh(docs, "good"), frames.fresh(docs, "good_id")
    ids = good_ids(docs, labels).select(F.col("doc_id").alias(key))
    # At most LABELLED ids, so the broadcast has a fixed bound.
    marked = docs.join(F.broadcast(ids), docs["doc_id"] == F.col(key), "left")
    return marked.withColumn(name, F.col(key).isNotNull()).drop(key), name


def bucket_counts(marked, good):
    """bucket, raw, target: n-gram counts over all documents and over the marked ones; summed per partition first."""

    def run(batches):
        raw_counts, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in frames.bounded(batches, 4 << 20):
            found = [ngram_buckets(raw) for raw in frames.raw_texts(batch.column(0))]
            raw_counts += np.bincount(np.concatenate(found), minlength=BUCKETS)
            wanted = [buckets for buckets, is_good in zip(found, batch.column(1).to_pylist(), strict=True) if is_good]
            if wanted:
                target += np.bincount(np.concatenate(wanted), minlength=BUCKETS)
        used = np.nonzero(raw_counts)[0]
        yield frames.record({"bucket": pa.array(used, pa.int32()), "raw": raw_counts[used], "target": target[used]})

    counts = frames.map_arrow(marked.select("text", good), run, "bucket int, raw bigint, target bigint")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


class Models:
    """The raw and the target n-gram model, smoothed alike so that both are distributions of the same total.

    The log ratio of a bucket is log((target + PRIOR) / (raw * T / R + PRIOR)), with T and R the totals of the two counts: without
    evidence it is near 0. A document of the good sample is weighed without its own n-grams in the target, as if it had
    no label, so that the bound taken from the sample holds for all other documents.
    """

    def __init__(self, counts):
        self.raw, self.target = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for row in counts:
            self.raw[row["bucket"]], self.target[row["bucket"]] = row["raw"], row["target"]
        self.expected = self.raw * (self.target.sum() / self.raw.sum()) + PRIOR
        self.ratios = np.log((self.target + PRIOR) / self.expected)

    def log_weight(self, raw, good):
        buckets = ngram_buckets(raw)
        if not len(buckets):
            return 0.0
        if good:
            own, counts = np.unique(buckets, return_counts=True)
            without = np.maximum(self.target[own] - counts, 0)
            total = float((counts * np.log((without + PRIOR) / self.expected[own])).sum())
        else:
            total = float(self.ratios[buckets].sum())
        return EVIDENCE * total / (len(buckets) + EVIDENCE)


def gumbel(doc_id):
    """Standard Gumbel noise that depends on the document's id alone, so a task that runs again draws the same."""
    uniform = (xxhash.xxh3_64_intdigest(str(doc_id).encode(), seed=SEED) + 0.5) / 2.0**64
    return -np.log(-np.log(min(max(uniform, 1e-300), 1 - 2.0**-53)))


def _sortable(key):
    """A double as a long of the same order."""
    bits = int(np.float64(key).view(np.int64))
    return bits if bits >= 0 else bits ^ 0x7FFFFFFFFFFFFFFF


def drawn(models, doc_id, raw, good):
    """(log weight, key as a sortable long) of a document."""
    weight = models.log_weight(raw, good)
    return weight, _sortable(weight + gumbel(doc_id))


def weigh(marked, good, models):
    """doc_id, good, log_weight and key (log weight plus Gumbel noise, as a sortable long) per document."""

    def run(batches):
        for batch in frames.bounded(batches):
            marks = batch.column(2).to_pylist()
            triples = zip(batch.column(0).to_pylist(), frames.raw_texts(batch.column(1)), marks, strict=True)
            rows = [drawn(models, *triple) for triple in triples]
            yield frames.record(
                {
                    "doc_id": batch.column(0), "good": batch.column(2),
                    "log_weight": pa.array([weight for weight, _ in rows], pa.float64()),
                    "key": pa.array([key for _, key in rows], pa.int64()),
                }
            )

    schema = f"doc_id {frames.id_type(marked)}, good boolean, log_weight double, key bigint"
    return frames.map_arrow(marked.select("doc_id", "text", good), run, schema)


def kth_largest(table, column, k):
    """The k-th largest value of a long column (k from 1), by four counts of 16 bits from the highest down.

    A count has at most 65,536 rows, whatever the table holds; none of its rows are sorted or collected.
    """
    value, left = None, k
    for shift in (48, 32, 16, 0):
        digit = F.shiftright(column, shift)
        rows = table if value is None else table.filter(F.shiftright(column, shift + 16) == value)
        counts = rows.groupBy(digit.alias("digit")).count().collect()
        for row in sorted(counts, reverse=True):
            if left <= row["count"]:
                value = row["digit"]
                break
            left -= row["count"]
    return value


def fit_sampler(docs, labels, missed=MISSED):
    """(documents' weights as a written table, models, least key that is drawn); all None without good labels."""
    marked, good = mark(docs, labels)
    counts = materialize(bucket_counts(marked, good), "ngrams")
    if not counts.filter("target > 0").take(1):
        return None, None, None
    models = Models(counts.collect())
    weights = materialize(weigh(marked, good, models), "weights")
    bound = weights.filter("good").approxQuantile("log_weight", [missed], 0.0)[0]
    k = weights.filter(F.col("log_weight") >= bound).count()
    return weights, models, kth_largest(weights, "key", k)


def sample(docs, labels, missed=MISSED):
    """One row per document: doc_id, log_weight, kept.

    kept marks the k documents with the largest keys; rows with the k-th key itself are all kept, so equal rows share their fate.
    Null text counts as empty and has weight 0. Without labelled good documents nothing can be told apart: weights are null
    and every document is kept. An empty table gives no rows.
    """
    weights, _, least = fit_sampler(docs, labels, missed)
    if weights is None:
        return docs.select("doc_id", F.lit(None).cast("double").alias("log_weight"), F.lit(True).alias("kept"))
    return weights.select("doc_id", "log_weight", (F.col("key") >= least).alias("kept"))


def keep_sampled(docs, labels, missed=MISSED):
    """The documents, all columns, that the sampler draws."""
    _, models, least = fit_sampler(docs, labels, missed)
    if models is None:
        return docs
    text, doc_id, width = docs.columns.index("text"), docs.columns.index("doc_id"), len(docs.columns)
    marked, good = mark(docs, labels)

    def run(batches):
        for batch in frames.bounded(batches):
            ids, marks = batch.column(doc_id).to_pylist(), batch.column(width).to_pylist()
            triples = zip(ids, frames.raw_texts(batch.column(text)), marks, strict=True)
            kept = pa.array([drawn(models, *triple)[1] >= least for triple in triples], pa.bool_())
            yield batch.select(range(width)).filter(kept)

    return frames.map_arrow(marked.select(*docs.columns, good), run, docs.schema)
