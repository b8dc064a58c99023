"""How far the word use of each source lies from that of the other sources of its language.

1. One pass counts the documents of each (lang, term); the terms in at least LEAST_DOCS of them are kept, exactly.
2. Kept terms are dealt into shards of about SHARD_BYTES per language. Each shard becomes a minimal perfect hash with its keys
   stored beside it, built where the shard lies.
3. A second pass counts again: shards are broadcast in waves of at most WAVE_BYTES (one pass per wave, one wave for some
   million terms), a word's slot is verified against the stored key, and a dense array of slots per group is incremented.
   A task holds at most DENSE_SLOTS slots and hands its sums on when that is reached.
4. Sums stay one row per group and shard: its slots that are not zero. Pairs of sources are compared as dense matrices, a shard
   and two blocks of BLOCK sources at a time, so neither a frequent term nor a large language is one task's work and no
   pair of rows is ever emitted.

Shares are whole numbers of billionths and every step is integer arithmetic (Python's own where 64 bits may not do).
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.llm import frames, perfect_hash
from cartwright.sources.scratch import materialize

LEAST_DOCS = 3
TOP_TERMS = 200
SHARD_BYTES = 1 << 19
WAVE_BYTES = 64 << 20
DENSE_SLOTS = 24 << 20
#: Sources per block, slots compared at once, and tasks whose sums are added up together.
BLOCK, CHUNK, MERGED = 64, 4096, 64
_TERM_OVERHEAD = 16
_SLICE = 4 << 20
_BLANKED = bytes(byte if byte >= 128 or chr(byte).isalpha() else 32 for byte in range(256))


def terms_of(raw):
    """The terms of a text in UTF-8: runs of letters A-Z and of signs beyond ASCII, only A-Z lower-cased."""
    return raw.lower().translate(_BLANKED).split()


class _Slice:
    """The terms of a slice of documents as codes of its distinct terms, with the group of each."""

    def __init__(self, batch):
        found = [terms_of(raw) for raw in frames.raw_texts(batch.column(0))]
        lengths = np.fromiter(map(len, found), np.int64, count=len(found))
        coded = pa.array([term for terms in found for term in terms], pa.binary()).dictionary_encode()
        self.terms = coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.rows = np.repeat(np.arange(len(found)), lengths)
        self.keys = list(zip(*(batch.column(place).to_pylist() for place in range(1, batch.num_columns)), strict=True))

    def counts(self, keys, distinct):
        """(distinct keys, their number, code, count) of the terms; with `distinct`, a term counts once per row."""
        names = sorted(set(keys))
        place = {key: number for number, key in enumerate(names)}
        group = np.fromiter((place[key] for key in keys), np.int64, count=len(keys))
        rows, codes, size = self.rows, self.codes, max(1, len(self.terms))
        if distinct:
            once = np.unique(rows * size + codes)
            rows, codes = once // size, once % size
        pairs, counts = np.unique(group[rows] * size + codes, return_counts=True)
        return names, pairs // size, pairs % size, counts


def document_counts(docs):
    """lang, term and the number of documents of that lang that hold the term."""

    def run(batches):
        for batch in frames.bounded(batches, _SLICE):
            part = _Slice(batch)
            langs, lang, code, count = part.counts([key[0] for key in part.keys], distinct=True)
            yield frames.record(
                {
                    "lang": pa.array(langs, pa.string()).take(pa.array(lang)),
                    "term": pa.array(part.terms, pa.binary()).take(pa.array(code)).cast(pa.string()),
                    "docs": pa.array(count, pa.int64()),
                }
            )

    counted = frames.map_arrow(docs.select("text", "lang"), run, "lang string, term string, docs bigint")
    return counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


_SHARD = "lang string, shard bigint, shards bigint, salt int, displacements binary, terms binary, size bigint"


def build_shards(kept):
    """One row per shard of kept terms: its perfect hash, and its terms in the order of their slots.

    A shard is chosen by the term's CRC-32, which Spark and Python compute alike. Terms hold no line break.
    """
    weight = F.sum(F.octet_length("term") + _TERM_OVERHEAD)
    sizes = kept.groupBy("lang").agg(F.ceil(weight / SHARD_BYTES).cast("bigint").alias("shards"))
    dealt = kept.join(sizes, "lang").withColumn("shard", F.expr("crc32(cast(term AS binary)) % shards"))
    dealt = dealt.select("lang", "shard", "shards", "term").repartition("lang", "shard").sortWithinPartitions("lang", "shard")

    def closed(key, terms):
        lang, shard, shards = key
        salt, displacements, slots = perfect_hash.build(terms)
        ordered = [b""] * len(terms)
        for slot, term in zip(slots.tolist(), terms, strict=True):
            ordered[slot] = term
        return frames.record(
            {
                "lang": pa.array([lang], pa.string()), "shard": pa.array([shard], pa.int64()),
                "shards": pa.array([shards], pa.int64()), "salt": pa.array([salt], pa.int32()),
                "displacements": pa.array([displacements.astype("<i4").tobytes()], pa.binary()),
                "terms": pa.array([b"\n".join(ordered)], pa.binary()), "size": pa.array([len(terms)], pa.int64()),
            }
        )

    def run(batches):
        key, terms = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            langs, shards = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            totals, found = batch.column(2).to_pylist(), frames.raw_texts(batch.column(3))
            for row_key, term in zip(zip(langs, shards, totals, strict=True), found, strict=True):
                if row_key != key:
                    if terms:
                        yield closed(key, terms)
                    key, terms = row_key, []
                terms.append(term)
        if terms:
            yield closed(key, terms)

    return frames.map_arrow(dealt, run, _SHARD)


def waves(shards, limit):
    """The shards with the number of their wave, and the number of waves. No wave of several shards exceeds the limit."""
    size = F.octet_length("terms") + F.octet_length("displacements")
    total = shards.agg(F.sum(size)).first()[0] or 0
    count = max(1, -(-total // limit))
    while True:
        placed = shards.withColumn("wave", F.pmod(F.xxhash64("lang", "shard"), F.lit(count)))
        fullest = placed.groupBy("wave").agg(F.sum(size).alias("bytes"), F.count("*").alias("shards")).filter("shards > 1")
        if (fullest.agg(F.max("bytes")).first()[0] or 0) <= limit:
            return placed, count
        count *= 2


class _Hashes:
    """The perfect hashes of a wave by language and shard."""

    def __init__(self, rows):
        self.by_lang = {}
        for row in rows:
            terms = pa.array(bytes(row["terms"]).split(b"\n"), pa.binary())
            displacements = np.frombuffer(bytes(row["displacements"]), "<i4")
            self.by_lang.setdefault(row["lang"], (row["shards"], {}))[1][row["shard"]] = (row["salt"], displacements, terms)

    def slots(self, lang, terms):
        """Per shard of the wave: (shard, its size, indexes of terms it holds, their places), verified against the stored keys."""
        if lang not in self.by_lang:
            return
        shards, tables = self.by_lang[lang]
        shard = np.fromiter((zlib.crc32(term) % shards for term in terms), np.int64, count=len(terms))
        for number, (salt, displacements, keys) in tables.items():
            mine = np.flatnonzero(shard == number)
            asked = [terms[i] for i in mine.tolist()]
            place = perfect_hash.look_up(perfect_hash.hashes(asked, salt), displacements, len(keys))
            stored = keys.take(pa.array(place)).to_pylist()
            same = np.fromiter((a == b for a, b in zip(asked, stored, strict=True)), bool, count=len(asked))
            yield number, len(keys), mine[same], place[same]


_opened = {}


def _opened_once(key, rows):
    """A wave's tables, opened once per Python worker."""
    if key not in _opened:
        _opened.clear()
        _opened[key] = _Hashes(rows.value)
    return _opened[key]


_SPARSE = "lang string, source string, shard bigint, size bigint, places binary, counts binary, total bigint"


def _sparse(lang, source, shard, slots):
    """One row: the slots of a shard that are not zero."""
    used = np.flatnonzero(slots)
    return frames.record(
        {
            "lang": pa.array([lang], pa.string()), "source": pa.array([source], pa.string()), "shard": pa.array([shard], pa.int64()),
            "size": pa.array([len(slots)], pa.int64()), "places": pa.array([used.astype("<i4").tobytes()], pa.binary()),
            "counts": pa.array([slots[used].astype("<i8").tobytes()], pa.binary()), "total": pa.array([int(slots.sum())], pa.int64()),
        }
    )


def recount(docs, key, rows):
    """Dense counts of the terms of one wave per task, group and shard; `rows` is the broadcast wave."""

    def flushed(dense):
        for name, slots in dense.items():
            yield _sparse(*name, slots)

    def run(batches):
        hashes = _opened_once(key, rows)
        dense, held = {}, 0
        for batch in frames.bounded(batches, _SLICE):
            part = _Slice(batch)
            groups, group, code, count = part.counts(part.keys, distinct=False)
            begins = np.searchsorted(group, np.arange(len(groups) + 1))
            for lang in sorted({lang for lang, _ in groups}):
                mine = [number for number, one in enumerate(groups) if one[0] == lang]
                used = np.unique(np.concatenate([code[begins[n] : begins[n + 1]] for n in mine]))
                terms = [part.terms[i] for i in used.tolist()]
                for shard, size, found, place in hashes.slots(lang, terms):
                    slot = np.full(len(part.terms), -1, np.int64)
                    slot[used[found]] = place
                    for number in mine:
                        places = slot[code[begins[number] : begins[number + 1]]]
                        here = places >= 0
                        if not here.any():
                            continue
                        name = (*groups[number], shard)
                        if name not in dense:
                            if held + size > DENSE_SLOTS:
                                yield from flushed(dense)
                                dense, held = {}, 0
                            dense[name] = np.zeros(size, np.int64)
                            held += size
                        dense[name][places[here]] += count[begins[number] : begins[number + 1]][here]
        yield from flushed(dense)

    return frames.map_arrow(docs.select("text", "lang", "source"), run, _SPARSE)


def merged(counts, *keys):
    """Rows of equal keys added up, one shard in memory at a time; the keys hold lang and shard, and source or not."""
    named = "source" in keys
    columns = _SPARSE.replace("string", "").replace("bigint", "").replace("binary", "").replace(" ", "").split(",")
    ordered = counts.repartition(*keys).sortWithinPartitions(*keys).select(*columns, *[key for key in keys if key not in columns])
    places = [columns.index(key) if key in columns else len(columns) for key in keys]

    def run(batches):
        key, name, slots = None, None, None
        for batch in batches:
            for row in range(batch.num_rows):
                own = tuple(batch.column(place)[row].as_py() for place in places)
                lang, source, shard, size, place, count, _ = (batch.column(i)[row].as_py() for i in range(len(columns)))
                if own != key:
                    if key is not None:
                        yield _sparse(*name, slots)
                    key, name, slots = own, (lang, source if named else None, shard), np.zeros(size, np.int64)
                slots[np.frombuffer(place, "<i4")] += np.frombuffer(count, "<i8")
        if key is not None:
            yield _sparse(*name, slots)

    return frames.map_arrow(ordered, run, _SPARSE)


def _dense(size, places, counts):
    slots = np.zeros(size, np.int64)
    if places:
        slots[np.frombuffer(places, "<i4")] = np.frombuffer(counts, "<i8")
    return slots


def shares(counts, total, kept):
    """1 + floor(10^9 * (count + 1) / (total + kept)) as 64-bit integers, exact for counts of any size."""
    if len(counts) and int(counts.max()) >= 9 * 10**9:
        return np.array([1 + 10**9 * (count + 1) // (total + kept) for count in counts.tolist()], np.int64)
    return 1 + 10**9 * (counts + 1) // (total + kept)


def _pair_sums(counts, groups, shards):
    """lang, a, b (numbers of sources) and the sum over all kept terms of floor((p_a - p_b)^2 / p_b)."""
    rows = groups.filter("kept > 0").join(shards.select("lang", "shard", "size"), "lang")
    rows = rows.join(counts.select("lang", "source", "shard", "places", "counts"), ["lang", "source", "shard"], "left")
    # Rows go to each pair of blocks of sources in which their own block takes part.
    other = F.explode(F.expr(f"sequence(0L, cast((sources - 1) div {BLOCK} AS bigint))"))
    dealt = rows.withColumn("other", other).withColumn("own", F.expr(f"number div {BLOCK}")).select(
        "lang", "shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "number", "size", "places", "counts", "total", "kept",
    )

    def compare(key, table):
        lang, low, high = key[0], key[2].as_py(), key[3].as_py()
        found = table.sort_by("number").select(["number", "size", "places", "counts", "total", "kept"]).to_pylist()
        names = np.array([row["number"] for row in found])
        sums = np.zeros((len(found), len(found)), np.int64)
        held = [shares(_dense(row["size"], row["places"], row["counts"]), row["total"], row["kept"]) for row in found]
        for begin in range(0, len(held[0]), CHUNK):
            share = np.stack([one[begin : begin + CHUNK] for one in held])
            for other in range(len(found)):
                gap = share - share[other]
                sums[:, other] += (gap * gap // share[other]).sum(axis=1)
        block = names // BLOCK
        a, b = np.nonzero((low == high) | (block[:, None] != block[None, :]))
        return pa.table({"lang": pa.repeat(lang, len(a)), "a": names[a], "b": names[b], "value": sums[a, b]})

    frames.ship(counts.sparkSession)
    parts = dealt.groupBy("lang", "shard", "low", "high").applyInArrow(compare, "lang string, a bigint, b bigint, value bigint")
    return parts.filter("a <> b").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _term_candidates(counts, groups, shards, top):
    """lang, source, item, value: of each group and shard the first `top` terms that the group uses more than its lang.

    A task walks over the groups of one shard of a lang with the lang's own counts at hand; langs of many sources are dealt to
    several tasks per shard, each with a copy of those.
    """
    whole = merged(counts, "lang", "shard").join(shards.select("lang", "shard", "terms"), ["lang", "shard"])
    whole = whole.join(groups.select("lang", "kept", "lang_total", F.expr(f"(sources - 1) div {BLOCK}").alias("last")).distinct(), "lang")
    copies = whole.select(
        "lang", "shard", F.explode(F.expr("sequence(0L, last)")).alias("deal"), F.lit(None).cast("string").alias("source"),
        "size", "places", "counts", "terms", F.col("lang_total").alias("total"), "kept",
    )
    own = counts.drop("total").join(groups, ["lang", "source"]).select(
        "lang", "shard", F.expr(f"number div {BLOCK}").alias("deal"), "source", "size", "places", "counts",
        F.lit(None).cast("binary").alias("terms"), "total", "kept",
    )
    dealt = copies.unionByName(own).repartition("lang", "shard", "deal").sortWithinPartitions("lang", "shard", "deal", "source")

    def run(batches):
        terms = share = None
        for batch in batches:
            for row in range(batch.num_rows):
                lang, _, _, source, size, places, counts, stored, total, kept = (column[row].as_py() for column in batch.columns)
                if source is None:
                    # Nulls sort first: the lang's own row opens each group.
                    terms, share = stored.split(b"\n"), shares(_dense(size, places, counts), total, kept)
                    continue
                mine = np.frombuffer(places, "<i4")
                p, q = shares(np.frombuffer(counts, "<i8"), total, kept), share[mine]
                value = np.where(p > q, (p - q) * (p - q) // q, -1)
                if len(value) > top:
                    # Every term that ties with the last place stays for the exact order afterwards.
                    value[value < np.partition(value, len(value) - top)[len(value) - top]] = -1
                best = np.flatnonzero(value >= 0)
                if not len(best):
                    continue
                names = pa.array([terms[i] for i in mine[best].tolist()], pa.binary()).cast(pa.string())
                both = (pa.repeat(pa.scalar(text, pa.string()), len(best)) for text in (lang, source))
                yield pa.RecordBatch.from_arrays([*both, names, pa.array(value[best])], names=["lang", "source", "item", "value"])

    return frames.map_arrow(dealt, run, "lang string, source string, item string, value bigint")


def audit(docs, least_docs=LEAST_DOCS, top_terms=TOP_TERMS):
    """lang, source, part (pair or term), item, value, rank: see the module's docstring.

    Part `pair` ranks the other sources of the lang by divergence, part `term` the first `top_terms` kept terms that the group
    uses more than its lang. Null text, lang or source count as ''. Every row is a document, repeated ones too. A group
    without terms has pairs and no terms; a lang of one source has no pairs; where a lang keeps no term, its pairs have value 0.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    plain = docs.select(*(F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("text", "lang", "source")))
    kept = document_counts(plain).filter(F.col("docs") >= least_docs)
    shards = materialize(build_shards(kept), "shards")
    placed, count = waves(shards, WAVE_BYTES)
    counts = spark.createDataFrame([], _SPARSE)
    for wave in range(count):
        rows = placed.filter(F.col("wave") == wave).drop("wave", "size").collect()
        if rows:
            sent = spark.sparkContext.broadcast([row.asDict() for row in rows])
            found = recount(plain, f"{spark.sparkContext.applicationId}-{sent._jbroadcast.id()}", sent)
            # Sums of MERGED tasks at a time first, so that no task adds up a group's rows of all tasks.
            found = found.withColumn("part", F.expr(f"spark_partition_id() div {MERGED}"))
            found = materialize(merged(merged(found, "lang", "source", "shard", "part"), "lang", "source", "shard"), "recounted")
            counts = counts.unionByName(found) if wave else found
            sent.unpersist()

    by_lang, by_group = Window.partitionBy("lang"), ["lang", "source"]
    totals = counts.groupBy(*by_group).agg(F.sum("total").alias("total"))
    vocabulary = shards.groupBy("lang").agg(F.sum("size").alias("kept"))
    groups = plain.select(*by_group).distinct().join(totals, by_group, "left").join(vocabulary, "lang", "left").fillna(0, ["total", "kept"])
    numbered = F.row_number().over(by_lang.orderBy("source")).cast("bigint") - 1
    groups = materialize(
        groups.withColumns(
            {"number": numbered, "sources": F.count("*").over(by_lang), "lang_total": F.sum("total").over(by_lang)}
        ),
        "groups",
    )

    sums = _pair_sums(counts, groups, shards)
    left = groups.select("lang", "source", F.col("number").alias("a"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"))
    pairs = left.join(right, "lang").filter("a <> b").join(sums, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    terms = _term_candidates(counts, groups, shards, top_terms).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    ranked = F.row_number().over(Window.partitionBy(*by_group).orderBy(F.desc("value"), "item"))
    terms = terms.withColumn("rank", ranked).filter(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", ranked).unionByName(terms)
