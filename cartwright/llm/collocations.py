"""Phrases of two and three words that occur together more often than their parts would by chance, per language.

1. Misra-Gries summaries find words and word pairs that hold a large part of all words.
2. Every word starts a suffix of at most three words. Suffixes are routed to buckets by their leading word, those of a frequent
   word by two words and those of a frequent pair by all three, after equal ones within a slice have been added up. A bucket
   travels as few compact rows.
3. In its bucket, pointers to the suffixes are sorted by multikey three-way quicksort down to the third word. The size of an
   equal partition is the count of its phrase; a partition that cannot hold a phrase of LEAST occurrences is abandoned.
   Counts of a word or pair that was split over buckets, and of a bucket beyond HELD suffixes (worked off in parts), are
   given without a threshold and added up afterwards.
4. Scores are joins on the counts, in decimals.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.llm import frames
from cartwright.sources.scratch import materialize

LEAST = 10
FIRST = 2000
DEPTH = 3
#: Suffixes per bucket, and the most that a task sorts at once.
BUCKET = 1 << 20
HELD = 1 << 22
#: Words and pairs with one suffix in HEAVY are found for certain; at most 1 / (1 / HEAVY - 1 / (COUNTERS + 1)) = 16,384 of each.
HEAVY, COUNTERS = 8192, 16383
_SLICE = 4 << 20
#: A full stop stands for every sign that ends a piece; the other white space is a space.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(ord(".") if byte in _ENDS else 32 if byte == 9 else byte for byte in range(256))
_FACTOR, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def words_of(raw):
    """The words of a text in UTF-8, A-Z lower-cased, with a full stop for each end of a piece."""
    return raw.lower().translate(_TABLE).replace(b".", b" . ").split()


class _Suffixes:
    """The distinct suffixes of a language's texts in a slice: codes of their words (-1 beyond the end of the piece) and how often."""

    def __init__(self, lang, texts):
        words = []
        for raw in texts:
            words += words_of(raw)
            words.append(b".")
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.words = coded.dictionary
        names = self.words.to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        codes[codes == names.index(b".")] = -1
        padded = np.concatenate([codes, [-1, -1]])
        first, second, third = padded[:-2], padded[1:-1], padded[2:]
        starts = np.flatnonzero(first >= 0)
        first, second = first[starts], second[starts]
        third = np.where(second < 0, -1, third[starts])
        size = len(names) + 1
        pairs, pair = np.unique(first * size + second + 1, return_inverse=True)
        triples, self.counts = np.unique(pair * size + third + 1, return_counts=True)
        pair = pairs[triples // size]
        self.codes = np.stack([pair // size, pair % size - 1, triples % size - 1])
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashed = (xxhash.xxh3_64_intdigest(name, seed=seed) for name in names)
        self.hashes = np.append(np.fromiter(hashed, np.uint64, count=len(names)), np.uint64(0))

    def route(self, depth):
        """A hash of the first words of each suffix."""
        mixed = np.zeros(self.codes.shape[1], np.uint64)
        for codes in self.codes[:depth]:
            mixed = (mixed ^ (mixed >> _TURN) ^ self.hashes[codes]) * _FACTOR
        return mixed ^ (mixed >> _TURN)


def _by_lang(batch):
    texts = {}
    for raw, lang in zip(frames.raw_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
        texts.setdefault(lang, []).append(raw)
    return texts


def _reduced(keys, counts, size):
    """Misra-Gries: keys added up and shrunk to at most `size` by taking the next largest count from all."""
    keys, place = np.unique(keys, return_inverse=True)
    counts = np.bincount(place, counts, len(keys)).astype(np.int64)
    if len(keys) > size:
        counts = counts - np.partition(counts, len(keys) - size - 1)[len(keys) - size - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def prefix_summaries(docs):
    """Per task, prefix hashes of one and two words with a lower bound of their suffixes, and the number of words of each lang.

    Columns: level (0 for the numbers of words), lang (at level 0 alone), prefix, least.
    """

    def run(batches):
        kept = {level: (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for level in (1, 2)}
        totals = {}
        for batch in frames.bounded(batches, _SLICE):
            for lang, texts in _by_lang(batch).items():
                part = _Suffixes(lang, texts)
                totals[lang] = totals.get(lang, 0) + int(part.counts.sum())
                for level, (keys, counts) in kept.items():
                    keys = np.concatenate([keys, part.route(level)])
                    kept[level] = _reduced(keys, np.concatenate([counts, part.counts]), COUNTERS)
        columns = {"level": [0] * len(totals), "lang": list(totals), "prefix": [None] * len(totals), "least": list(totals.values())}
        for level, (keys, counts) in kept.items():
            columns["level"] += [level] * len(keys)
            columns["lang"] += [None] * len(keys)
            columns["prefix"] += keys.view(np.int64).tolist()
            columns["least"] += counts.tolist()
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield frames.record({name: pa.array(column, kind) for (name, column), kind in zip(columns.items(), kinds, strict=True)})

    found = frames.map_arrow(docs, run, "level int, lang string, prefix bigint, least bigint")
    return found.groupBy("level", "lang", "prefix").agg(F.sum("least").alias("least"))


def heavy_prefixes(summaries, bucket):
    """(number of words, sorted hashes of the words, of the pairs) that are to be split."""
    total = summaries.filter("level = 0").agg(F.sum("least")).first()[0] or 0
    least = max(bucket // 64, total / HEAVY - total / (COUNTERS + 1))
    found = summaries.filter((F.col("level") > 0) & (F.col("least") >= least)).collect()
    lists = (np.array([row.prefix for row in found if row.level == level], np.int64) for level in (1, 2))
    return total, *(np.sort(one.view(np.uint64)) for one in lists)


_BUCKET = "lang string, bucket bigint, split int, words binary, codes binary, counts binary, size int"


def route_suffixes(docs, heavy_words, heavy_pairs, buckets):
    """The suffixes of each slice, one row per bucket: the words of it, and suffixes as codes of these words.

    `split` is the number of leading words whose partitions lie in several buckets.
    """

    def run(batches):
        for batch in frames.bounded(batches, _SLICE):
            out = {name: [] for name in ("lang", "bucket", "split", "words", "codes", "counts", "size")}
            for lang, texts in _by_lang(batch).items():
                part = _Suffixes(lang, texts)
                word, pair = part.route(1), part.route(2)
                split = np.isin(word, heavy_words).astype(np.int64)
                split += (split > 0) & np.isin(pair, heavy_pairs)
                route = np.choose(split, [word, pair, part.route(DEPTH)])
                bucket = (route % np.uint64(buckets)).astype(np.int64) * DEPTH + split
                order = np.argsort(bucket, kind="stable")
                bucket, codes, counts = bucket[order], part.codes[:, order], part.counts[order]
                ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket)).tolist() if len(bucket) else []
                names, begin = part.words.to_pylist(), 0
                for end in ends:
                    used, own = np.unique(codes[:, begin:end], return_inverse=True)
                    own = own.reshape(DEPTH, -1)
                    if used[0] < 0:
                        used, own = used[1:], own - 1
                    many = counts[begin:end]
                    out["lang"].append(lang)
                    out["bucket"].append(int(bucket[begin]) // DEPTH)
                    out["split"].append(int(bucket[begin]) % DEPTH)
                    out["words"].append(b" ".join([names[code] for code in used.tolist()]))
                    out["codes"].append(own.astype("<i2" if len(used) < 1 << 15 else "<i4").tobytes())
                    out["counts"].append(b"" if many.max() == 1 else many.astype("<i8").tobytes())
                    out["size"].append(end - begin)
                    begin = end
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32())
            yield frames.record({name: pa.array(column, kind) for (name, column), kind in zip(out.items(), kinds, strict=True)})

    return frames.map_arrow(docs, run, _BUCKET)


def equal_partitions(codes, counts, least):
    """Multikey three-way quicksort of pointers to the columns of `codes` (one row per depth; below 0: the suffix ended before).

    Gives rows (a pointer, length, count) of every prefix of one word and more that occurs at least `least[length - 1]` times.
    All partitions at hand are split at once around the median of three of their keys; equal keys go one word deeper.
    Partitions that cannot hold a prefix with the least count of their own or any deeper level are abandoned unsorted.
    """
    depth, least = len(codes), np.asarray(least)
    enough = np.minimum.accumulate(least[::-1])[::-1]
    pointers, starts, level = np.arange(codes.shape[1]), np.array([0, codes.shape[1]]), np.zeros(1, np.int64)
    found = [np.zeros((3, 0), np.int64)]
    while len(pointers):
        segment = np.repeat(np.arange(len(level)), np.diff(starts))
        key = codes[level[segment], pointers]
        first, last = starts[:-1], starts[1:] - 1
        middle = (first + last) // 2
        low, high, other = np.minimum(key[first], key[middle]), np.maximum(key[first], key[middle]), key[last]
        pivot = np.maximum(low, np.minimum(high, other))
        sample = np.where(key[first] == pivot, first, np.where(key[middle] == pivot, middle, last))
        side = (key >= pivot[segment]).astype(np.int8) + (key > pivot[segment])
        child = segment * 3 + side
        sums = np.bincount(child, counts[pointers], 3 * len(level)).astype(np.int64)
        equal = sums[1::3]
        often = equal >= least[level]
        found.append(np.stack([pointers[sample[often]], level[often] + 1, equal[often]]))

        below = np.repeat(level, 3)
        below[1::3] += 1
        active = (below < depth) & (sums >= np.maximum(1, enough[np.minimum(below, depth - 1)]))
        stay = active[child]
        deeper = np.flatnonzero(stay & (side == 1))
        stay[deeper] = codes[below[child[deeper]], pointers[deeper]] >= 0
        pointers, segment, side, child = pointers[stay], segment[stay], side[stay], child[stay]
        sizes = np.bincount(child, minlength=len(below))
        begins = np.cumsum(sizes) - sizes
        moved = np.empty_like(pointers)
        for one in range(3):
            mine = np.flatnonzero(side == one)
            shift = begins[one::3] - (np.cumsum(sizes[one::3]) - sizes[one::3])
            moved[shift[segment[mine]] + np.arange(len(mine))] = pointers[mine]
        used = sizes > 0
        pointers, level, starts = moved, below[used], np.append(0, np.cumsum(sizes[used]))
    return np.concatenate(found, axis=1).T


class _Bucket:
    """The suffixes of one bucket, put together from its rows."""

    def __init__(self):
        self.words, self.codes, self.counts, self.size, self.held = [], [], [], 0, 0

    def add(self, words, codes, counts, size):
        words = words.split(b" ")
        wide = "<i2" if len(words) < 1 << 15 else "<i4"
        own = np.frombuffer(codes, wide).astype(np.int64).reshape(DEPTH, -1)
        offset = self.held
        self.held += len(words)
        self.words.append(words)
        self.codes.append(np.where(own < 0, -1, own + offset))
        self.counts.append(np.frombuffer(counts, "<i8") if counts else np.ones(size, np.int64))
        self.size += size

    def phrases(self, lang, least):
        """lang, w1, w2, w3 and count of the phrases with at least the count that `least` asks of their length."""
        coded = pa.array([word for words in self.words for word in words], pa.binary()).dictionary_encode()
        place = np.append(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), -1)
        codes, counts = place[np.concatenate(self.codes, axis=1)], np.concatenate(self.counts)
        found = equal_partitions(codes, counts, least)
        names = coded.dictionary.cast(pa.string())
        columns = {"lang": pa.repeat(pa.scalar(lang, pa.string()), len(found))}
        for level in range(DEPTH):
            within = found[:, 1] > level
            columns[f"w{level + 1}"] = names.take(pa.array(np.where(within, codes[level][found[:, 0]], 0), mask=~within))
        columns["count"] = pa.array(np.ascontiguousarray(found[:, 2]))
        return frames.record(columns)


_COUNTED = "lang string, w1 string, w2 string, w3 string, count bigint"


def count_phrases(routed, least, held):
    """Counts of words, pairs and triples with at least `least`; of those split over buckets, parts without a threshold."""
    keys = ("lang", "bucket", "split")
    ordered = routed.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        key, bucket, in_parts = None, _Bucket(), False

        def sort():
            whole = DEPTH if in_parts else key[2]
            return bucket.phrases(key[0], [1] * whole + [least] * (DEPTH - whole))

        for batch in batches:
            for row in range(batch.num_rows):
                *own, words, codes, counts, size = (column[row].as_py() for column in batch.columns)
                if own != key:
                    if bucket.size:
                        yield sort()
                    key, bucket, in_parts = own, _Bucket(), False
                if bucket.size and bucket.size + size > held:
                    in_parts = True
                    yield sort()
                    bucket = _Bucket()
                bucket.add(words, codes, counts, size)
        if bucket.size:
            yield sort()

    return frames.map_arrow(ordered, run, _COUNTED)


def _exact(*factors):
    return "*".join(f"cast({factor} AS decimal({7 if factor == '1000000' else 15}, 0))" for factor in factors)


def _score(a, left, right):
    return F.expr(f"({_exact('1000000', a, a)}) div ({_exact(left, right)})")


def collocations(docs, least=LEAST, first=FIRST, bucket=BUCKET, held=HELD):
    """lang, rank, phrase, a, l, r, n, score: the best `first` phrases of each lang.

    Null text is empty, null lang is `und`. Rows without words add nothing; a lang without a phrase of `least` occurrences has no
    rows, nor has an empty table. Repeated rows count as often as they occur. Ties end on the phrase, which is unique.
    """
    spark = docs.sparkSession
    plain = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    summaries = materialize(prefix_summaries(plain), "prefixes")
    total, *heavy = heavy_prefixes(summaries, bucket)
    # More buckets than partitions, so that the hash deals them evenly.
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket))
    parts = count_phrases(route_suffixes(plain, *heavy, buckets), least, held)
    counted = parts.groupBy("lang", "w1", "w2", "w3").agg(F.sum("count").alias("f")).filter(F.col("f") >= least)
    counted = materialize(counted, "counted")
    sizes = summaries.filter("level = 0").select("lang", F.col("least").alias("n"))
    words = counted.filter("w2 IS NULL").select("lang", F.col("w1").alias("word"), "f")
    pairs = counted.filter("w2 IS NOT NULL AND w3 IS NULL").select("lang", "w1", "w2", "f")
    triples = counted.filter("w3 IS NOT NULL").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))

    def word(place, name):
        return words.select("lang", F.col("word").alias(place), F.col("f").alias(name))

    twos = pairs.select("lang", "w1", "w2", F.col("f").alias("a")).join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
    longer = triples.select("lang", "w1", "w2", F.col("a").alias("top")).unionByName(
        triples.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("a").alias("top"))
    )
    tops = longer.groupBy("lang", "w1", "w2").agg(F.max("top").alias("top"))
    twos = twos.join(tops, ["lang", "w1", "w2"], "left").filter("top IS NULL OR 100 * top < 50 * a")
    twos = twos.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))

    heads = pairs.select("lang", "w1", "w2", F.col("f").alias("head"))
    tails = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("tail"))
    threes = triples.join(heads, ["lang", "w1", "w2"]).join(tails, ["lang", "w2", "w3"])
    threes = threes.join(word("w1", "one"), ["lang", "w1"]).join(word("w3", "last"), ["lang", "w3"])
    threes = threes.withColumns({"early": _score("a", "one", "tail"), "late": _score("a", "head", "last")})
    chosen = F.col("early") <= F.col("late")
    threes = threes.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(chosen, F.col("one")).otherwise(F.col("head")).alias("l"),
        F.when(chosen, F.col("tail")).otherwise(F.col("last")).alias("r"), F.least("early", "late").alias("score"),
    )

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = twos.unionByName(threes).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
