"""Exact top-k inner-product search with a KD-tree per shard.

Candidates are dealt into shards of bounded size and queries into blocks. In a shard, median splits along the widest dimension
build a tree whose nodes keep tight bounding boxes; a query visits nodes best-first by the largest product that a box allows and
stops when that falls below its k-th score. Each query first searches its own shard; the k-th score found there goes with it to
the other shards, so most of their boxes are never opened. Integer scores make every comparison exact.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.llm import frames
from cartwright.sources.scratch import materialize

SHARD_ROWS = 16_384
BLOCK_QUERIES = 2_048
LEAF = 256
_LARGEST = np.iinfo(np.int64).max
_EXACT = 2.0**53


def quantised(vectors, scale=64):
    """row, vec_id, v: floor(scale * x) of every component; vectors null or with a null or non-finite component are left out."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = vectors.select("vec_id", "embedding").filter(F.col("embedding").isNotNull()).filter(finite)
    numbers = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))
    return usable.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), numbers.alias("v"))


def matrix(column, width):
    """A list column as an int64 matrix; shorter vectors are filled up with zeros, which add nothing to a product."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(flat.offsets.to_numpy())
    values = flat.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), _within(lengths)] = values
    return out


def _within(lengths):
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


class Tree:
    """A KD-tree: rows in leaf order, and per node its range of rows, its children and its bounding box."""

    def __init__(self, points, leaf=LEAF):
        self.order = np.arange(len(points))
        self.spans, self.children, lows, highs = [], [], [], []
        pending = [(0, len(points), None)]
        while pending:
            begin, end, parent = pending.pop()
            node = len(self.spans)
            if parent is not None:
                self.children[parent].append(node)
            rows = self.order[begin:end]
            low, high = points[rows].min(axis=0), points[rows].max(axis=0)
            self.spans.append((begin, end))
            self.children.append([])
            lows.append(low)
            highs.append(high)
            if end - begin > leaf and points.shape[1] and (high > low).any():
                middle = (end - begin) // 2
                widest = int((high - low).argmax())
                self.order[begin:end] = rows[np.argpartition(points[rows, widest], middle)]
                pending += [(begin, begin + middle, node), (begin + middle, end, node)]
        self.lows, self.highs = np.array(lows), np.array(highs)

    def bounds(self, queries):
        """The largest product of each query (row) with any point of each node's box (column)."""
        return np.maximum(queries, 0) @ self.highs.T + np.minimum(queries, 0) @ self.lows.T


def _exact_type(points, queries):
    """float64 where products and their sums are exact in it, Python integers otherwise."""
    largest = [max(abs(int(part.min())), abs(int(part.max()))) if part.size else 0 for part in (points, queries)]
    return np.float64 if largest[0] * largest[1] * max(1, points.shape[1]) < _EXACT else object


def search(points, ids, rows, queries, query_rows, bounds, k):
    """(query position, id, score) of the k best points per query, none below the query's bound; ties to the smaller id.

    A point is no candidate for the query of the same row.
    """
    kind = _exact_type(points, queries)
    tree = Tree(points)
    points, ids, rows = points[tree.order].astype(kind), ids[tree.order], rows[tree.order]
    tree.lows, tree.highs = tree.lows.astype(kind), tree.highs.astype(kind)
    queries = queries.astype(kind)
    reach = tree.bounds(queries)
    for q in range(len(queries)):
        kth = bounds[q]
        scores, found = np.empty(0, kind), np.empty(0, np.int64)
        heap = [(-reach[q, 0], 0)]
        while heap:
            best, node = heapq.heappop(heap)
            if kth is not None and -best < kth:
                break
            if tree.children[node]:
                for child in tree.children[node]:
                    if kth is None or reach[q, child] >= kth:
                        heapq.heappush(heap, (-reach[q, child], child))
                continue
            begin, end = tree.spans[node]
            near = points[begin:end] @ queries[q]
            take = rows[begin:end] != query_rows[q]
            if kth is not None:
                take &= near >= kth
            scores, found = np.concatenate([scores, near[take]]), np.concatenate([found, ids[begin:end][take]])
            if len(scores) > k:
                kept = np.lexsort((found, -scores))[:k]
                scores, found = scores[kept], found[kept]
            if len(scores) == k:
                lowest = scores.min()
                kth = lowest if kth is None else max(kth, lowest)
        for score, vec_id in zip(scores.tolist(), found.tolist(), strict=True):
            yield q, vec_id, int(score)


def _search_task(k):
    def run(queries, candidates):
        if not queries.num_rows or not candidates.num_rows:
            return _found([], [], [], [])
        width = max(int(np.diff(t.column("v").combine_chunks().offsets.to_numpy()).max()) for t in (queries, candidates))
        bounds = queries.column("bound").to_pylist()
        hits = list(
            search(
                matrix(candidates.column("v"), width),
                candidates.column("vec_id").fill_null(_LARGEST).to_numpy(),
                candidates.column("row").to_numpy(),
                matrix(queries.column("v"), width),
                queries.column("row").to_numpy(),
                bounds,
                k,
            )
        )
        rows, names = queries.column("row").to_pylist(), queries.column("vec_id").to_pylist()
        return _found(
            [rows[q] for q, _, _ in hits], [names[q] for q, _, _ in hits],
            [None if vec_id == _LARGEST else vec_id for _, vec_id, _ in hits],
            [max(-_LARGEST, min(_LARGEST, score)) for _, _, score in hits],
        )

    return run


_FOUND = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def _found(*columns):
    names = ("query_row", "query_id", "vec_id", "score")
    return pa.table({name: pa.array(column, pa.int64()) for name, column in zip(names, columns, strict=True)})


def top_k(vectors, k=20, every=20, scale=64):
    """query_id, rank, vec_id, score: for each vector with vec_id divisible by `every`, its k best among all other rows.

    Vectors null or with a null or non-finite component take no part; of different lengths, missing components count as 0. A null
    vec_id is no query, and as a candidate loses ties. Rows that repeat a vec_id are candidates for each other and each has a
    list of its own. Fewer than k other rows give shorter lists; an empty table gives none. Scores beyond the range of a long
    are cut to it.
    """
    frames.ship(vectors.sparkSession)
    table = materialize(quantised(vectors, scale), "vectors")
    is_query = F.col("vec_id") % every == 0
    total, asked = table.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    shards, blocks = max(1, -(-total // SHARD_ROWS)), max(1, -(-asked // BLOCK_QUERIES))
    table = table.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    # New column identities, so that the two sides of a cogroup are told apart.
    asking = table.select(*[F.col(name).alias(name) for name in table.columns])
    queries = asking.filter(is_query).withColumn("bound", F.lit(None).cast("bigint"))
    home = queries.groupBy("shard").cogroup(table.groupBy("shard")).applyInArrow(_search_task(k), _FOUND)
    home = materialize(home, "home")
    found = home
    if shards > 1:
        kth = home.groupBy("query_row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
        bounded = queries.drop("bound").join(kth, queries["row"] == kth["query_row"], "left").drop("query_row")
        block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks))
        others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda shard: shard != F.col("shard"))
        asked_there = bounded.withColumn("block", block).withColumn("there", F.explode(others))
        lent = table.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("there", F.col("shard"))
        pairs = asked_there.groupBy(F.col("block").cast("bigint"), F.col("there").cast("bigint"))
        lent_pairs = lent.groupBy(F.col("block").cast("bigint"), F.col("there").cast("bigint"))
        found = home.unionByName(pairs.cogroup(lent_pairs).applyInArrow(_search_task(k), _FOUND))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
