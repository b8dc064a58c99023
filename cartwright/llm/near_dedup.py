"""Near-duplicate documents by a chosen-path set similarity join over word shingles.

Every document's shingle set goes down several independent trees. A node's children are named by the least shingle of the
set under a hash of the level, so similar sets keep company with a chance equal to their similarity per level. A tree starts at
two levels; nodes of at most LEAF sets are compared exhaustively, larger ones branch on, twofold, so that a similar pair is
not lost by the extra levels. The chance that a pair at the threshold meets in no tree is (1 - 0.85^2)^16, about 1e-9,
for nodes of at most LEAF sets after two levels; README gives the bounds for pairs whose nodes stay larger.

Nothing the trees do decides a link. They give coarse clusters that hold every true link; each cluster's full sets are then
compared exactly, within one task or block against block, and components of the exact links are the result. Sets that are
equal are one class from the start, so thousands of copies cost as much as one document.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cartwright.llm import frames
from cartwright.llm.components import components
from cartwright.sources.scratch import materialize

TREES = 16
#: Minwise values per set: two per tree for the first levels, the others for deeper levels and for the sketch.
LANES = 48
FIRST_LEVELS = 2
#: Sets a node may hold and still be compared pair by pair.
LEAF = 1024
#: Levels with two children per node; below, one.
TWOFOLD_LEVELS = 4
DEEPEST = 12
#: Sets and shingles that one side of an exact comparison holds.
BLOCK_SETS = 128
BLOCK_SHINGLES = 1 << 18
#: Bits of the filter that spares texts nobody asks for the shuffle: 2 MB, whatever the table. A full filter lets all texts pass.
FILTER_BITS = 1 << 24

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(values):
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return (values ^ (values >> np.uint64(29))) * _MIX2 ^ (values >> np.uint64(31))


_LANE_FACTORS = _mixed(np.arange(1, LANES + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_set(raw, words):
    """Sorted distinct 64-bit hashes of the word shingles of UTF-8 bytes; bytes.split and bytes.lower go by ASCII alone."""
    parts = raw.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts), seed=len(parts))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    count = len(parts) - words + 1
    joined = np.zeros(count, np.uint64)
    for k in range(words):
        joined = _mixed(joined + hashes[k : k + count])
    return np.unique(joined)


def minwise(shingles):
    """LANES 32-bit values: for each lane the least shingle under the lane's hash, hashed once more."""
    least = np.full(LANES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        np.minimum(least, np.multiply.outer(_LANE_FACTORS, shingles[start : start + 2048]).min(axis=1), out=least)
    return (_mixed(least) >> np.uint64(32)).astype(np.uint32)


def set_digest(shingles):
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _marks():
    """One byte per lane, enough to estimate similarity by: the low bytes of little-endian lanes."""
    return F.concat(*[F.substring("lanes", 4 * lane + 1, 1) for lane in range(LANES)]).alias("marks")


def _with_key(docs):
    """doc_id, text and 128 bits that stand for the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "text", F.xxhash64(text).alias("text_key"), F.xxhash64(F.lit(1), text).alias("text_check"))


def signatures(docs, words):
    """doc_id, n_shingles, class (digest of the set; null if it is empty), lanes, text_key and text_check per document."""

    def run(batches):
        for batch in frames.bounded(batches):
            counts, classes, lanes = [], [], []
            for raw in frames.raw_texts(batch.column(1)):
                shingles = shingle_set(raw, words)
                counts.append(len(shingles))
                classes.append(set_digest(shingles) if len(shingles) else None)
                lanes.append(minwise(shingles).tobytes() if len(shingles) else None)
            yield frames.record(
                {
                    "doc_id": batch.column(0), "n_shingles": counts, "class": pa.array(classes, pa.binary()),
                    "lanes": pa.array(lanes, pa.binary()), "text_key": batch.column(2),
                    "text_check": batch.column(3),
                }
            )

    schema = f"doc_id {frames.id_type(docs)}, n_shingles bigint, class binary, lanes binary, text_key bigint, text_check bigint"
    return frames.map_arrow(_with_key(docs), run, schema)


def _lane_matrix(column):
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, LANES)


def _mark_matrix(column):
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, LANES)


def _node_keys(before, lanes, tree, level, child):
    """Keys of the children of nodes: the path so far and the lane that this tree reads at this level for this child."""
    salt = _mixed(np.array([(tree * 64 + level) * 4 + child + 1], np.uint64))
    lane = (2 * tree + level - 1) if level <= FIRST_LEVELS else (2 * tree + 5 * level + 16 * child + 1) % LANES
    return _mixed(before + _mixed(lanes[:, lane].astype(np.uint64) + salt))


def _first_nodes(classes):
    """node, tree, number: every class at the first levels of every tree."""

    def run(batches):
        for batch in frames.bounded(batches, 2 << 20):
            lanes = _lane_matrix(batch.column(1))
            for tree in range(TREES):
                keys = np.full(len(lanes), tree, np.uint64)
                for level in range(1, FIRST_LEVELS + 1):
                    keys = _node_keys(keys, lanes, tree, level, 0)
                yield frames.record(
                    {"node": pa.array(keys.view(np.int64)), "tree": pa.array(np.full(len(keys), tree, np.int32)), "number": batch.column(0)}
                )

    return frames.map_arrow(classes.select("number", "lanes"), run, "node bigint, tree int, number bigint")


def _next_nodes(large, level):
    """node, tree, number, parent_size of the children of large nodes, given with their lanes."""
    children = 2 if level <= TWOFOLD_LEVELS else 1

    def run(batches):
        for batch in frames.bounded(batches, 2 << 20):
            lanes, trees = _lane_matrix(batch.column(3)), batch.column(1).to_numpy()
            before = batch.column(0).to_numpy().view(np.uint64)
            for child in range(children):
                keys = np.empty(len(before), np.uint64)
                for tree in np.unique(trees).tolist():
                    chosen = trees == tree
                    keys[chosen] = _node_keys(before[chosen], lanes[chosen], tree, level, child)
                yield frames.record(
                    {"node": pa.array(keys.view(np.int64)), "tree": batch.column(1), "number": batch.column(2), "parent_size": batch.column(4)}
                )

    return frames.map_arrow(large.select("node", "tree", "number", "lanes", "size"), run, "node bigint, tree int, number bigint, parent_size bigint")


class Joined:
    """Union-find over the positions of one group."""

    def __init__(self, count):
        self.up = list(range(count))

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j):
        self.up[self.root(j)] = self.root(i)


def _forest(lanes, least, accept):
    """Pairs (i, j) of a spanning forest of the pairs that share `least` lanes and that `accept` takes."""
    count = len(lanes)
    joined = Joined(count)
    for i in range(count - 1):
        shared = (lanes[i + 1 :] == lanes[i]).sum(axis=1)
        for j in (np.nonzero(shared >= least)[0] + i + 1).tolist():
            if joined.root(i) != joined.root(j) and accept(i, j):
                joined.join(i, j)
                yield i, j


def _groups(batches):
    """Runs of equal keys (first column) of sorted rows, as record batches; a run may span several batches."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        keys = batch.column(0).to_numpy()
        if not len(keys):
            continue
        starts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1])
        for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            yield batch.slice(begin, end - begin)
        held = batch.slice(int(starts[-1]))
    if held is not None and held.num_rows:
        yield held


def _edge_batches(pairs):
    left, right = [], []
    for a, b in pairs:
        left.append(a)
        right.append(b)
        if len(left) >= 10_000:
            yield frames.record({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})
            left, right = [], []
    yield frames.record({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def _leaf_edges(members, least):
    """Edges between the classes of a leaf whose sketches agree; a spanning forest, so never more than the leaf has members."""

    def run(batches):
        def pairs():
            for group in _groups(batches):
                names = group.column(1).to_pylist()
                for i, j in _forest(_mark_matrix(group.column(2)), least, lambda i, j: names[i] != names[j]):
                    yield names[i], names[j]

        yield from _edge_batches(pairs())

    rows = members.select("node", "number", "marks").repartition("node").sortWithinPartitions("node", "number")
    return frames.map_arrow(rows, run, "a bigint, b bigint")


def _coarse_edges(classes, least):
    """Edges whose components hold every pair that meets in a leaf of any tree.

    A child that keeps more than half of a large parent is a group of near copies, which more levels would not take apart; its
    members, as those of large nodes at the last level, become one cluster without being compared.
    """
    lanes = classes.select("number", "lanes", "marks")
    members = materialize(_first_nodes(classes).withColumn("parent_size", F.lit(None).cast("bigint")), "nodes")
    found, level = [], FIRST_LEVELS
    while True:
        sizes = members.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.max("parent_size").alias("parent"))
        sizes = materialize(sizes.filter("size > 1"), "sizes")
        star = F.lit(level >= DEEPEST) | F.coalesce(F.col("size") * 2 > F.col("parent"), F.lit(False))
        # Merge joins at every size: what is small here is not where the operator is needed.
        small = members.join(sizes.filter(F.col("size") <= LEAF).select("node").hint("merge"), "node").select("node", "number")
        found.append(materialize(_leaf_edges(small.join(lanes.select("number", "marks").hint("merge"), "number"), least), "leaves"))
        large = sizes.filter(F.col("size") > LEAF)
        if large.isEmpty():
            break
        near = members.join(large.filter(star).select("node"), "node").select("node", "number")
        centres = near.groupBy("node").agg(F.min("number").alias("first"))
        found.append(near.join(centres, "node").select(F.col("first").alias("a"), F.col("number").alias("b")))
        # One row per class that branches on, with its few nodes: lanes of all other classes stay behind at this level.
        mixed = members.join(large.filter(~star).select("node", "size"), "node").groupBy("number")
        mixed = mixed.agg(F.collect_list(F.struct("node", "tree", "size")).alias("nodes"))
        mixed = materialize(mixed.join(lanes.hint("merge"), "number"), "branching")
        level += 1
        members = materialize(_next_nodes(mixed.select("number", "lanes", F.inline("nodes")), level), "nodes")
        lanes = mixed.select("number", "lanes", "marks")
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


def _filter_places(key):
    return [F.pmod(place, F.lit(FILTER_BITS)) for place in (key, F.shiftrightunsigned(key, 32))]


def _wanted_filter(wanted):
    """A Bloom filter over the text keys of the wanted classes: FILTER_BITS bits in words of 64, put together by the executors."""
    places = wanted.select(F.explode(F.array(*_filter_places(F.col("text_key")))).alias("place"))
    word, bit = F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, int(place & 63))")
    words = places.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bits.view(np.uint64)


def _wanted_texts(docs, wanted):
    """text, class, number, cluster, blocks of one document per wanted class.

    The filter drops texts where they lie; a false positive costs its way through the shuffle and is dropped by the join. The
    join is on text key and doc_id, of which every class wants one pair, so null and repeated ids give no extra rows; of
    repeated rows each task lets one through.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(_wanted_filter(wanted))

    def run(batches):
        seen = set()

        def first(*row):
            known = row in seen
            seen.add(row)
            return not known

        for batch in frames.bounded(batches):
            keys = batch.column(2).to_numpy().view(np.uint64)
            passed = np.ones(len(keys), bool)
            for places in (keys % np.uint64(FILTER_BITS), (keys >> np.uint64(32)) % np.uint64(FILTER_BITS)):
                passed &= (held.value[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).astype(bool)
            batch = batch.filter(pa.array(passed))
            rows = (batch.column(i).to_pylist() for i in (2, 3, 0))
            yield batch.filter(pa.array(list(map(first, *rows)), pa.bool_()))

    schema = f"doc_id {frames.id_type(docs)}, text string, text_key bigint, text_check bigint"
    texts = frames.map_arrow(_with_key(docs), run, schema)
    here = wanted.withColumnsRenamed({"text_key": "wanted_key", "text_check": "wanted_check"}).hint("merge")
    met = (texts["text_key"] == here["wanted_key"]) & (texts["text_check"] == here["wanted_check"])
    met &= texts["doc_id"].eqNullSafe(here["bearer"])
    return texts.join(here, met).select("text", "class", "number", "cluster", "blocks")


def _full_sets(docs, wanted, words):
    """cluster, blocks, number, shingles and lanes of the wanted classes, read again from one document each."""

    def run(batches):
        before = None
        for batch in frames.bounded(batches):
            rows = []
            for raw, name, number, cluster, blocks in zip(
                frames.raw_texts(batch.column(0)), *(batch.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True
            ):
                if number == before:  # a repeated row, next to its like after the merge join
                    continue
                shingles = shingle_set(raw, words)
                if len(shingles) and set_digest(shingles) == name:
                    before = number
                    rows.append((cluster, blocks, number, shingles.tobytes(), minwise(shingles).tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            names = ["cluster", "blocks", "number", "shingles", "lanes"]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, types)), names=names)

    schema = "cluster bigint, blocks bigint, number bigint, shingles binary, lanes binary"
    return frames.map_arrow(_wanted_texts(docs, wanted), run, schema).select("cluster", "blocks", "number", "shingles", _marks())


def _exact_edges(sets, percent, least):
    """Links between classes with 100 * intersection >= percent * union, as a spanning forest per pair of blocks."""

    def run(batches):
        def pairs():
            for group in _groups(batches):
                names = group.column(1).to_pylist()
                arrays = [np.frombuffer(raw, np.uint64) for raw in group.column(2).to_pylist()]

                def linked(i, j, arrays=arrays):
                    a, b = arrays[i], arrays[j]
                    small, large = sorted((len(a), len(b)))
                    if 100 * small < percent * large:
                        return False
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    return 100 * common >= percent * (len(a) + len(b) - common)

                for i, j in _forest(_mark_matrix(group.column(3)), least, linked):
                    if names[i] != names[j]:
                        yield names[i], names[j]

        yield from _edge_batches(pairs())

    block = F.pmod(F.xxhash64("number"), F.col("blocks"))
    placed = sets.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    key = F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other"))
    rows = placed.select(key.alias("key"), "number", "shingles", "marks").repartition("key").sortWithinPartitions("key", "number")
    return frames.map_arrow(rows, run, "a bigint, b bigint")


def near_duplicates(docs, words=5, percent=80):
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a document's set holds its distinct shingles of `words`
    words, or its whole sequence if it has fewer. Documents are linked when 100 * intersection >= percent * union; component_id
    is the least doc_id reachable, kept says that it is the document's own. Null text, empty text and white space have the
    empty set, which is linked with nothing. Null doc_ids count as larger than all others. An empty table gives no rows.
    """
    least = LANES * max(percent - 30, 0) // 100
    documents = materialize(signatures(docs, words), "signatures")
    classes = documents.filter("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("holder"), F.max("n_shingles").alias("n_shingles"), F.first("lanes").alias("lanes"),
        F.min(F.struct("text_key", "text_check", F.col("doc_id").alias("bearer"))).alias("bearing"),
    )
    # Numbers stand for digests in all that follows; they are fixed because this table is written once.
    classes = classes.select("*", "bearing.*", _marks(), F.monotonically_increasing_id().alias("number")).drop("bearing")
    classes = materialize(classes, "classes")
    clusters = materialize(components(_coarse_edges(classes, least)).withColumnRenamed("node", "number"), "clusters")
    sized = clusters.join(classes.select("number", "class", "text_key", "text_check", "bearer", "n_shingles"), "number")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("bigint")
    block_counts = materialize(sized.groupBy("component").agg(blocks.alias("blocks")), "blocks")
    wanted = sized.join(block_counts, "component").select(
        "class", "number", "text_key", "text_check", "bearer", F.col("component").alias("cluster"), "blocks"
    )
    wanted = materialize(wanted, "wanted")
    links = components(materialize(_exact_edges(_full_sets(docs, wanted, words), percent, least), "links"))
    linked = links.withColumnRenamed("node", "number").join(classes.select("number", "holder"), "number")
    linked = materialize(linked, "linked")
    heads = materialize(linked.groupBy("component").agg(F.min("holder").alias("head")), "heads")
    heads = linked.join(heads, "component").select("number", "head")
    named = classes.select("number", "class", "holder").join(heads, "number", "left")
    named = materialize(named.select("class", F.coalesce("head", "holder").alias("component_id")), "named")
    return (
        documents.join(named, "class", "left")
        .withColumn("component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "class")
    )


def remove_near_copies(docs, words=5, percent=80):
    """The documents that stay, one per component, with all their columns; a row repeated with its doc_id stays once."""
    digest, row = frames.fresh(docs, "class"), frames.fresh(docs, "row")
    place = docs.columns.index("text")

    def run(batches):
        for batch in frames.bounded(batches):
            values = [set_digest(shingle_set(raw, words)) for raw in frames.raw_texts(batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())], names=[*batch.schema.names, digest])

    empty = F.lit(set_digest(np.empty(0, np.uint64)))
    keep = near_duplicates(docs, words, percent).filter("kept")
    keep = keep.select(F.col("doc_id").alias("keep_doc"), F.coalesce("class", empty).alias("keep_class")).distinct()
    marked = frames.map_arrow(docs, run, StructType([*docs.schema.fields, StructField(digest, BinaryType())]))
    stay = marked.join(keep, (marked[digest] == keep["keep_class"]) & marked["doc_id"].eqNullSafe(keep["keep_doc"]), "left_semi")
    one = Window.partitionBy(digest, "doc_id").orderBy(digest)
    return stay.withColumn(row, F.row_number().over(one)).filter(F.col(row) == 1).select(*docs.columns)
