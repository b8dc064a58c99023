"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from pyspark.sql import functions as F

from cartwright.sources.scratch import materialize


def _large_star(edges):
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = materialize(both.groupBy("high").agg(F.least("high", F.min("low")).alias("least")), "least")
    joined = both.join(least, "high").filter(F.col("low") > F.col("high"))
    return joined.select(F.col("low").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(edges):
    # Centres are low here; a high end has few edges, so its group needs no splitting.
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").filter(F.col("low") > F.col("least")).select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.unionByName(least.select("high", F.col("least").alias("low"))).distinct()


def _are_stars(edges):
    """Whether every high end has one edge and no low end is a high end as well."""
    if edges.groupBy("high").count().filter("count > 1").take(1):
        return False
    return not edges.join(edges.select(F.col("high").alias("other")), F.col("low") == F.col("other"), "left_semi").take(1)


def components(edges):
    """node, component (its least node) for every node of the edges (a, b); nodes may be of any type that sorts.

    Each round is written to the shared folder, so its lineage is one step long. Rounds shrink paths exponentially; the loop
    ends when only stars are left. Loops (a = b) and repeated edges are allowed; nodes without edges don't appear.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    current = materialize(edges.filter("a <> b").select(high.alias("high"), low.alias("low")).distinct(), "edges")
    while not _are_stars(current):
        current = materialize(_small_star(materialize(_large_star(current), "large")), "small")
    members = current.select(F.col("high").alias("node"), F.col("low").alias("component"))
    centres = current.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return members.unionByName(centres)
