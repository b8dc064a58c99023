"""Dense integer ids for labels, kept as tables instead of label arrays on the driver."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.sources.scratch import materialize

POSITION_BITS = 33  # monotonically_increasing_id keeps the partition number above this bit


def numbered(ordered, label):
    """The rows of a sorted table with their 0-based `place`.

    The sorted rows are written once with their position inside their own partition; partition sizes then turn that
    into a global place. Writing first fixes which row sits in which partition, so a lost executor cannot shift places
    between the two steps. The offsets table has one row per partition.
    """
    written = materialize(ordered.withColumn("spot", F.monotonically_increasing_id()), label)
    written = written.withColumn("part", F.shiftright("spot", POSITION_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written.groupBy("part").agg(F.count("*").alias("rows"))
    offsets = offsets.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    local = F.col("spot").bitwiseAND((1 << POSITION_BITS) - 1)
    return written.join(F.broadcast(offsets), "part").select(*ordered.columns, (F.col("offset") + local).alias("place"))


def label_index(table, column, index):
    """One row per label: the label and its 0-based position by falling frequency, then by label."""
    counts = table.groupBy(column).agg(F.count("*").alias("frequency"))
    placed = numbered(counts.orderBy(F.desc("frequency"), F.asc(column)), f"index-{column}")
    # MLlib needs 32-bit ids; the ANSI cast fails loudly beyond that.
    return placed.select(column, F.col("place").cast("int").alias(index))


def dense_range(spark, size, name="user"):
    """The ids 0..size-1."""
    return spark.range(size).select(F.col("id").alias(name))


def replace_ids(table, user_index, product_index):
    """Rows over (user, item) positions with the original user_id and product_id in their place."""
    keyed = table.join(user_index, F.col("user") == F.col("user_index"))
    named = keyed.join(product_index, F.col("item") == F.col("product_index"))
    rest = [name for name in table.columns if name not in ("user", "item")]
    return named.select("user_id", "product_id", *rest)
