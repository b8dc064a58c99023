"""Batch writers."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from cartwright import schema
from cartwright.sources import scratch


def parquet_object(df, path):
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def csv_object(df, path):
    """CSV with a header; blanks around a value are part of it and quotes inside it are doubled."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def silver_table(events, path, compact=False):
    """Overwrites silver, one folder per processing date and event type.

    The write needs no shuffle: each task adds at most one file per event type. `compact` shuffles first and lets the
    adaptive planner cut the folders into files of even size, however large one folder is.
    """
    if compact:
        events = events.hint("rebalance", *schema.SILVER_PARTITIONS)
    events.write.mode("overwrite").partitionBy(*schema.SILVER_PARTITIONS).parquet(path)


def gold_table(df, gold_path, name, cluster_by=None):
    """Overwrites a gold table and returns its number of rows, counted while writing.

    `cluster_by` sorts the files by those columns, so that a look-up by them skips all but a few row groups. Its range
    shuffle samples the table first, so a table that is costly to make should be handed in written.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    rows = Observation(f"rows of {name}")
    with scratch.brief_shuffles(df.sparkSession):
        df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "snappy").parquet(
            f"{gold_path}/{name}"
        )
    return rows.get.get("rows", 0)


def recommendation_tables(recommendations, similar, gold_path):
    """Overwrites both recommendation tables and returns their numbers of rows."""
    return {
        "user_recommendations": gold_table(recommendations, gold_path, "user_recommendations", ["user_id"]),
        "similar_products": gold_table(similar, gold_path, "similar_products", ["product_id"]),
    }


def models(als_model, clustering_model, gold_path):
    als_model.write().overwrite().save(f"{gold_path}/models/als_model")
    clustering_model.write().overwrite().save(f"{gold_path}/models/clustering_model")
