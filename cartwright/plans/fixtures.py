"""Maps the given star-schema tables onto commerce events, so that every query runs over them."""

from pyspark.sql import functions as F


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column):
    return F.col(column).cast("string")


def numbered_events(spark, sf_dir):
    """Clicks joined to the product named in their properties, ids still numeric."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    return events.join(table(spark, sf_dir, "part"), F.col("k") == F.col("p_partkey"))


def raw_events(spark, sf_dir):
    """Dirty raw events: unparsable times, unknown kinds, missing products, users, brands, categories and prices."""

    def gap(every, value):
        return F.when(F.col("event_id") % every != 0, value)

    return numbered_events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 31 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss 'UTC'"))
        .alias("event_time"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        gap(29, text("p_partkey")).alias("product_id"),
        F.col("p_type").alias("category_id"),
        gap(7, F.concat("p_type", F.lit("."), "p_name")).alias("category_code"),
        gap(13, F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("brand"),
        gap(11, F.col("value")).alias("price"),
        gap(23, text("user_id")).alias("user_id"),
        F.concat(text("user_id"), F.lit("-"), F.col("ts").cast("date").cast("string")).alias("user_session"),
    )


def raw_records(spark, sf_dir):
    """The dirty events as message records."""
    fields = [
        "event_id", "event_time", "event_type", "product_id", "category_id",
        "category_code", "brand", "price", "user_id", "user_session",
    ]
    return raw_events(spark, sf_dir).select(
        F.col("product_id").cast("binary").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.timestamp_seconds(F.col("event_id")).alias("timestamp"),
    )


def commerce_events(spark, sf_dir):
    """Order lines as clean silver-shaped events."""
    # Dealt over the tasks: the given lines are one file, which would stay one scan partition where the joins are broadcast.
    # By the key of the first join and before texts are added, so that a join by shuffle takes the rows as they are dealt.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag", "l_shipdate"
    ).repartition("l_orderkey")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select(
        text("l_partkey").alias("product_id"),
        F.col("p_type").alias("category_id"),
        F.when(F.col("l_partkey") % 13 == 0, "unknown").otherwise(F.lower("p_type")).alias("category_code"),
        F.when(F.col("l_partkey") % 17 == 0, "unknown").otherwise(F.lower("p_brand")).alias("brand"),
        F.col("l_extendedprice").alias("price"),
        text("o_custkey").alias("user_id"),
        text("l_orderkey").alias("user_session"),
        F.when(F.col("l_returnflag") == "R", "view")
        .when(F.col("l_returnflag") == "A", "cart")
        .otherwise("purchase")
        .alias("event_type"),
        F.col("l_shipdate").alias("event_timestamp"),
    )
