"""Orders, positions and percentiles that stay distributed, with ties broken on the keys."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright import schema
from cartwright.functions import metrics
from cartwright.operators.statistics import stamped

# A BIGINT measure is cut into stripes of 2**16 neighbouring values. A window over one stripe then holds at most 65,536
# distinct values, and the list of stripes is as short again for any measure below 2**32.
STRIPE_BITS = 16

RANKING_COLUMNS = ("product_id", "category_code", "brand", "avg_price", "rank_type", "rank_value")


def top_products(stats, rank_type, size=schema.RANKING_SIZE):
    """The `size` products with the highest value of one ranking's measure, as ranking rows."""
    measure = schema.RANKINGS[rank_type]
    ordered = stats.orderBy(F.desc(measure), *[F.asc(key) for key in schema.PRODUCT_KEYS])
    return ordered.limit(size).select(
        "product_id", "category_code", "brand", "avg_price",
        F.lit(rank_type).alias("rank_type"),
        F.col(measure).alias("rank_value"),
    )


def offers(stats):
    """Each product once per list, with the list's measure."""
    entries = [
        F.struct(F.lit(name).alias("rank_type"), F.col(measure).alias("rank_value"))
        for name, measure in schema.RANKINGS.items()
    ]
    return stats.select(*schema.PRODUCT_KEYS, "avg_price", F.inline(F.array(*entries)))


def best_of_each(offered, size=schema.RANKING_SIZE):
    """The `size` best offers of every list, with their position.

    Each list is cut by its own sort and limit, which keeps `size` rows per partition however long the lists are; the window
    then runs over what is left.
    """
    best = None
    for name in schema.RANKINGS:
        own = offered.filter(F.col("rank_type") == name)
        own = own.orderBy(F.desc("rank_value"), *schema.PRODUCT_KEYS).limit(size)
        best = own if best is None else best.unionByName(own)
    order = Window.partitionBy("rank_type").orderBy(F.desc("rank_value"), *schema.PRODUCT_KEYS)
    return best.withColumn("position", F.row_number().over(order))


def product_rankings(stats, as_of=None, size=schema.RANKING_SIZE):
    """All ranking lists from the (small) statistics, a sort with a limit per list."""
    return stamped(best_of_each(offers(stats), size).select(*RANKING_COLUMNS), as_of)


def with_rows_below(table, measure, groups=(), weight=None):
    """Adds `rows_below` and `rows_total`: the rows of the same group with a smaller measure, and all rows of the group.

    `table` holds one row per (groups, measure); `weight` names its row-count column (one row each without it). Running
    totals are taken within stripes of the measure and over the list of stripes, so no task sees a whole group.
    """
    groups = list(groups)
    weight = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    striped = table.withColumns({"stripe": F.shiftright(measure, STRIPE_BITS), "stripe_weight": weight})
    over_stripes = Window.partitionBy(*groups).orderBy("stripe").rowsBetween(Window.unboundedPreceding, -1)
    stripes = (
        striped.groupBy(*groups, "stripe")
        .agg(F.sum("stripe_weight").alias("stripe_rows"))
        .select(
            *groups,
            "stripe",
            F.coalesce(F.sum("stripe_rows").over(over_stripes), F.lit(0)).alias("rows_before"),
            F.sum("stripe_rows").over(Window.partitionBy(*groups)).alias("rows_total"),
        )
    )
    in_stripe = Window.partitionBy(*groups, "stripe").orderBy(measure).rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("rows_before") + F.coalesce(F.sum("stripe_weight").over(in_stripe), F.lit(0))
    return (
        striped.join(stripes, [*groups, "stripe"])
        .withColumn("rows_below", below)
        .select(*table.columns, "rows_below", "rows_total")
    )


def with_percent_rank(table, measure="popularity_score", output="popularity_percentile"):
    """percent_rank() over all rows by a BIGINT measure, from the counts of its distinct values."""
    values = table.groupBy(measure).agg(F.count("*").alias("rows"))
    share = F.when(F.col("rows_total") > 1, F.col("rows_below") / (F.col("rows_total") - 1)).otherwise(F.lit(0.0))
    ranked = with_rows_below(values, measure, weight="rows").select(measure, share.alias(output))
    return table.join(ranked, measure).select(*table.columns, output)


FEATURE_COLUMNS = (
    "product_id", "category_id", "category_code", "brand", "avg_price", "view_count", "cart_count", "purchase_count",
    "popularity_score", "view_to_cart_rate", "cart_to_purchase_rate", "view_to_purchase_rate", "unique_users",
    "engagement_score",
)


def recommendation_features(stats, as_of=None):
    """Product measures with the popularity percentile and both tiers."""
    ranked = with_percent_rank(stats.select(*FEATURE_COLUMNS))
    tiers = {"price_tier": metrics.price_tier(), "engagement_tier": metrics.engagement_tier()}
    return stamped(ranked.withColumns(tiers), as_of)
