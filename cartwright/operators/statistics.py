"""Product, category and brand statistics over silver events.

All of them start from one table, the activity: one row per product, user and session with its counts, price sums and
bounds. It takes one pass over the events and one shuffle on keys that no single product or user decides; ratings start
from it too. Exact distinct counts are taken one column at a time, first shuffled on (group, counted value) and only then
on the group, so a group holding a third of all events is spread over all tasks and no row is copied. The users of a
category or brand are each counted at one of its products; its statistics are then plain sums over product rows.

A long activity is written in slices by product, and the numbers of its products are taken slice by slice, each written before
the next begins: only one slice's shuffle lies on disk at a time. Every row is still read and every number exact.
"""

from pyspark.sql import functions as F

from cartwright import schema
from cartwright.functions import cleaning, metrics
from cartwright.sources import scratch


CATEGORY_KEYS, BRAND_KEYS = ("category_id", "category_code"), ("brand",)
COUNTERS = ("total_events", "view_count", "cart_count", "purchase_count")
KNOWN_BRAND = "brand <> 'unknown'"
#: Events from which on the activity is cut into slices, one for each so many rows up to SLICES. More would shrink the largest
#: shuffle further, but each slice scans the events and the user columns of the activity once more.
SLICE_ROWS, SLICES = 2_000_000, 4
SLICE = "activity_slice"


def event_counts(events, keys=schema.PRODUCT_KEYS):
    return events.groupBy(*keys).agg(*product_counters())


def product_counters():
    return [
        F.count("*").alias("total_events"),
        metrics.tally("view").alias("view_count"),
        metrics.tally("cart").alias("cart_count"),
        metrics.tally("purchase").alias("purchase_count"),
    ]


def price_stats():
    return [
        metrics.exact_mean("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    ]


def time_bounds(first, last):
    return [F.min("event_timestamp").alias(first), F.max("event_timestamp").alias(last)]


def with_rates(stats):
    return stats.withColumns(
        {
            "view_to_cart_rate": metrics.ratio_or_zero("cart_count", "view_count"),
            "cart_to_purchase_rate": metrics.ratio_or_zero("purchase_count", "cart_count"),
            "view_to_purchase_rate": metrics.ratio_or_zero("purchase_count", "view_count"),
        }
    )


def with_scores(stats):
    return stats.withColumns(
        {"popularity_score": metrics.popularity(), "engagement_score": metrics.engagement_score()}
    )


def stamped(table, as_of=None):
    return table.withColumn("created_timestamp", cleaning.moment(as_of))


ACTIVITY_KEYS = (*schema.PRODUCT_KEYS, "user_id", "user_session")


def activity(events, extra=()):
    """One row per product, user and session (and further keys). Write it once and hand it to everything that follows."""
    parts = [part.alias(name) for name, part in metrics.mean_parts().items()]
    weight = F.sum(metrics.event_weight()).alias("weight")
    bounds = time_bounds("first_seen", "last_seen")
    return events.groupBy(*ACTIVITY_KEYS, *extra).agg(*product_counters(), weight, *parts, *bounds)


def _in_slice(column, number, slices):
    return F.pmod(F.xxhash64(column), F.lit(slices)) == number


def written_activity(events):
    """The activity of the events as a written table; a long one in slices by product, named in the column SLICE."""
    spark = events.sparkSession
    slices = min(SLICES, -(-events.count() // SLICE_ROWS))
    if slices <= 1:
        return scratch.materialize(activity(events), "activity")
    folder = scratch.scratch_path(spark, "activity")
    for number in range(slices):
        own = activity(events.filter(_in_slice("product_id", number, slices)))
        scratch.write_table(own, f"{folder}/{SLICE}={number}")
    return scratch.read_slices(spark, folder, own, SLICE)


def merged_activity(days):
    """One activity from those of several days or other parts of the events."""
    return days.groupBy(*ACTIVITY_KEYS).agg(*_summed((*COUNTERS, "weight")), *_summed_parts(), *_seen())


def _summed(names=COUNTERS):
    return [F.sum(name).alias(name) for name in names]


def _summed_parts():
    sums = [F.sum(name).alias(name) for name in ("price_count", "whole_count", "whole_sum", "plain_sum")]
    return [*sums, F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price")]


def _attributed(base, level, name):
    """Per product, how many users of its category or brand are counted at this product: every user at exactly one.

    A user's home within the group is the least of the products the user met there, so the numbers of a group's products
    add up to its distinct users. Both steps add up within each task before they shuffle.
    """
    inner = [key for key in schema.PRODUCT_KEYS if key not in level]
    homes = base.filter("user_id IS NOT NULL").groupBy(*level, "user_id").agg(F.min(F.struct(*inner)).alias("home"))
    return homes.select(*level, "home.*").groupBy(*schema.PRODUCT_KEYS).agg(F.count("*").alias(name))


def _product_numbers(sums, *sides):
    """One row per product from the sums and from further numbers; a union and one more sum, as keys may be null."""
    numbers = [name for side in sides for name in side.columns if name not in schema.PRODUCT_KEYS]
    together = sums
    for side in sides:
        together = together.unionByName(side, allowMissingColumns=True)
    whole = together.groupBy(*schema.PRODUCT_KEYS).agg(*_summed((*COUNTERS, "unique_sessions", *numbers)), *_summed_parts(), *_seen())
    return whole.fillna(0, numbers)


def product_parts(base):
    """One row per product with numbers that all add up: what products, categories and brands need, distinct users included.

    `base` is the activity. Distinct counts take one column at a time: rows shuffle on product and counted value, then on the
    product, so none is copied. From an activity in slices each of the numbers is written by itself, slice by slice.
    """
    made = [make(base) for make, _ in _NUMBERS] if SLICE not in base.columns else _written_numbers(base)
    return _product_numbers(*made)


def _sums_and_sessions(base):
    sessions = F.count_distinct("user_session").alias("unique_sessions")
    return base.groupBy(*schema.PRODUCT_KEYS).agg(*_summed(), *_summed_parts(), *_seen(), sessions)


def _category_users(base):
    return _attributed(base, CATEGORY_KEYS, "category_users")


def _brand_users(base):
    return _attributed(base.filter(KNOWN_BRAND), BRAND_KEYS, "brand_users")


def _written_numbers(base):
    """Each of _NUMBERS as a written table. A user's home is found in the slice of the user, hence over all of its products."""
    spark = base.sparkSession
    slices = sorted(row[0] for row in base.select(SLICE).distinct().collect())
    written = []
    for make, column in _NUMBERS:
        folder = scratch.scratch_path(spark, "numbers")
        for place, number in enumerate(slices):
            own = F.col(SLICE) == number if column == "product_id" else _in_slice(column, place, len(slices))
            numbers = make(base.filter(own))
            scratch.write_table(numbers, f"{folder}/part={number}")
        written.append(scratch.read_slices(spark, folder, numbers, "part").drop("part"))
    return written


def _users_of(table):
    return table.groupBy(*schema.PRODUCT_KEYS).agg(F.count_distinct("user_id").alias("unique_users"))


#: The tables that product parts are put together from, and the column by which each may be made in slices.
_NUMBERS = (
    (_sums_and_sessions, "product_id"), (_users_of, "product_id"), (_category_users, "user_id"), (_brand_users, "user_id"),
)


def _seen():
    return [F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")]


def _product_table(grouped, as_of):
    priced = grouped.select(
        *schema.PRODUCT_KEYS, *COUNTERS, "unique_users", "unique_sessions", metrics.mean_of_parts().alias("avg_price"),
        "min_price", "max_price", "first_seen", "last_seen",
    )
    return stamped(with_scores(with_rates(priced)), as_of)


def product_statistics(events, as_of=None, approximate=False, base=None, parts=None):
    """`base` is the activity of the events and `parts` are its product parts, where they are at hand.

    `approximate` takes sketches for distinct users and sessions, in one aggregate.
    """
    if parts is None and base is not None:
        parts = _sketched(base) if approximate else product_parts(base)
    elif parts is None:
        # Straight from the events: without categories and brands there is nothing to share an activity for.
        distinct = F.approx_count_distinct if approximate else F.count_distinct
        means = [part.alias(name) for name, part in metrics.mean_parts().items()]
        numbers = [*product_counters(), *means, *time_bounds("first_seen", "last_seen"), distinct("user_session").alias("unique_sessions")]
        if approximate:
            parts = events.groupBy(*schema.PRODUCT_KEYS).agg(*numbers, distinct("user_id").alias("unique_users"))
        else:
            parts = _product_numbers(events.groupBy(*schema.PRODUCT_KEYS).agg(*numbers), _users_of(events))
    return _product_table(parts, as_of)


def _sketched(base):
    sketches = [F.approx_count_distinct(f"user_{kind}").alias(name) for kind, name in (("id", "unique_users"), ("session", "unique_sessions"))]
    return base.groupBy(*schema.PRODUCT_KEYS).agg(*_summed(), *sketches, *_summed_parts(), *_seen())


def _group_statistics(base, parts, keys, counted, users, mean, as_of, approximate):
    """Statistics per `keys`; `counted` names the distinct counts besides users. All but sketches come from product parts."""
    source = parts
    distinct, total = F.count_distinct, F.sum(users)
    if approximate:
        source, distinct, total = base, F.approx_count_distinct, F.approx_count_distinct("user_id")
    table = source.groupBy(*keys).agg(
        *[distinct(column).alias(name) for name, column in counted.items()],
        F.sum("total_events").alias("total_events"),
        F.sum("view_count").alias("total_views"),
        F.sum("cart_count").alias("total_carts"),
        F.sum("purchase_count").alias("total_purchases"),
        total.alias("unique_users"),
        F.min("first_seen").alias("first_activity"),
        F.max("last_seen").alias("last_activity"),
        *_summed_parts(),
    )
    shown = ("total_events", "total_views", "total_carts", "total_purchases", "unique_users")
    priced = table.withColumn(mean, metrics.mean_of_parts())
    return stamped(priced.select(*keys, *counted, *shown, mean, "first_activity", "last_activity"), as_of)


def _sources(events, base, parts, approximate):
    if base is None and (parts is None or approximate):
        base = activity(events)
    return base, product_parts(base) if parts is None and not approximate else parts


def category_statistics(events, as_of=None, approximate=False, base=None, parts=None):
    """Per category; `base` and `parts` are the activity and the product parts of the events where at hand."""
    counted = {"product_count": "product_id", "brand_count": "brand"}
    base, parts = _sources(events, base, parts, approximate)
    return _group_statistics(base, parts, CATEGORY_KEYS, counted, "category_users", "avg_category_price", as_of, approximate)


def brand_statistics(events, as_of=None, approximate=False, base=None, parts=None):
    """Per known brand; `base` and `parts` are the activity and the product parts of the events where at hand."""
    counted = {"product_count": "product_id", "category_count": "category_id"}
    base, parts = (None if table is None else table.filter(KNOWN_BRAND) for table in _sources(events, base, parts, approximate))
    return _group_statistics(base, parts, BRAND_KEYS, counted, "brand_users", "avg_brand_price", as_of, approximate)


def distinct_counts(events, group, columns):
    """Distinct values of each column per group, from one distinct table per column: no event is copied."""
    table = events.select(group).distinct()
    for column in columns:
        own = events.select(group, column).distinct().groupBy(group).agg(F.count(column).alias(f"unique_{column}"))
        own = own.withColumnRenamed(group, "own")
        table = table.join(own, table[group].eqNullSafe(own["own"])).drop("own")
    return table


def row_counts(tables):
    """One row per named table with its number of rows."""
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    first, *rest = counted
    for part in rest:
        first = first.unionByName(part)
    return first
