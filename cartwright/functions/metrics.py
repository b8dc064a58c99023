"""Aggregates and per-row measures over events and product statistics."""

from pyspark.sql import functions as F

from cartwright import schema


def tally(event_type):
    """Events of one kind."""
    return F.count_if(F.col("event_type") == event_type)


def whole_units(column="price", decimals=4):
    """The value as a whole number of 10**-decimals; null where it is not exactly the nearest double of one."""
    unit = float(10**decimals)
    whole = F.rint(F.col(column) * unit).try_cast("bigint")
    return F.when(whole / F.lit(unit) == F.col(column), whole)


def mean_parts(column="price"):
    """What a mean over several groupings is put together from: counts, exact sum, plain sum and bounds."""
    whole = whole_units(column)
    return {
        "price_count": F.count(column),
        "whole_count": F.count(whole),
        # DECIMAL(29,0) after the sum: 10**10 values of the BIGINT range, so no data overflows it.
        "whole_sum": F.sum(whole.cast("decimal(19,0)")),
        "plain_sum": F.sum(column),
        "min_price": F.min(column),
        "max_price": F.max(column),
    }


def mean_of_parts(decimals=4):
    """The mean from summed parts: exact and independent of their order if all values are whole units, plain otherwise.

    Division rounds twice, which can leave the range of the values by a last digit; the bounds put that right.
    """
    exact = F.col("whole_sum").cast("double") / F.lit(float(10**decimals)) / F.col("price_count")
    mean = F.when(F.col("whole_count") == F.col("price_count"), exact).otherwise(F.col("plain_sum") / F.col("price_count"))
    bounded = F.greatest(F.col("min_price"), F.least(F.col("max_price"), mean))
    return F.when(F.col("price_count") > 0, bounded)


def exact_mean(column="price", decimals=4):
    """Mean whose bits do not depend on the order in which partitions are summed, as one aggregate expression.

    Groups of whole multiples of 10**-decimals are summed exactly; a group that holds any other value gets the plain mean.
    """
    whole, value = whole_units(column, decimals), F.col(column)
    exact = F.sum(whole.cast("decimal(19,0)")).cast("double") / F.lit(float(10**decimals)) / F.count(value)
    mean = F.when(F.count(whole) == F.count(value), exact).otherwise(F.avg(value))
    return F.when(F.count(value) > 0, F.greatest(F.min(value), F.least(F.max(value), mean)))


def ratio_or_zero(numerator, denominator):
    return F.when(F.col(denominator) > 0, F.col(numerator) / F.col(denominator)).otherwise(F.lit(0.0))


def popularity():
    weights = schema.EVENT_WEIGHTS
    return (
        F.col("view_count") * weights["view"]
        + F.col("cart_count") * weights["cart"]
        + F.col("purchase_count") * weights["purchase"]
    )


def engagement_score():
    return F.col("unique_users") + F.col("unique_sessions") * F.lit(0.5)


def engagement_rate(events="interaction_count"):
    return F.col("unique_users") / F.col(events)


def event_weight():
    weight = F.lit(0)
    for kind, value in schema.EVENT_WEIGHTS.items():
        weight = F.when(F.col("event_type") == kind, value).otherwise(weight)
    return weight


def tier(column, steps, top):
    """Name of the first step whose bound lies above the value; `top` for everything else, nulls included."""
    bounds = [F.when(F.col(column) < bound, F.lit(name)) for name, bound in steps]
    return F.coalesce(*bounds, F.lit(top))


def price_tier(column="avg_price"):
    return tier(column, schema.PRICE_TIERS, schema.TOP_PRICE_TIER)


def engagement_tier(column="engagement_score"):
    return tier(column, schema.ENGAGEMENT_TIERS, schema.TOP_ENGAGEMENT_TIER)


def similarity(gap="score_diff"):
    return F.lit(1.0) / (F.lit(1.0) + F.col(gap) / F.lit(1000.0))


def match_score():
    """Share shown beside a recommended product: 0.1 per view, 2 per cart, 5 per purchase, within 10 to 100."""
    points = (
        F.coalesce("view_count", F.lit(0)) * F.lit(0.1)
        + F.coalesce("cart_count", F.lit(0)) * F.lit(2)
        + F.coalesce("purchase_count", F.lit(0)) * F.lit(5)
    )
    return F.greatest(F.lit(10), F.least(F.lit(100), F.floor(points + F.lit(0.5))))
