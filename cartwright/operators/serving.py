"""Look-up and search queries over the gold tables. Filters reach the parquet scan; only the answer leaves the executors."""

import re

from pyspark.errors import SparkRuntimeException
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright import schema

#: Escaped characters stay (group 1); (?P<name> and (?P=name) and {,n are spelled differently in Java.
_JAVA_SPELLING = re.compile(r"(\\.)|\(\?P<(\w+)>|\(\?P=(\w+)\)|\{(?=,\d+\}),", re.DOTALL)
TIE_KEYS = ("product_id", "category_id", "category_code", "brand")


def _ties(table):
    return [F.asc(key) for key in TIE_KEYS if key in table.columns]


def _none(table):
    return table.filter(F.lit(False))


def _spark_pattern(spark, pattern):
    """The pattern as Spark reads it, or None where Python refuses it.

    Named groups and counts without a lower bound are spelled as Java wants them. What Python accepts and Spark does not is
    an error that names the pattern; checked on a constant, without touching a table.
    """
    try:
        re.compile(pattern)
    except re.error:
        return None
    spelled = _JAVA_SPELLING.sub(lambda m: m[1] or (f"(?<{m[2]}>" if m[2] else f"\\k<{m[3]}>" if m[3] else "{0,"), pattern)
    try:
        spark.sql("SELECT '' RLIKE :pattern", args={"pattern": spelled}).collect()
    except SparkRuntimeException as error:
        if error.getCondition() != "INVALID_PARAMETER_VALUE.PATTERN":
            raise
        raise ValueError(f"Spark does not take the search pattern {pattern!r}") from error
    return spelled


def _matches(column, pattern, literal):
    hit = F.contains(F.col(column), F.lit(pattern)) if literal else F.rlike(F.col(column), F.lit(pattern))
    return F.coalesce(hit, F.lit(False))


def _given(value):
    return value is not None and value != ""


def product_statistics(stats):
    return stats


def top_products(rankings, metric="most_viewed", limit=10):
    if metric not in schema.RANKINGS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {', '.join(schema.RANKINGS)}")
    chosen = rankings.filter(F.col("rank_type") == metric)
    return chosen.orderBy(F.desc("rank_value"), *_ties(rankings)).limit(limit)


def search_text(features, query, literal=False):
    """Rows whose category or brand matches the lower-cased query, a regular expression unless `literal`."""
    if not _given(query):
        return features
    pattern = query.lower() if literal else _spark_pattern(features.sparkSession, query.lower())
    if pattern is None:
        return _none(features)
    return features.filter(_matches("category_code", pattern, literal) | _matches("brand", pattern, literal))


def _filter_pattern(features, column, pattern, literal=False):
    if not _given(pattern):
        return features
    pattern = pattern if literal else _spark_pattern(features.sparkSession, pattern)
    if pattern is None:
        return _none(features)
    return features.filter(_matches(column, pattern, literal))


def filter_category(features, pattern, literal=False):
    return _filter_pattern(features, "category_code", pattern, literal)


def filter_brand(features, pattern, literal=False):
    return _filter_pattern(features, "brand", pattern, literal)


def filter_price(features, price_min=None, price_max=None):
    """Both bounds inclusive; numbers or their text."""
    if _given(price_min):
        features = features.filter(F.col("avg_price") >= float(price_min))
    if _given(price_max):
        features = features.filter(F.col("avg_price") <= float(price_max))
    return features


def filter_tier(features, price_tier):
    return features.filter(F.col("price_tier") == price_tier) if _given(price_tier) else features


def search_products(
    features, query="", category=None, brand=None, price_min=None, price_max=None, price_tier=None, limit=20, literal=False
):
    """Text search and filters combined, most popular first."""
    found = search_text(features, query, literal)
    found = filter_category(found, category, literal)
    found = filter_brand(found, brand, literal)
    found = filter_price(found, price_min, price_max)
    found = filter_tier(found, price_tier)
    return found.orderBy(F.desc("popularity_score"), *_ties(features)).limit(limit)


def product_details(stats, product_id):
    return stats.filter(F.col("product_id") == product_id).orderBy(*_ties(stats)).limit(1)


def similar_to(similar, product_id, limit=5):
    chosen = similar.filter(F.col("product_id") == product_id)
    return chosen.orderBy(F.desc("similarity_score"), "similar_product_id").limit(limit)


def recommendations_for(recommendations, user_id, limit=10):
    chosen = recommendations.filter(F.col("user_id") == str(user_id))
    return chosen.orderBy(F.desc("score"), "rank").limit(limit)


def category_statistics(stats):
    return stats


def brand_statistics(stats):
    return stats


def recommendations_table(recommendations):
    return recommendations


def _section(table, name, order, key, value, size):
    """The first rows of a table as (section, position, key, value) lines."""
    # The window runs over the `size` rows kept below it.
    position = F.row_number().over(Window.orderBy(*order))
    return table.orderBy(*order).limit(size).select(
        F.lit(name).alias("section"), position.alias("position"), key.alias("key"), value.alias("value")
    )


def _size(table, name):
    return table.agg(F.count("*").alias("value")).select(
        F.lit(name).alias("section"), F.lit(1).alias("position"), F.lit("count").alias("key"), "value"
    )


def dashboard(rankings, categories, brands, top=5, listed=10):
    """Leading products, table sizes and leading categories and brands as one long table."""
    parts = [
        _section(
            rankings.filter(F.col("rank_type") == metric), section,
            [F.desc("rank_value"), *_ties(rankings)], F.col("product_id"), F.col("rank_value"), top,
        )
        for section, metric in (
            ("top_viewed", "most_viewed"), ("top_carted", "most_carted"), ("top_purchased", "most_purchased")
        )
    ]
    parts.append(_size(categories, "total_categories"))
    parts.append(_size(brands, "total_brands"))
    parts.append(
        _section(
            categories, "categories", [F.desc("total_events"), "category_id", "category_code"],
            F.concat_ws("/", "category_id", "category_code"), F.col("total_events"), listed,
        )
    )
    parts.append(
        _section(brands, "brands", [F.desc("total_events"), "brand"], F.col("brand"), F.col("total_events"), listed)
    )
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
