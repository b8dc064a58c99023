import datetime
import math
import re

import pytest
from pyspark.sql import functions as F

from cartwright import schema
from cartwright.functions import metrics
from cartwright.operators import clustering, statistics

COLUMNS = (
    "product_id STRING, category_id STRING, category_code STRING, brand STRING, price DOUBLE, user_id STRING, "
    "user_session STRING, event_type STRING, event_timestamp TIMESTAMP_NTZ"
)


def at(hour):
    return datetime.datetime(2024, 1, 1, hour)


def events(spark, *rows):
    """Rows of (product, brand, price, user, session, kind, hour)."""
    full = [(p, "c", "c.d", b, price, u, s, kind, at(h)) for p, b, price, u, s, kind, h in rows]
    return spark.createDataFrame(full, COLUMNS)


def test_product_statistics(spark):
    table = events(
        spark,
        ("1", "x", 10.0, "u1", "s1", "view", 1),
        ("1", "x", 20.0, "u1", "s2", "view", 2),
        ("1", "x", 30.0, "u2", "s3", "cart", 3),
        ("1", "x", 40.0, "u2", "s3", "purchase", 4),
    )
    row = statistics.product_statistics(table).first()
    assert (row.total_events, row.view_count, row.cart_count, row.purchase_count) == (4, 2, 1, 1)
    assert (row.unique_users, row.unique_sessions) == (2, 3)
    assert (row.avg_price, row.min_price, row.max_price) == (25.0, 10.0, 40.0)
    assert (row.first_seen, row.last_seen) == (at(1), at(4))
    assert (row.view_to_cart_rate, row.cart_to_purchase_rate, row.view_to_purchase_rate) == (0.5, 1.0, 0.5)
    assert (row.popularity_score, row.engagement_score) == (2 + 3 + 10, 2 + 1.5)
    assert row.created_timestamp is not None


def test_rates_without_views_are_zero(spark):
    row = statistics.product_statistics(events(spark, ("1", "x", 1.0, "u", "s", "purchase", 1))).first()
    assert (row.view_to_cart_rate, row.cart_to_purchase_rate, row.view_to_purchase_rate) == (0.0, 0.0, 0.0)
    assert row.popularity_score == 10


def test_product_with_two_brands_gives_two_rows(spark):
    table = events(spark, ("1", "x", 1.0, "u", "s", "view", 1), ("1", "y", 1.0, "u", "s", "view", 1))
    assert statistics.product_statistics(table).count() == 2


def test_brand_statistics_leave_out_unknown(spark):
    table = events(spark, ("1", "x", 1.0, "u", "s", "view", 1), ("2", "unknown", 1.0, "u", "s", "view", 1))
    assert [row.brand for row in statistics.brand_statistics(table).collect()] == ["x"]


def test_null_category_id_is_a_group(spark):
    table = events(spark, ("1", "x", 1.0, "u", "s", "view", 1)).withColumn("category_id", F.lit(None).cast("string"))
    assert statistics.product_statistics(table).count() == 1
    assert statistics.category_statistics(table).first().product_count == 1


def test_approximate_counts_have_the_same_columns(spark):
    table = events(spark, ("1", "x", 1.0, "u", "s", "view", 1))
    exact, rough = statistics.product_statistics(table), statistics.product_statistics(table, approximate=True)
    assert exact.columns == rough.columns and rough.first().unique_users == 1


def mean_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "price DOUBLE").agg(metrics.exact_mean()).first()[0]


def test_exact_mean(spark):
    assert mean_of(spark, [0.1, 0.2, 0.3]) == 0.6 / 3
    assert mean_of(spark, [1.5, None]) == 1.5
    assert mean_of(spark, [None]) is None
    assert mean_of(spark, [1.0, math.inf]) == math.inf
    assert mean_of(spark, [1e300, 3e300]) == 2e300
    assert mean_of(spark, [9e14, 9e14]) == 9e14
    assert math.isnan(mean_of(spark, [1.0, math.nan]))


def test_exact_mean_is_the_same_in_any_layout(spark):
    values = spark.range(20000).select((F.pmod(F.col("id") * 7919, 99991) / 100).alias("price"))
    means = {values.repartition(n).agg(metrics.exact_mean()).first()[0].hex() for n in (1, 3, 7)}
    assert len(means) == 1


@pytest.mark.parametrize(
    "value,name",
    [(49.99, "budget"), (50.0, "mid_range"), (199.99, "mid_range"), (200.0, "premium"), (499.99, "premium"), (500.0, "luxury"), (None, "luxury")],
)
def test_price_tiers(spark, value, name):
    assert spark.createDataFrame([(value,)], "avg_price DOUBLE").select(metrics.price_tier()).first()[0] == name


@pytest.mark.parametrize(
    "value,name",
    [(9.5, "low"), (10.0, "medium"), (49.5, "medium"), (50.0, "high"), (99.5, "high"), (100.0, "very_high"), (None, "very_high")],
)
def test_engagement_tiers(spark, value, name):
    assert spark.createDataFrame([(value,)], "engagement_score DOUBLE").select(metrics.engagement_tier()).first()[0] == name


def test_features_from_statistics_equal_features_from_events(spark):
    table = events(spark, *[(str(i % 5), "x", i * 1.25, f"u{i % 7}", f"s{i}", ("view", "cart", "purchase")[i % 3], 1) for i in range(90)])
    direct = clustering.product_features(table)
    derived = clustering.features_from_statistics(statistics.product_statistics(table))
    assert direct.columns == derived.columns
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, derived.collect()))


@pytest.mark.parametrize("function", [statistics.product_statistics, statistics.category_statistics, statistics.brand_statistics])
def test_statistics_from_written_activity_equal_those_from_events(spark, function):
    rows = [
        (str(i % 7), ("x", "y", "unknown")[i % 3], i * 1.25, f"u{i % 5}", f"s{i % 11}", ("view", "cart", "purchase")[i % 3], i % 24)
        for i in range(120)
    ]
    table = events(spark, *rows).withColumn("category_id", F.when(F.col("product_id") > "2", F.col("product_id") % 2))
    direct = function(table).drop("created_timestamp")
    derived = function(table, base=statistics.activity(table).cache()).drop("created_timestamp")
    assert direct.dtypes == derived.dtypes
    assert sorted(map(str, direct.collect())) == sorted(map(str, derived.collect()))
    lent = function(None, parts=statistics.product_parts(statistics.activity(table)).cache()).drop("created_timestamp")
    assert sorted(map(str, direct.collect())) == sorted(map(str, lent.collect()))


def plan_of(table):
    return table._jdf.queryExecution().executedPlan().toString()


def test_no_row_is_copied_for_distinct_counts(spark):
    table = events(spark, ("1", "x", 1.0, "u", "s", "view", 1))
    assert "Expand" not in plan_of(statistics.product_statistics(table))
    assert "Expand" not in plan_of(statistics.distinct_counts(table, "category_id", ("user_id", "product_id", "brand")))


def test_categories_and_brands_come_from_product_rows_alone(spark):
    parts = statistics.product_parts(statistics.activity(events(spark, ("1", "x", 1.0, "u", "s", "view", 1)))).cache()
    for function in (statistics.category_statistics, statistics.brand_statistics):
        plan = plan_of(function(None, parts=parts))
        assert "user_id" not in plan.split("InMemoryTableScan")[0] and plan.count("InMemoryTableScan") == 1


def test_users_are_counted_once_per_product_category_and_brand(spark):
    rows = [
        (str(i % 9), ("x", "y", "unknown", None)[i % 4], 1.0, None if i % 11 == 0 else f"u{i * 7 % 13}", f"s{i % 17}", "view", i % 24)
        for i in range(400)
    ]
    table = events(spark, *rows).withColumn("category_id", F.when(F.col("product_id") > "2", F.col("product_id") % 2))
    for function, keys in (
        (statistics.product_statistics, schema.PRODUCT_KEYS), (statistics.category_statistics, statistics.CATEGORY_KEYS),
        (statistics.brand_statistics, statistics.BRAND_KEYS),
    ):
        wanted = {}
        for row in table.collect():
            if function is not statistics.brand_statistics or row.brand not in (None, "unknown"):
                wanted.setdefault(tuple(row[key] for key in keys), set()).add(row.user_id)
        found = {tuple(row[key] for key in keys): row.unique_users for row in function(table).collect()}
        assert found == {key: len(users - {None}) for key, users in wanted.items()}


def test_hot_product_is_spread_before_it_is_counted(spark):
    """The shuffles of exact distinct counts key on the counted value too, not on the product alone."""
    table = events(spark, ("1", "x", 1.0, "u", "s", "view", 1))
    for found in (statistics.product_statistics(table), statistics.product_statistics(None, base=statistics.activity(table).cache())):
        keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(found))
        assert any("product_id" in key and "user_session" in key for key in keys)
        assert any("product_id" in key and "user_id" in key for key in keys)


def test_mean_of_small_prices_and_of_large_sums(spark):
    assert mean_of(spark, [0.00001, 0.00003]) == pytest.approx(0.00002, rel=1e-12)
    assert mean_of(spark, [1.00004]) == 1.00004
    assert mean_of(spark, [4e14, 4e14, 4e14, 4e14]) == 4e14
    for values in ([0.1] * 3, [0.7] * 49, [33.33] * 7, [1e-5] * 9):
        assert min(values) <= mean_of(spark, values) <= max(values)


def test_mean_of_parts_equals_the_mean(spark):
    rows = [(str(i % 4), "x", (0.00003 if i % 4 == 3 else i * 0.37), f"u{i}", "s", "view", 1) for i in range(80)]
    table = events(spark, *rows)
    whole = table.groupBy("product_id").agg(metrics.exact_mean().alias("m")).collect()
    parts = {row.product_id: row.avg_price for row in statistics.product_statistics(table).collect()}
    assert {row.product_id: row.m for row in whole} == parts


def test_distinct_counts_with_null_groups_and_values(spark):
    rows = [("a", "x"), ("a", None), ("a", "x"), (None, "y"), (None, "z"), ("b", None)]
    found = statistics.distinct_counts(spark.createDataFrame(rows, "g STRING, v STRING"), "g", ["v"])
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [("a", 1), (None, 2), ("b", 0)]))
