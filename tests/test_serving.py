import math

import pytest
from pyspark.sql import functions as F

from cartwright.functions import display
from cartwright.operators import catalog, serving

FEATURES = (
    "product_id STRING, category_id STRING, category_code STRING, brand STRING, avg_price DOUBLE, "
    "popularity_score BIGINT, price_tier STRING"
)


def rows(table):
    return sorted(map(str, table.collect()))


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame(
        [
            ("1", "c", "construction.tools.light", "apple", 1302.48, 90, "luxury"),
            ("2", "c", "appliances.personal.massager", "bosch", 313.52, 70, "premium"),
            ("3", "c", "sxa", "s.a", 10.0, 70, "budget"),
            ("4", "c", None, "nika", 50.0, 10, "mid_range"),
            ("5", "c", "unknown", None, 50.0, 5, "mid_range"),
        ],
        FEATURES,
    )


def plan_text(table):
    jvm = table.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(table._jdf.queryExecution(), "formatted")


def ids(table):
    return [row.product_id for row in table.collect()]


def test_search_text_is_a_lower_cased_pattern_over_category_or_brand(features):
    assert ids(serving.search_text(features, "APPLE")) == ["1"]
    assert ids(serving.search_text(features, "s.a")) == ["2", "3"]
    assert ids(serving.search_text(features, "tools|massager")) == ["1", "2"]
    assert ids(serving.search_text(features, "nika|unknown")) == ["4", "5"]
    assert ids(serving.search_text(features, "")) == ["1", "2", "3", "4", "5"]
    assert ids(serving.search_text(features, ".", literal=True)) == ["1", "2", "3"]


@pytest.mark.parametrize("pattern", ["(", "[a", "*x", "(?P<n>a"])
def test_bad_pattern_finds_nothing(features, pattern):
    assert serving.search_text(features, pattern).count() == 0
    assert serving.search_products(features, brand=pattern).count() == 0


def test_bad_pattern_is_plain_text_when_literal(features):
    assert serving.search_text(features, "(", literal=True).count() == 0


def test_filters_are_case_sensitive_patterns(features):
    assert ids(serving.filter_brand(features, "Apple")) == []
    assert ids(serving.filter_brand(features, "^a")) == ["1"]
    assert ids(serving.filter_category(features, "personal")) == ["2"]
    assert serving.filter_category(features, "").count() == 5


def test_price_bounds_are_inclusive_and_zero_text_counts(features):
    assert ids(serving.filter_price(features, "50", "313.52")) == ["2", "4", "5"]
    assert ids(serving.filter_price(features, None, "0")) == []
    assert serving.filter_price(features, "", "").count() == 5
    with pytest.raises(ValueError):
        serving.filter_price(features, "cheap")


def test_search_products_orders_by_popularity_then_id(features):
    assert ids(serving.search_products(features)) == ["1", "2", "3", "4", "5"]
    assert ids(serving.search_products(features, limit=2)) == ["1", "2"]
    assert ids(serving.search_products(features, price_tier="mid_range", price_max=50)) == ["4", "5"]


def test_filters_reach_the_scan(spark, features, tmp_path):
    features.write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    details = plan_text(serving.product_details(stored, "1"))
    assert "EqualTo(product_id,1)" in details
    found = serving.search_products(stored, price_min="5", price_tier="luxury").select("product_id")
    plan = plan_text(found)
    assert "GreaterThanOrEqual(avg_price,5.0)" in plan and "EqualTo(price_tier,luxury)" in plan
    assert "TakeOrderedAndProject" in plan


def test_top_products_rejects_unknown_metrics(spark):
    rankings = spark.createDataFrame([("1", "c", "b", 1.0, "most_viewed", 5)], "product_id STRING, category_code STRING, brand STRING, avg_price DOUBLE, rank_type STRING, rank_value BIGINT")
    assert serving.top_products(rankings, "most_viewed").count() == 1
    with pytest.raises(ValueError):
        serving.top_products(rankings, "most_loved")


def test_details_of_a_missing_product_are_empty(features):
    assert serving.product_details(features, "99").count() == 0


# ---- catalogue -----------------------------------------------------------------------------------------------------

CATALOGUE = (
    "product_id STRING, category_code STRING, brand STRING, price DOUBLE, view_count BIGINT, cart_count BIGINT, "
    "purchase_count BIGINT"
)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [
            ("1003", "construction.tools.light", "Samsung", 1302.48, 1250, 95, 43),
            ("1009", "apparel.trousers", "Balenciaga", 101.68, 2100, 156, 89),
            ("1015", "appliances.personal.massager", "bosch", 313.52, 890, 67, 23),
            ("1020", "", "", 100.0, None, 0, None),
        ],
        CATALOGUE,
    )


def test_browse(products):
    assert ids(catalog.browse(products, " TOOLS.LIGHT SAM ")) == ["1003"]
    assert ids(catalog.browse(products, "a.p")) == []
    assert ids(catalog.browse(products, category="apparel.trousers", brand="Balenciaga")) == ["1009"]
    assert ids(catalog.browse(products, brand="balenciaga")) == []
    assert ids(catalog.browse(products, price_range="0-100")) == ["1020"]
    assert ids(catalog.browse(products, price_range="100-500")) == ["1009", "1015", "1020"]
    assert ids(catalog.browse(products, price_range="1000+")) == ["1003"]
    assert len(ids(catalog.browse(products))) == 4


def test_filter_options_leave_out_empty_text(products):
    found = [tuple(row) for row in catalog.filter_options(products).collect()]
    assert found == [
        ("brand", "Balenciaga"), ("brand", "Samsung"), ("brand", "bosch"),
        ("category", "apparel.trousers"), ("category", "appliances.personal.massager"),
        ("category", "construction.tools.light"),
    ]


def numbered(spark, n):
    return spark.range(n).select(
        F.lpad(F.col("id").cast("string"), 3, "0").alias("product_id"), F.lit("c").alias("category_code"), F.lit("b").alias("brand")
    )


def test_pages(spark):
    table = numbered(spark, 30)
    assert tuple(catalog.page_count(table).first()) == (30, 3)
    assert ids(catalog.page(table, 1))[0] == "000" and len(ids(catalog.page(table, 1))) == 12
    assert ids(catalog.page(table, 3)) == ids(catalog.page(table, 99)) == [f"{i:03d}" for i in range(24, 30)]
    assert ids(catalog.page(table, 0)) == ids(catalog.page(table, 1))
    assert len(ids(catalog.page(table, 2, catalog.SMALL_PAGE_SIZE))) == 6
    assert ids(catalog.page(numbered(spark, 0), 1)) == []


def test_walking_pages_by_key_visits_every_row_once(spark):
    table = numbered(spark, 30)
    twins = table.unionByName(table.withColumn("brand", F.lit("z")))
    seen, last = [], None
    while True:
        rows = catalog.page_after(twins, last).collect()
        if not rows:
            break
        seen += [(row.product_id, row.brand) for row in rows]
        last = rows[-1].asDict()
    assert seen == sorted(seen) and len(seen) == len(set(seen)) == 60


def test_top_by_counts_missing_as_zero(products):
    rows = catalog.top_by(products, "view").collect()
    assert [(row.position, row.product_id, row.shown_count) for row in rows] == [
        (1, "1009", 2100), (2, "1003", 1250), (3, "1015", 890), (4, "1020", 0)
    ]


def test_match_score_is_half_up_within_ten_and_a_hundred(spark):
    rows = [(1000, 0, 0, 100), (0, 0, 0, 10), (5, 0, 4, 21), (4, 10, 0, 20), (125, 5, 0, 23), (None, 6, None, 12)]
    table = spark.createDataFrame(rows, "view_count BIGINT, cart_count BIGINT, purchase_count BIGINT, wanted BIGINT")
    for row in catalog.with_match_score(table).collect():
        assert row.match_score == row.wanted


@pytest.mark.parametrize(
    "price,text",
    [
        (0.0, "$0.00"), (8.25, "$8.25"), (1.005, "$1.00"), (0.125, "$0.13"), (2.675, "$2.67"), (1302.5, "$1302.50"),
        (0.999, "$1.00"), (99.995, "$100.00"), (123456789.375, "$123456789.38"), (-1.5, "$-1.50"), (None, None),
    ],
)
def test_price_text(spark, price, text):
    table = spark.createDataFrame([("a.b", "éa", price)], "category_code STRING, brand STRING, price DOUBLE")
    assert catalog.with_display_text(table).first().price_text == text


def test_display_text(spark):
    table = spark.createDataFrame([("a.b.c", "mc donald", 1.0), (None, "", 1.0), ("", "x", 1.0)], "category_code STRING, brand STRING, price DOUBLE")
    rows = catalog.with_display_text(table).collect()
    assert [row.category_text for row in rows] == ["a > b > c", "-", ""]
    assert [row.brand_text for row in rows] == ["Mc donald", "", "X"]


def test_suggestions_need_three_characters(products):
    assert ids(catalog.suggest(products, "ap")) == []
    assert ids(catalog.suggest(products, "APP")) == ["1009", "1015"]


def test_python_spellings_of_patterns(features, spark):
    plain = rows(serving.filter_brand(features, "a"))
    assert plain and rows(serving.filter_brand(features, "(?P<x>a)")) == plain
    assert rows(serving.filter_brand(features, "a{,3}")) == rows(serving.filter_brand(features, "a{0,3}"))
    assert serving.filter_brand(features, "(").count() == 0
    with pytest.raises(ValueError, match="pattern"):
        serving.filter_brand(features, "(?P<two_words>a)")


def test_prices_without_cents(spark):
    prices = [1.005, 0.0, -2.5, math.inf, 1e17, float(1 << 52), 4503599627370495.5]
    table = spark.createDataFrame([(p,) for p in prices], "price DOUBLE")
    shown = [row[0] for row in table.select(display.price_text()).collect()]
    assert shown[:3] == ["$1.00", "$0.00", "$-2.50"] and shown[3:6] == ["$Infinity", "$1.0E17", "$4.503599627370496E15"]
    assert shown[6] == "$4503599627370495.50"


def test_open_price_ranges(spark):
    prices = spark.createDataFrame([(50.0,), (100.0,), (700.0,)], "price DOUBLE")
    for text in ("100", "100+", "100-"):
        assert catalog.in_price_range(prices, text).count() == 2
    assert catalog.in_price_range(prices, "-500").count() == 0 and catalog.in_price_range(prices, "").count() == 3


def test_deep_pages_stay_distributed(spark):
    table = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("product_id"), F.lit("b").alias("brand"))
    for number in (1, 40, 84, 999):
        wanted = table.orderBy("product_id").offset((min(number, 84) - 1) * 12).limit(12).collect()
        shown = catalog.page(table.repartition(7), number)
        assert [row.product_id for row in shown.collect()] == [row.product_id for row in wanted]
        assert "TakeOrdered" not in shown._jdf.queryExecution().executedPlan().toString()


def test_stored_pages_read_one_or_two_files(spark, tmp_path):
    table = numbered(spark, 95)
    catalog.page_folder(table.repartition(5), str(tmp_path / "pages"), rows_per_file=10)
    catalog.page_folder(numbered(spark, 0), str(tmp_path / "empty"))
    for size in (catalog.PAGE_SIZE, catalog.SMALL_PAGE_SIZE):
        for number in (0, 1, 2, 5, 8, 16, 99):
            shown = catalog.stored_page(spark, str(tmp_path / "pages"), number, size)
            assert shown.collect() == catalog.page(table, number, size).collect() and shown.columns == table.columns
            assert len(shown.inputFiles()) <= 3
    assert catalog.stored_page(spark, str(tmp_path / "empty"), 4).count() == 0
