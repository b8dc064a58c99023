"""Shapes and fixed values shared by every layer."""

# Event kinds and the weight one event of each kind carries.
EVENT_WEIGHTS = {"view": 1, "cart": 3, "purchase": 10}
EVENT_TYPES = tuple(EVENT_WEIGHTS)

# Table shapes.
RAW_EVENT = (
    "event_time STRING, event_type STRING, product_id STRING, category_id STRING, "
    "category_code STRING, brand STRING, price DOUBLE, user_id STRING, user_session STRING"
)
EVENT_MESSAGE = RAW_EVENT + ", processed_timestamp STRING"
RECORD = "key BINARY, value BINARY, timestamp TIMESTAMP"
BRONZE = "key STRING, value STRING, timestamp TIMESTAMP"
SILVER_COLUMNS = (
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
    "event_type",
    "event_timestamp",
    "processing_date",
    "processing_timestamp",
)
SILVER_PARTITIONS = ("processing_date", "event_type")
PRODUCT_KEYS = ("product_id", "category_id", "category_code", "brand")

# What a CSV cell may hold to mean "no value" (the defaults of pandas.read_csv).
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Upper bounds (exclusive) of each tier; the last name takes everything above.
PRICE_TIERS = (("budget", 50.0), ("mid_range", 200.0), ("premium", 500.0))
TOP_PRICE_TIER = "luxury"
ENGAGEMENT_TIERS = (("low", 10.0), ("medium", 50.0), ("high", 100.0))
TOP_ENGAGEMENT_TIER = "very_high"

# The ranking lists and the statistic each one sorts by.
RANKINGS = {
    "most_viewed": "view_count",
    "most_carted": "cart_count",
    "most_purchased": "purchase_count",
    "most_popular": "popularity_score",
}
RANKING_SIZE = 100

# The inputs of product clustering.
CLUSTER_FEATURES = ("avg_price", "popularity_score", "engagement_rate", "brand_index", "category_index")
CLUSTER_COUNT = 20
