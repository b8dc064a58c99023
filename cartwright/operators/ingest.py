"""From raw rows or message records to the silver event table. The same code serves batch and streaming input."""

from pyspark.sql import functions as F

from cartwright import schema
from cartwright.functions import cleaning

REQUIRED_IN_FILE = ["event_time", "event_type", "product_id", "user_id"]
ID_COLUMNS = ("product_id", "category_id", "user_id")


def drop_missing(events):
    """Rows that carry a time, a kind, a product and a user."""
    return events.dropna(subset=REQUIRED_IN_FILE)


def keep_known_events(events):
    return events.filter(cleaning.is_known_event())


def ids_as_text(events):
    return events.withColumns({name: F.col(name).cast("string") for name in ID_COLUMNS})


def fill_price(events):
    return events.withColumn("price", cleaning.filled_price())


def null_text(events, columns=("category_code", "brand")):
    return events.withColumns({name: cleaning.present_text(name) for name in columns})


def stamp(events, as_of=None):
    """Adds the ISO text of the moment the event was taken in."""
    return events.withColumn("processed_timestamp", cleaning.iso_text(cleaning.moment(as_of)))


def clean_raw(events):
    """File rows ready to be published: required fields present, known kinds, text ids, no missing price."""
    return fill_price(ids_as_text(null_text(keep_known_events(drop_missing(events)))))


def clean_report(events):
    """Row counts before and after `clean_raw`, from one pass over the input."""
    kept = cleaning.is_known_event()
    for name in REQUIRED_IN_FILE:
        kept = kept & F.col(name).isNotNull()
    return events.agg(F.count("*").alias("initial_rows"), F.count_if(kept).alias("final_rows"))


def record_text(records):
    """Key and value of a message as text, with its timestamp."""
    return records.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp"
    )


def parse_events(records):
    """Decodes message values; a malformed value gives a row of nulls.

    The decoded struct passes through a one-element explode. Without it Catalyst copies the decoder into every later
    filter and each message is parsed once per condition; with it, once.
    """
    decoded = F.from_json(F.col("value").cast("string"), schema.EVENT_MESSAGE)
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.explode(F.array(decoded)).alias("event"),
    ).select("kafka_key", "kafka_timestamp", "event.*")


def require_ids(events):
    return events.filter(F.col("product_id").isNotNull() & F.col("user_id").isNotNull())


def with_event_timestamp(events):
    return events.withColumn("event_timestamp", cleaning.event_instant())


def normalise_brand(events):
    return events.withColumn("brand", cleaning.plain_text("brand"))


def normalise_category(events):
    return events.withColumn("category_code", cleaning.plain_text("category_code"))


def with_processing_columns(events, as_of=None):
    now = cleaning.moment(as_of)
    return events.withColumns({"processing_date": F.to_date(now), "processing_timestamp": now})


def clean_events(events, as_of=None):
    """Decoded events as silver rows."""
    kept = require_ids(keep_known_events(events))
    typed = fill_price(with_event_timestamp(kept))
    named = normalise_category(normalise_brand(typed))
    return with_processing_columns(named, as_of).select(*schema.SILVER_COLUMNS)


def silver_events(records, as_of=None):
    """Message records (or bronze rows, which have the same three columns) as silver rows."""
    return clean_events(parse_events(records), as_of)


def distinct_categories(events):
    return events.select("category_code").dropna().distinct()


def category_folders(categories):
    return categories.withColumn("folder", cleaning.slug("category_code"))
