"""Message records: key, value and timestamp, from Kafka or from files of the same shape."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright import schema
from cartwright.operators import ingest

KAFKA_DEFAULTS = {"startingOffsets": "earliest"}


def kafka_stream(spark, servers, topic, records_per_trigger=None, **options):
    """A topic from its earliest offset. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.options(**{**KAFKA_DEFAULTS, **options})
    if records_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", records_per_trigger)
    return reader.load().select("key", "value", "timestamp")


def file_stream(spark, folder, columns=schema.RECORD, files_per_trigger=None):
    """Records from parquet files, as a stream. `files_per_trigger` paces the replay."""
    reader = spark.readStream.schema(columns)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def event_records(events, as_of=None):
    """Clean events as messages keyed by product, with the ten message fields in fixed order, nulls included."""
    stamped = ingest.stamp(events, as_of)
    fields = [field.name for field in T.StructType.fromDDL(schema.EVENT_MESSAGE)]
    return stamped.select(
        F.col("product_id").cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def publish_to_kafka(records, servers, topic):
    """Sends a batch of key-value records to a topic. Needs the Kafka connector on the class path."""
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_to_files(records, folder, partitions=None, rows_per_file=None):
    """Appends records to a folder that `file_stream` can replay.

    One file per input partition unless a number is given; `rows_per_file` cuts files at that many rows. A replay in
    batches of 1,000 rows takes rows_per_file=1000, files_per_trigger=1 and a trigger interval as its gap.
    """
    shaped = records.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        (F.col("timestamp") if "timestamp" in records.columns else F.current_timestamp()).alias("timestamp"),
    )
    if partitions:
        shaped = shaped.repartition(partitions)
    writer = shaped.write.mode("append")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(folder)


# The two sample events that alternate.
SAMPLE_VIEW = {
    "event_type": "view", "category_id": "2232732093077520756", "category_code": "construction.tools.light",
    "brand": "apple", "price": 1302.48, "user_session": "sample-session-001",
}
SAMPLE_CART = {
    "event_type": "cart", "category_id": "2232732100769874463", "category_code": "appliances.personal.massager",
    "brand": "bosch", "price": 313.52, "user_session": "sample-session-002",
}


def sample_events(ids, as_of=None):
    """One sample event per row of `ids` (column `id`, as from spark.range): even ids view, odd ids put in a cart."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    even = F.col("id") % 2 == 0
    values = {name: F.when(even, F.lit(SAMPLE_VIEW[name])).otherwise(F.lit(SAMPLE_CART[name])) for name in SAMPLE_VIEW}
    values["event_time"] = F.date_format(now, "yyyy-MM-dd HH:mm:ss 'UTC'")
    values["product_id"] = F.concat(F.lit("product_"), F.col("id").cast("string"))
    values["user_id"] = F.concat(F.lit("user_"), F.col("id").cast("string"))
    names = [field.name for field in T.StructType.fromDDL(schema.RAW_EVENT)]
    return ids.select(*[values[name].alias(name) for name in names])
