"""Streams from message records to bronze and silver."""

from cartwright import schema
from cartwright.operators import ingest


def _trigger(writer, every):
    """A processing-time interval, or everything available now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def write_bronze(records, path, checkpoint, every=None):
    """Appends raw records as text."""
    writer = ingest.record_text(records).writeStream.format("parquet").outputMode("append")
    return _trigger(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()


def write_silver(records, path, checkpoint, every=None, as_of=None):
    """Appends clean events, one folder per processing date and event type."""
    events = ingest.silver_events(records, as_of)
    writer = events.writeStream.format("parquet").outputMode("append").partitionBy(*schema.SILVER_PARTITIONS)
    return _trigger(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()


def write_console(events, checkpoint, every=None, rows=20, write=print):
    """Shows each micro-batch for debugging: its number, how many rows it took in, and its first `rows` in full width.

    The rows are counted by an action of their own, as showing stops reading at the limit. No more than `rows` leave the
    executors. `write` takes each piece of text.
    """

    def show(batch, batch_id):
        write(f"Batch: {batch_id}")
        write(f"Rows: {batch.count()}")
        write(batch._jdf.showString(rows, 0, False))

    writer = events.writeStream.outputMode("append").foreachBatch(show)
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()
