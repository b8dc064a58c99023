"""Gold from silver day by day: only the events of processing dates whose files changed are read again.

Below `folder`, `days` holds the activity of each processing date and `listed` the digest of the silver files each was made from. A
date's activity is replaced before its digest is, so a run that breaks off between the two repeats that date and
never counts it twice. Gold is then made from all dates' activity, which is smaller than the events.
"""

from pyspark.sql import functions as F

from cartwright.operators import statistics
from cartwright.plans import medallion
from cartwright.sources import files, scratch

_DATE = r"/processing_date=([0-9-]+)/"


def silver_digests(spark, silver_path):
    """processing_date and a digest of the names, sizes and times of its files; their content is not read."""
    listed = files.file_listing(spark, silver_path, "*.parquet")
    dated = listed.withColumn("processing_date", F.to_date(F.regexp_extract("path", _DATE, 1)))
    digest = F.bit_xor(F.xxhash64("path", "size", F.unix_micros("last_modified")))
    return dated.groupBy("processing_date").agg(F.concat_ws(":", F.count("*"), F.sum("size"), digest).alias("digest"))


def _exists(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def changed_dates(spark, current, folder):
    """The processing dates that are new or whose files differ from those listed; a row per date comes to the driver."""
    if not _exists(spark, f"{folder}/listed"):
        return sorted(row[0] for row in current.select("processing_date").collect())
    known = spark.read.parquet(f"{folder}/listed")
    return sorted(row[0] for row in current.join(known, ["processing_date", "digest"], "left_anti").select("processing_date").collect())


def refresh_activity(spark, silver_path, folder):
    """Brings `folder` up to date with silver and returns the dates that were read.

    Dates that silver no longer has are no longer listed, and so left out by `current_activity`.
    """
    current = scratch.materialize(silver_digests(spark, silver_path), "digests")
    dates = changed_dates(spark, current, folder)
    if dates:
        events = files.silver(spark, silver_path).filter(F.col("processing_date").isin(dates))
        daily = statistics.activity(events, extra=["processing_date"])
        writer = daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("processing_date").parquet(f"{folder}/days")
    current.coalesce(1).write.mode("overwrite").parquet(f"{folder}/listed")
    return dates


def current_activity(spark, folder):
    """The activity over all listed dates: one row per product, user and session, as from one pass over all events."""
    listed = spark.read.parquet(f"{folder}/listed").select("processing_date")
    days = spark.read.parquet(f"{folder}/days").join(listed, "processing_date", "left_semi")
    return statistics.merged_activity(days)


def refresh_gold(spark, silver_path, folder, gold, as_of=None):
    """Refreshes the activity and writes the five gold tables. Returns their numbers of rows and the dates that were read."""
    dates = refresh_activity(spark, silver_path, folder)
    base = scratch.materialize(current_activity(spark, folder), "activity")
    return {**medallion.build_gold(base, gold, as_of, base=base), "dates": dates}
