"""Gold refreshed day by day equals gold rebuilt from all of silver."""

import datetime

from pyspark.sql import functions as F

from cartwright.operators import statistics
from cartwright.plans import fixtures, incremental, medallion
from cartwright.sources import files
from conftest import SMALL

TABLES = ("product_statistics", "category_statistics", "brand_statistics", "product_rankings", "recommendation_features")
AS_OF = datetime.datetime(2024, 5, 6, tzinfo=datetime.timezone.utc)


def day(number):
    return datetime.date(2024, 1, number)


def add(spark, path, number, share, mode="append"):
    """A share of the order lines as the events of one processing date; sessions and users return on other dates."""
    events = fixtures.commerce_events(spark, SMALL).filter(F.abs(F.xxhash64("user_session", "product_id")) % 4 == share)
    dated = events.withColumn("processing_date", F.lit(day(number)))
    dated.write.mode(mode).partitionBy("processing_date", "event_type").parquet(path)


def rows(spark, gold):
    return {name: sorted(map(str, files.parquet_table(spark, f"{gold}/{name}").collect())) for name in TABLES}


def rebuilt(spark, silver, gold):
    events = files.silver(spark, silver)
    medallion.build_gold(events, gold, AS_OF)
    return rows(spark, gold)


def test_refreshed_gold_equals_a_rebuild_and_reads_changed_dates_alone(spark, tmp_path):
    silver, folder, gold = (str(tmp_path / name) for name in ("silver", "activity", "gold"))

    def refresh():
        found = incremental.refresh_gold(spark, silver, folder, gold, AS_OF)
        assert rows(spark, gold) == rebuilt(spark, silver, str(tmp_path / "whole"))
        return found["dates"]

    add(spark, silver, 1, 0)
    add(spark, silver, 2, 1)
    assert refresh() == [day(1), day(2)]
    assert refresh() == []
    add(spark, silver, 3, 2)
    assert refresh() == [day(3)]
    add(spark, silver, 2, 3)  # late events of a known date
    add(spark, silver, 3, 2)  # the same events once more
    assert refresh() == [day(2), day(3)]


def test_a_run_that_broke_off_is_repeated_without_counting_twice(spark, tmp_path):
    silver, folder = str(tmp_path / "silver"), str(tmp_path / "activity")
    add(spark, silver, 1, 0)
    incremental.refresh_activity(spark, silver, folder)
    before = spark.read.parquet(f"{folder}/listed").collect()
    add(spark, silver, 2, 1)
    incremental.refresh_activity(spark, silver, folder)
    # As if the digests had not been written: the date is read again and replaces its own activity.
    shape = spark.read.parquet(f"{folder}/listed").schema
    spark.createDataFrame(before, shape).write.mode("overwrite").parquet(f"{folder}/listed")
    assert incremental.refresh_activity(spark, silver, folder) == [day(2)]
    whole = statistics.activity(files.silver(spark, silver))
    found = incremental.current_activity(spark, folder).select(*whole.columns)
    assert sorted(map(str, found.drop("whole_sum").collect())) == sorted(map(str, whole.drop("whole_sum").collect()))
