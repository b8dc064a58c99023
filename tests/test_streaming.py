import datetime
import json

from pyspark.sql import functions as F

from cartwright import schema
from cartwright.operators import ingest
from cartwright.plans import fixtures, medallion
from cartwright.sources import files, records
from cartwright.streaming import ingest as stream_ingest
from cartwright.streaming import live
from conftest import SMALL

AS_OF = datetime.datetime(2024, 5, 6, 7, 8, 9, tzinfo=datetime.timezone.utc)


def rows(table):
    return sorted(map(str, table.collect()))


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    source, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "silver"), str(tmp_path / "checkpoint")
    batch = fixtures.raw_records(spark, SMALL)
    records.publish_to_files(batch, source, partitions=3)

    def take_in():
        stream = records.file_stream(spark, source, files_per_trigger=1)
        query = stream_ingest.write_silver(stream, path, checkpoint, as_of=AS_OF)
        query.awaitTermination()
        return query

    assert len([p for p in take_in().recentProgress if p.numInputRows]) == 3
    wanted = rows(ingest.silver_events(batch, AS_OF))
    assert rows(files.silver(spark, path).select(*schema.SILVER_COLUMNS)) == wanted
    take_in()
    assert rows(files.silver(spark, path).select(*schema.SILVER_COLUMNS)) == wanted
    records.publish_to_files(batch, source, partitions=1)
    take_in()
    assert files.silver(spark, path).count() == 2 * len(wanted)


def test_console_runs(spark, tmp_path):
    records.publish_to_files(fixtures.raw_records(spark, SMALL), str(tmp_path / "in"))
    events = ingest.silver_events(records.file_stream(spark, str(tmp_path / "in")))
    query = stream_ingest.write_console(events, str(tmp_path / "checkpoint"), rows=1)
    query.awaitTermination()
    assert query.exception() is None


def totals(spark, *counts):
    full = [(p, "c", "c", "b", 1.0, v, 0, 0, v) for p, v in counts]
    return spark.createDataFrame(
        full,
        "product_id STRING, category_id STRING, category_code STRING, brand STRING, avg_price DOUBLE, view_count BIGINT, "
        "cart_count BIGINT, purchase_count BIGINT, popularity_score BIGINT",
    )


def viewed(lists):
    kept = lists.filter("rank_type = 'most_viewed'").orderBy("position").collect()
    return [(row.product_id, row.rank_value) for row in kept]


def test_merged_lists_replace_touched_products(spark):
    first = live.merge_lists(None, totals(spark, ("a", 5), ("b", 4), ("c", 3)), size=2)
    assert viewed(first) == [("a", 5), ("b", 4)]
    second = live.merge_lists(first, totals(spark, ("b", 9), ("d", 5)), size=2)
    assert viewed(second) == [("b", 9), ("a", 5)]


def test_merge_matches_null_keys(spark):
    def nameless(count):
        return totals(spark, ("a", count)).withColumn("category_id", F.lit(None).cast("string"))

    second = live.merge_lists(live.merge_lists(None, nameless(1)), nameless(2))
    assert viewed(second) == [("a", 2)]


def test_live_lists_follow_the_stream(spark, tmp_path):
    source, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "lists"), str(tmp_path / "checkpoint")
    shape = "product_id STRING, category_id STRING, category_code STRING, brand STRING, price DOUBLE, event_type STRING"

    def add(*products):
        table = spark.createDataFrame([(p, None, "c", "b", 2.0, "view") for p in products], shape)
        table.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(shape).parquet(source)
        live.write_live_rankings(stream, path, checkpoint, size=2).awaitTermination()
        return viewed(live.current_lists(spark, path))

    assert add("a", "a", "b", "c") == [("a", 2), ("b", 1)]
    assert add("c", "c") == [("c", 3), ("a", 2)]
    assert add("b", "a") == [("a", 3), ("c", 3)]


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    refresh = live.refresh_lists(str(tmp_path), lambda: "one", size=2)
    refresh(totals(spark, ("a", 5), ("b", 4)), 0)
    for _ in range(2):
        refresh(totals(spark, ("b", 6)), 1)
        assert viewed(live.current_lists(spark, str(tmp_path))) == [("b", 6), ("a", 5)]


def test_lists_follow_a_new_checkpoint_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path)
    refresh = live.refresh_lists(path, lambda: "one", size=2)
    for batch in range(6):
        refresh(totals(spark, ("a", batch + 1)), batch)
    assert len(list((tmp_path / "run=one").glob("batch=*"))) == live.KEPT_VERSIONS
    live.refresh_lists(path, lambda: "two", size=2)(totals(spark, ("z", 1)), 0)
    assert viewed(live.current_lists(spark, path)) == [("z", 1)]


def test_console_shows_a_few_rows_of_each_batch(spark, tmp_path, capsys):
    spark.range(50).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id BIGINT").parquet(str(tmp_path / "in"))
    stream_ingest.write_console(stream, str(tmp_path / "checkpoint"), rows=3).awaitTermination()
    shown = capsys.readouterr().out
    assert shown.count("Batch: ") == 1 and sum(line.startswith("|") for line in shown.splitlines()) == 4


def test_console_counts_all_rows_of_several_long_files(spark, tmp_path):
    spark.range(20_000).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    shown = []
    stream_ingest.write_console(stream, str(tmp_path / "checkpoint"), rows=2, write=shown.append).awaitTermination()
    counts = [int(text.removeprefix("Rows: ")) for text in shown if text.startswith("Rows: ")]
    assert len(counts) == 2 and sum(counts) == 20_000 and min(counts) > 4096


def test_replay_in_batches_of_a_thousand_rows(spark, tmp_path):
    rows = spark.range(3500).coalesce(1).select(F.lit("k").alias("key"), F.col("id").cast("string").alias("value"))
    records.publish_to_files(rows, str(tmp_path / "in"), rows_per_file=1000)
    stream = records.file_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    writer = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "checkpoint"))
    query = writer.trigger(processingTime="0.1 seconds").start()
    query.processAllAvailable()
    query.stop()
    taken = sorted(p.numInputRows for p in query.recentProgress if p.numInputRows)
    assert taken == [500, 1000, 1000, 1000]


def test_daily_job(spark, tmp_path):
    csv = str(tmp_path / "events.csv")
    raw = fixtures.raw_events(spark, SMALL).drop("event_id")
    writer = raw.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(csv)
    report = medallion.publish(spark, csv, str(tmp_path / "messages"), AS_OF)
    assert report["initial_rows"] == raw.count() > report["final_rows"] > 0

    base = str(tmp_path / "lake")
    found = medallion.run(records.file_stream(spark, str(tmp_path / "messages")), base, AS_OF, clusters=3)
    silver = files.silver(spark, f"{base}/silver")
    assert silver.count() == report["final_rows"] == files.bronze(spark, f"{base}/bronze").count()
    for name in ("product_statistics", "category_statistics", "brand_statistics", "product_rankings", "recommendation_features", "user_recommendations", "similar_products"):
        assert files.parquet_table(spark, f"{base}/gold/{name}").count() == found[name] > 0
    assert found["rmse"] > 0 and 0 <= found["hit_rate"] <= 1
    body = json.loads(files.bronze(spark, f"{base}/bronze").first().value)
    assert body["processed_timestamp"] == "2024-05-06T07:08:09.000000"
