import csv
import datetime
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from cartwright import schema
from cartwright.functions import cleaning
from cartwright.operators import ingest
from cartwright.sources import files, records, sinks

AS_OF = datetime.datetime(2024, 5, 6, 7, 8, 9, tzinfo=datetime.timezone.utc)
BASE = {
    "event_time": "2019-11-01 00:00:00 UTC", "event_type": "view", "product_id": "1005105",
    "category_id": "2232732093077520756", "category_code": "Construction.Tools.Light ", "brand": " Apple",
    "price": 1302.48, "user_id": "556695836", "user_session": "s1",
}


def messages(spark, *values):
    rows = [(b"k", value if isinstance(value, bytes) else json.dumps(value).encode(), AS_OF) for value in values]
    return spark.createDataFrame(rows, schema.RECORD)


def silver(spark, *values):
    return ingest.silver_events(messages(spark, *values), AS_OF).collect()


def test_clean_event(spark):
    (row,) = silver(spark, BASE)
    assert tuple(row.asDict()) == schema.SILVER_COLUMNS
    assert (row.category_code, row.brand, row.price) == ("construction.tools.light", "apple", 1302.48)
    assert row.processing_date == datetime.date(2024, 5, 6)


def test_rows_without_product_user_or_known_kind_are_dropped(spark):
    bad = [{**BASE, "product_id": None}, {**BASE, "user_id": None}, {**BASE, "event_type": None}, {**BASE, "event_type": "signup"}]
    assert silver(spark, *bad, b"not json", b"{", b"") == []


def test_missing_and_nan_prices_become_zero(spark):
    without = {key: value for key, value in BASE.items() if key != "price"}
    nan = json.dumps({**BASE, "price": math.nan}).encode()
    assert [row.price for row in silver(spark, without, {**BASE, "price": None}, nan)] == [0.0, 0.0, 0.0]


def test_missing_text_is_unknown_and_blank_text_is_empty(spark):
    rows = silver(spark, {**BASE, "brand": None, "category_code": None}, {**BASE, "brand": "   ", "category_code": ""})
    assert [(row.brand, row.category_code) for row in rows] == [("unknown", "unknown"), ("", "")]


def test_unparsable_time_is_null(spark):
    times = ["2019-11-01T00:00:00", "2019-11-01 00:00:00", "2019-11-01 00:00:00 PST", "", None]
    assert [row.event_timestamp for row in silver(spark, *[{**BASE, "event_time": t} for t in times])] == [None] * 5


def test_time_does_not_depend_on_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            times = spark.createDataFrame([("2019-11-01 00:00:00 UTC",)], "event_time STRING")
            assert times.select(cleaning.event_instant().cast("long")).first()[0] == 1572566400
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_each_message_is_parsed_once(spark, tmp_path):
    records.publish_to_files(messages(spark, BASE), str(tmp_path / "r"))
    events = ingest.silver_events(spark.read.parquet(str(tmp_path / "r")))
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_records_round_trip(spark):
    raw = spark.createDataFrame([BASE], schema.RAW_EVENT)
    sent = records.event_records(ingest.clean_raw(raw), AS_OF).withColumn("timestamp", F.lit(AS_OF))
    (row,) = sent.collect()
    body = json.loads(row.value)
    assert row.key == "1005105" and list(body) == [*BASE, "processed_timestamp"]
    assert body["processed_timestamp"] == "2024-05-06T07:08:09.000000"
    (back,) = ingest.parse_events(sent).select(*BASE).collect()
    assert back.asDict() == BASE


def test_payload_keeps_null_fields(spark):
    raw = spark.createDataFrame([{**BASE, "brand": None}], schema.RAW_EVENT)
    body = json.loads(records.event_records(raw, AS_OF).first().value)
    assert body["brand"] is None


def test_clean_report_counts_both_sides(spark):
    raw = spark.createDataFrame([BASE, {**BASE, "event_time": None}, {**BASE, "event_type": "x"}], schema.RAW_EVENT)
    assert tuple(ingest.clean_report(raw).first()) == (3, 1)
    assert ingest.clean_raw(raw).count() == 1


def test_csv_reads_ids_as_text_and_spelled_out_gaps_as_null(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(
        "extra,event_time,event_type,product_id,category_id,category_code,price,brand,user_id,user_session\n"
        "1,2019-11-01 00:00:00 UTC,view,007,22,NaN,,N/A,5,s\n"
        "2,2019-11-01 00:00:00 UTC,view,8,22,a.b,NaN,  x ,,null\n"
        "3,2019-11-01 00:00:00 UTC,view,9,22,a.b,12.50,y,1,s\n"
    )
    first, second, third = files.event_csv(spark, str(path)).collect()
    assert (first.product_id, first.category_code, first.brand, first.price, first.user_id) == ("007", None, None, None, "5")
    assert (second.brand, second.price, third.price) == ("  x ", None, 12.5) and second.user_id is None and second.user_session is None


def test_csv_sink_keeps_blanks(spark, tmp_path):
    table = spark.createDataFrame([("  a ", 1.5), (None, None)], "brand STRING, price DOUBLE")
    sinks.csv_object(table, str(tmp_path / "t"))
    back = files.csv_table(spark, str(tmp_path / "t"), table.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, table.collect()), key=str)


def test_sample_events_alternate_and_survive_cleaning(spark):
    sample = records.sample_events(spark.range(5), AS_OF)
    assert [row.event_type for row in sample.orderBy("product_id").collect()] == ["view", "cart", "view", "cart", "view"]
    sent = records.event_records(sample, AS_OF).withColumn("timestamp", F.lit(AS_OF))
    rows = ingest.silver_events(sent, AS_OF).collect()
    assert len(rows) == 5 and all(row.event_timestamp is not None for row in rows)


def test_empty_or_missing_folder_is_an_empty_table(spark, tmp_path):
    assert files.parquet_folder(spark, str(tmp_path)).count() == 0
    missing = files.parquet_folder(spark, str(tmp_path / "none"), columns="a INT")
    assert missing.count() == 0 and missing.columns == ["a"]


def test_folder_reads_nested_parquet_only(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t" / "x=1"))
    spark.range(3, 5).write.parquet(str(tmp_path / "t" / "deep" / "er"))
    (tmp_path / "t" / "note.txt").write_text("no")
    table = files.parquet_folder(spark, str(tmp_path / "t"))
    assert table.columns == ["id"] and sorted(r.id for r in table.collect()) == [0, 1, 2, 3, 4]


def test_listing_gives_size_without_content(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"12345")
    (row,) = files.file_listing(spark, str(tmp_path), "*.bin").collect()
    assert (row.name, row.size) == ("a.bin", 5)
    assert abs(row.last_modified.timestamp() - os.path.getmtime(tmp_path / "a.bin")) < 86400


def test_image_messages(spark, tmp_path):
    for folder, name, content in (("a_b", "1.jpg", b"\xff\x00x"), ("a_b", "2.jpg", b"y"), ("other", "3.jpg", b"z")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(content)
    categories = spark.createDataFrame([("a.b",), ("a_b",), ("c",)], "category_code STRING")
    found = files.image_messages(files.image_files(spark, str(tmp_path)), categories).collect()
    bodies = sorted((b["category"], b["image_name"], b["image_data"]) for b in (json.loads(r.value) for r in found))
    assert bodies == [("a.b", "1.jpg", "/wB4"), ("a.b", "2.jpg", "eQ=="), ("a_b", "1.jpg", "/wB4"), ("a_b", "2.jpg", "eQ==")]


def test_gold_table_counts_while_writing(spark, tmp_path):
    table = spark.range(25).withColumn("k", F.col("id") % 3)
    assert sinks.gold_table(table, str(tmp_path), "t") == 25
    assert sinks.gold_table(table, str(tmp_path), "t", ["k"]) == 25
    assert sinks.gold_table(table.filter("id < 0"), str(tmp_path), "empty") == 0
    assert files.parquet_table(spark, str(tmp_path / "t")).count() == 25
    assert files.parquet_table(spark, str(tmp_path / "empty")).count() == 0


def test_silver_date_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "silver")
    sinks.silver_table(ingest.silver_events(messages(spark, BASE, {**BASE, "event_type": "cart"}), AS_OF), path)
    assert files.silver(spark, path, since="2024-05-06", until="2024-05-06").count() == 2
    later = files.silver(spark, path, since=datetime.date(2024, 5, 7))
    assert later.count() == 0
    assert "PartitionFilters: [isnotnull(processing_date" in later._jdf.queryExecution().toString()


def test_quotes_and_line_breaks_in_csv(spark, tmp_path):
    path = tmp_path / "events.csv"
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    body = 't1,view,1,c,"a,b","ac""me, ltd",5.5,u,s\nt2,view,2,c,"two\nlines",plain,6.5,u,s\nt3,cart,3,c,,"""",,u,s\n'
    path.write_text(header + body)
    with open(path, newline="") as file:
        wanted = [tuple(value or None for value in row) for row in list(csv.reader(file))[1:]]
    found = files.event_csv(spark, str(path)).orderBy("event_time").collect()
    assert [tuple(None if value is None else str(value) for value in row) for row in found] == wanted
    again = str(tmp_path / "again")
    sinks.csv_object(files.event_csv(spark, str(path)), again)
    assert sorted(map(str, files.event_csv(spark, again).collect())) == sorted(map(str, found))


def test_rows_with_more_fields_than_the_header_fail(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("product_id,brand\n1,a\n2,b,c\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        files.csv_table(spark, str(path)).collect()
    path.write_text("product_id,brand\n1,a\n2\n")
    assert [tuple(row) for row in files.csv_table(spark, str(path)).collect()] == [(1, "a"), (2, None)]
