"""Compaction of closed silver folders: every event once, before, after and when it breaks off."""

from datetime import date, datetime, timezone

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from cartwright import schema
from cartwright.plans import fixtures
from cartwright.sources import files, records
from cartwright.streaming import compaction
from cartwright.streaming import ingest as stream_ingest

DAYS = [datetime(2024, 1, day, 12, tzinfo=timezone.utc) for day in (2, 3, 4)]


class Lake:
    def __init__(self, spark, folder):
        self.spark, self.path, self.store = spark, str(folder / "silver"), str(folder / "compact")
        self.source, self.checkpoint = str(folder / "in"), str(folder / "checkpoint")

    def take_in(self, day, rows=120, batches=3):
        """Some more records, streamed in several batches of the given day."""
        raw = fixtures.raw_records(self.spark, SMALL).limit(rows).repartition(batches)
        records.publish_to_files(raw, self.source, partitions=batches)
        stream = records.file_stream(self.spark, self.source, files_per_trigger=1)
        stream_ingest.write_silver(stream, self.path, self.checkpoint, as_of=day).awaitTermination()

    def compact(self, before):
        return compaction.compact_closed(self.spark, self.path, self.store, before)

    def current(self):
        return compaction.current_silver(self.spark, self.path, self.store)

    def agrees(self):
        plain, current = files.silver(self.spark, self.path), self.current()
        assert current.dtypes == plain.dtypes
        assert sorted(map(str, current.collect())) == sorted(map(str, plain.collect()))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def _files_per_folder(table):
    used = table.select(*schema.SILVER_PARTITIONS, F.col("_metadata.file_path").alias("file")).distinct()
    return {(row[0], row[1]): row["count"] for row in used.groupBy(*schema.SILVER_PARTITIONS).count().collect()}


def test_closed_dates_are_read_from_few_files(spark, lake):
    lake.take_in(DAYS[0])
    lake.take_in(DAYS[1])
    lake.agrees()
    assert lake.compact(date(2024, 1, 2)) == []
    assert lake.compact(date(2024, 1, 3)) == [date(2024, 1, 2)]
    lake.agrees()
    assert min(_files_per_folder(files.silver(spark, lake.path)).values()) >= 2
    paths = [file for file in lake.current().inputFiles() if "processing_date=2024-01-02" in file]
    assert paths and all(file.startswith(f"file://{lake.store}") for file in paths)
    assert len(paths) <= files.silver(spark, lake.path).select("event_type").distinct().count()
    assert not any(lake.store in file for file in lake.current().inputFiles() if "2024-01-03" in file)
    assert lake.compact(date(2024, 1, 3)) == []


def test_late_files_and_further_dates(spark, lake):
    lake.take_in(DAYS[0])
    lake.compact(date(2024, 1, 5))
    lake.take_in(DAYS[0], rows=50)  # a batch of a closed date, committed after its compaction
    lake.take_in(DAYS[2])
    lake.agrees()
    assert lake.compact(date(2024, 1, 4)) == [date(2024, 1, 2)]
    lake.agrees()
    assert lake.compact(date(2024, 1, 5)) == [date(2024, 1, 4)]
    lake.agrees()
    assert compaction.newest_version(spark, lake.store) == 3
    # All three versions' runs but the two named are dropped, with the two older manifests.
    assert compaction.drop_unused(spark, lake.store) == 3
    lake.agrees()
    assert compaction.drop_unused(spark, lake.store) == 0


@pytest.mark.parametrize("broken", ["before the manifest", "inside the manifest"])
def test_a_run_that_breaks_off_is_never_read(spark, lake, monkeypatch, broken):
    lake.take_in(DAYS[0])
    lake.compact(date(2024, 1, 3))
    lake.take_in(DAYS[1])
    real = compaction._publish

    def fail(session, store, version, manifest):
        if broken == "inside the manifest":
            real(session, store, version, manifest)
            marker, system = compaction._system(session, f"{store}/manifest/version={version}/_SUCCESS")
            system.delete(marker, False)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "_publish", fail)
        with pytest.raises(RuntimeError, match="lost"):
            lake.compact(date(2024, 1, 4))
    lake.agrees()
    assert compaction.newest_version(spark, lake.store) == 1
    assert lake.compact(date(2024, 1, 4)) == [date(2024, 1, 3)]
    lake.agrees()
    assert compaction.drop_unused(spark, lake.store) == 2
    lake.agrees()


def test_a_reader_keeps_its_version_while_dates_are_swapped(spark, lake):
    lake.take_in(DAYS[0])
    reading = lake.current()
    before = reading.count()
    lake.compact(date(2024, 1, 3))
    assert reading.count() == before == lake.current().count()


def test_odd_folder_names(spark, tmp_path):
    folder = tmp_path / "a b%20c+ü"
    folder.mkdir()
    lake = Lake(spark, folder)
    lake.take_in(DAYS[0], batches=1)
    assert lake.compact(date(2024, 1, 3)) == [date(2024, 1, 2)]
    lake.agrees()
