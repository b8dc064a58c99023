"""Compaction of closed silver folders beside a running stream.

A stream with a short trigger leaves many small files per processing date and event type. `compact_closed` rewrites the dates that are
over into files of even size below `store`, and `current_silver` reads those in place of the small ones. Nothing of the
stream's own folder is touched, so the stream and its log go on as they are.

`store`/data/run=<id> holds what one compaction wrote; `store`/manifest/version=<n> names, for every compacted date, the run
that holds it and the stream files that run was made from. A version counts once its success marker is there, which is the
swap: before it readers take the small files, after it the compacted ones, never both. A run that broke off is not named
anywhere and never read. A file that reaches a closed date late is in no manifest, so it is read from the stream's folder
until the next compaction takes its date again. One compaction may run at a time; readers and the stream need not stop.
"""

import re
import uuid
from datetime import date
from urllib.parse import unquote

from cartwright import schema
from cartwright.sources import files

_DATE = re.compile(r"/processing_date=(\d{4}-\d{2}-\d{2})/")
_VERSION = re.compile(r"version=(\d+)$")
_MANIFEST = "processing_date DATE, run STRING, file STRING"
_MARKER = "_SUCCESS"


def _system(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark, path):
    place, system = _system(spark, path)
    return [status.getPath() for status in system.listStatus(place)] if system.exists(place) else []


def newest_version(spark, store):
    """The number of the last finished manifest; 0 without one."""
    newest = 0
    for folder in _folders(spark, f"{store}/manifest"):
        named = _VERSION.search(folder.getName())
        marker, system = _system(spark, f"{folder.toString()}/{_MARKER}")
        if named and system.exists(marker):
            newest = max(newest, int(named[1]))
    return newest


def _manifest(spark, store, version):
    if not version:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{store}/manifest/version={version}")


def _date_of(file):
    named = _DATE.search(file)
    return date.fromisoformat(named[1]) if named else None


def _stream_files(silver):
    """The files the stream has committed; Spark's own listing, already on the driver."""
    return [unquote(file) for file in silver.inputFiles()]


def _read(spark, base, paths, like):
    return spark.read.schema(like.schema).option("basePath", base).parquet(*paths).select(*like.columns)


def _publish(spark, store, version, manifest):
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{store}/manifest/version={version}")


def compact_closed(spark, path, store, before):
    """Compacts the processing dates before the given one that have files in no manifest; returns them.

    Each of them is read from the stream's files and cut into files of Spark's advisory partition size.
    """
    version = newest_version(spark, store)
    known = _manifest(spark, store, version)
    listed = {row["file"] for row in known.select("file").collect()}
    silver = files.silver(spark, path)
    closed = {file: day for file in _stream_files(silver) if (day := _date_of(file)) and day < before}
    days = sorted({day for file, day in closed.items() if file not in listed})
    if not days:
        return []
    run = uuid.uuid4().hex
    taken = [(day, run, file) for file, day in closed.items() if day in days]
    # These files and no others: one that arrives meanwhile must not be read without being listed.
    events = _read(spark, path, [file for *_, file in taken], silver)
    events.hint("rebalance", *schema.SILVER_PARTITIONS).write.partitionBy(*schema.SILVER_PARTITIONS).parquet(f"{store}/data/run={run}")
    kept = known.filter(~known["processing_date"].isin(days))
    _publish(spark, store, version + 1, kept.unionByName(spark.createDataFrame(taken, _MANIFEST)))
    return days


def current_silver(spark, path, store):
    """All silver events, each once: compacted dates from `store`, everything else from the stream's files."""
    # The manifest first: a file that joins the stream's folder after it is in none, hence read as it is.
    manifest = _manifest(spark, store, newest_version(spark, store)).collect()
    silver = files.silver(spark, path)
    if not manifest:
        return silver
    listed = {row["file"] for row in manifest}
    folders = sorted({f"{store}/data/run={row['run']}/processing_date={row['processing_date']}" for row in manifest})
    compacted = _read(spark, f"{store}/data", folders, silver)
    small = [file for file in _stream_files(silver) if file not in listed]
    return compacted.unionByName(_read(spark, path, small, silver)) if small else compacted


def drop_unused(spark, store):
    """Removes runs that the newest manifest does not name, and older manifests. Only while no reader uses an older one."""
    version = newest_version(spark, store)
    used = {f"run={row['run']}" for row in _manifest(spark, store, version).select("run").distinct().collect()}
    stale = [folder for folder in _folders(spark, f"{store}/data") if folder.getName() not in used]
    stale += [folder for folder in _folders(spark, f"{store}/manifest") if folder.getName() != f"version={version}"]
    for folder in stale:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(stale)
