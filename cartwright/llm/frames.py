"""Small helpers shared by the operators: Arrow batches of bounded size, and column names that clash with nothing."""

import os
import tempfile
import zipfile

import pyarrow as pa

SLICE_BYTES = 16 << 20


_shipped = {}


def ship(spark):
    """Sends this package to the executors' Python workers, once per application, so that they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.TemporaryDirectory(prefix="cartwright-package-")
    target = os.path.join(os.path.realpath(folder.name), "cartwright-package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for place, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    source = os.path.join(place, name)
                    archive.write(source, os.path.relpath(source, os.path.dirname(package)))
    context.addPyFile(target)
    _shipped[context.applicationId] = folder


def map_arrow(df, function, schema):
    """mapInArrow with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def fresh(df, base):
    """A column name the table does not use, whatever its own columns are called."""
    taken = {name.lower() for name in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name = "_" + name
    return name


def id_type(df, name="doc_id"):
    """The SQL type of an id column, for the schemas of Python stages."""
    return df.schema[name].dataType.simpleString()


def bounded(batches, size=SLICE_BYTES):
    """Arrow batches cut into slices of about `size` bytes, so that a batch of very long texts is worked off in steps."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, min(rows, rows * size // max(1, batch.nbytes)))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def texts(column):
    """A string column as Python strings; null counts as empty."""
    return [text or "" for text in column.to_pylist()]


def raw_texts(column):
    """A string column as UTF-8 bytes; null counts as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def record(columns):
    return pa.RecordBatch.from_pydict(columns)
