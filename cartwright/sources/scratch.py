"""Intermediate tables in the shared folder named by `spark.checkpoint.dir`."""

import contextlib
import gc
import tempfile
import time
import uuid

from pyspark.sql.types import IntegerType, StructField, StructType

#: Whether the shuffle files of a query go when it has ended. Without it they stay on disk until the driver's JVM happens to
#: collect the plan, so that a chain of written tables holds the shuffles of all its steps at once.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folder = None
_run = []


def scratch_root(spark):
    """The cluster's shared folder. A throw-away folder stands in only when the master is local and none is named."""
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="cartwright-")
    return _local_folder.name


def ensure_checkpoint_dir(spark):
    """MLlib cuts long lineages through the context's checkpoint folder; name one if nobody has."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))


@contextlib.contextmanager
def run_folder(spark):
    """Gives the intermediate tables written inside a folder of their own, which goes at the end, also after a failure."""
    folder = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/run-{uuid.uuid4().hex}"
    _run.append(folder)
    try:
        yield folder
    finally:
        _run.pop()
        remove(spark, folder)


def scratch_path(spark, label):
    folder = _run[-1] if _run else f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def brief_shuffles(spark):
    """Queries that run inside leave no shuffle files behind when they end. For writes: nothing reads their shuffles again."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def release(spark):
    """Lets go of the files behind RDDs that nothing refers to any more, such as those of a fit that has ended."""
    # Spark drops what a round frees in the background, and with it may go the last reference to something else.
    for _ in range(3):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def remove(spark, path):
    """Removes a scratch table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_table(df, path, *partitions, mode="error"):
    """Writes a scratch table: read a few times and then gone, so packed tighter than what others read."""
    with brief_shuffles(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").partitionBy(*partitions).parquet(path)


def read_slices(spark, folder, like, name):
    """A table written as one folder `name`=number per slice, with the columns of `like` and the number."""
    shape = StructType([*like.schema.fields, StructField(name, IntegerType())])
    return spark.read.schema(shape).parquet(folder)


def materialize(df, label="table"):
    """Writes the rows once and returns the written table, so later steps neither recompute nor depend on lost executors."""
    spark = df.sparkSession
    target = scratch_path(spark, label)
    write_table(df, target)
    return spark.read.schema(df.schema).parquet(target)
