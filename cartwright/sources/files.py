"""Readers for event files, tables, folders, images and saved models."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright import schema
from cartwright.operators import ingest

NO_FILES = {"UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"}


def _csv_rows(spark, path, columns, multi_line):
    """CSV rows under given columns. A row with more fields than columns ends the query instead of losing its tail.

    Quotes inside quoted fields are doubled. `multi_line` allows line breaks in them; without it large files can be split.
    """
    extra = "_more"
    while extra in columns.names:
        extra = "_" + extra
    shape = T.StructType([*columns.fields, T.StructField(extra, T.StringType())])
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    # The header has one name less than the shape; only the names given here count.
    rows = reader.option("enforceSchema", True).schema(shape).csv(path)
    fits = F.when(F.col(extra).isNotNull(), F.raise_error(F.lit(f"a row of {path} has more than {len(columns)} fields")))
    return rows.filter(F.coalesce(fits.cast("boolean"), F.lit(True))).drop(extra)


def _csv_header(spark, path, **options):
    return spark.read.options(header=True, escape='"', **options).csv(path)


def event_csv(spark, path, multi_line=True):
    """Raw events from CSV, columns found by their header. Ids stay text; every spelling of "no value" becomes null."""
    shape = T.StructType.fromDDL(schema.RAW_EVENT)
    rows = _csv_rows(spark, path, _csv_header(spark, path, multiLine=multi_line).schema, multi_line)
    present = ingest.null_text(rows, shape.names)
    return present.select(*[F.col(field.name).try_cast(field.dataType).alias(field.name) for field in shape])


def parquet_table(spark, path):
    """One parquet object or table; partition folders become columns."""
    return spark.read.parquet(path)


def parquet_folder(spark, folder, columns=None, merge_schema=False):
    """All `.parquet` files below a folder as one table; an empty or missing folder gives an empty table."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    if columns is not None:
        reader = reader.schema(columns)
    try:
        return reader.option("mergeSchema", merge_schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() not in NO_FILES:
            raise
        return spark.createDataFrame([], columns if columns is not None else T.StructType([]))


def csv_table(spark, path, columns=None, multi_line=True):
    """A CSV object with a header. Give `columns` for large files: without them Spark reads the file once more."""
    if columns is None:
        columns = _csv_header(spark, path, multiLine=multi_line, inferSchema=True).schema
    return _csv_rows(spark, path, columns, multi_line)


def file_listing(spark, folder, pattern="*"):
    """Path, name, size and modification time of the files below a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(folder).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def silver(spark, path, since=None, until=None):
    """Silver events, optionally only the partitions of a range of processing dates (inclusive)."""
    events = spark.read.parquet(path)
    if since is not None:
        events = events.filter(F.col("processing_date") >= F.lit(since).cast("date"))
    if until is not None:
        events = events.filter(F.col("processing_date") <= F.lit(until).cast("date"))
    return events


def bronze(spark, path):
    return spark.read.schema(schema.BRONZE).parquet(path)


def image_files(spark, folder, pattern="*"):
    """Files of one folder per category: folder name, file name and content. Spark passes over empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    parts = F.split("path", "/")
    return files.load(folder).select(
        F.element_at(parts, -2).alias("folder"),
        F.element_at(parts, -1).alias("image_name"),
        "content",
    )


def image_messages(images, categories):
    """One JSON message per image of a known category, under the category's own name."""
    named = images.join(ingest.category_folders(categories), "folder")
    return named.select(
        F.to_json(
            F.struct(F.col("category_code").alias("category"), "image_name", F.base64("content").alias("image_data"))
        ).alias("value")
    )


def model_parts(spark, model_path, parts=("metadata", "stages")):
    """The parquet tables inside a saved model, stacked, each row tagged with the part it comes from."""
    stacked = None
    for part in parts:
        rows = parquet_folder(spark, f"{model_path}/{part}", merge_schema=True).withColumn("source", F.lit(part))
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    return stacked

