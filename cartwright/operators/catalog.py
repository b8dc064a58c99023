"""Catalogue browsing over product statistics."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright import schema
from cartwright.functions import display, metrics
from cartwright.operators.indexing import numbered

PAGE_SIZE = 12
SMALL_PAGE_SIZE = 6  # screens under 768 pixels
ROWS_PER_FILE = 100_000


def catalogue(stats):
    """The columns the catalogue shows."""
    return stats.select(
        "product_id", "category_code", "brand", F.col("avg_price").alias("price"),
        "view_count", "cart_count", "purchase_count",
    )


def shown_text():
    return F.lower(F.concat_ws(" ", "category_code", "brand"))


def price_bounds(text):
    """`100-500` as (100.0, 500.0); `1000+`, `1000-` and `1000` as (1000.0, None); None where no lower bound is given."""
    low, dash, high = text.removesuffix("+").partition("-")
    if not low:
        return None
    return float(low), float(high) if dash and high else None


def in_price_range(products, text):
    if not text:
        return products
    bounds = price_bounds(text)
    if bounds is None:
        return products.filter(F.lit(False))
    low, high = bounds
    kept = products.filter(F.col("price") >= low)
    return kept if high is None else kept.filter(F.col("price") <= high)


def browse(products, search="", category="", brand="", price_range=""):
    """Literal text search, exact category and brand, and a price range."""
    term = (search or "").strip().lower()
    if term:
        products = products.filter(F.contains(shown_text(), F.lit(term)))
    if category:
        products = products.filter(F.col("category_code") == category)
    if brand:
        products = products.filter(F.col("brand") == brand)
    return in_price_range(products, price_range)


def filter_options(products):
    """Distinct non-empty categories and brands, from one pass."""
    choices = F.array(
        F.struct(F.lit("category").alias("kind"), F.col("category_code").alias("option")),
        F.struct(F.lit("brand").alias("kind"), F.col("brand").alias("option")),
    )
    listed = products.select(F.inline(choices)).filter(F.col("option") != "").distinct()
    return listed.orderBy("kind", "option")


def _keys(products):
    return [key for key in schema.PRODUCT_KEYS if key in products.columns]


def page_count(products, size=PAGE_SIZE):
    """One row: the number of products and of pages."""
    return products.agg(F.count("*").alias("products")).withColumn(
        "pages", F.ceil(F.col("products") / size).cast("bigint")
    )


def page_folder(products, path, rows_per_file=ROWS_PER_FILE):
    """Writes the catalogue once in key order for paging: `path`/rows, and beside it `path`/files with each file's first place.

    Rows are sorted by range and numbered by partition, so nothing goes through one task; a file holds at most
    `rows_per_file` neighbouring rows.
    """
    spark = products.sparkSession
    numbered(products.orderBy(*_keys(products)), "catalogue").write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    file = F.col("_metadata.file_path").alias("file")
    rows = spark.read.parquet(f"{path}/rows").select(file, "place")
    listed = rows.groupBy("file").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    listed.coalesce(1).write.parquet(f"{path}/files")


def stored_page(spark, path, number=1, size=PAGE_SIZE):
    """Page `number` of a written catalogue, clamped to the pages there are; reads the listing and the one or two files it lies in.

    The listing has one row per file; only the rows of it that meet the page come to the driver, two at most for pages
    no longer than a file.
    """
    files = spark.read.parquet(f"{path}/files")
    rows = (files.agg(F.max("last")).first()[0] if number != 1 else None) or 0
    number = min(max(int(number), 1), max(1, rows // size + 1)) if number != 1 else 1
    first = (number - 1) * size
    meeting = files.filter((F.col("first") < first + size) & (F.col("last") >= first)).select("file").collect()
    table = spark.read.parquet(*sorted(row["file"] for row in meeting)) if meeting else spark.read.parquet(f"{path}/rows").limit(0)
    return table.filter(F.col("place").between(first, first + size - 1)).orderBy("place").drop("place")


def page(products, number=1, size=PAGE_SIZE):
    """Page `number` of a catalogue that is not written for paging: sorts it whole. See `page_folder` and `page_after`."""
    pages = page_count(products, size).first()["pages"]
    number = min(max(int(number), 1), max(pages, 1))
    first = (number - 1) * size
    placed = numbered(products.orderBy(*_keys(products)), "catalogue")
    return placed.filter(F.col("place").between(first, first + size - 1)).orderBy("place").select(*products.columns)


def page_after(products, last=None, size=PAGE_SIZE):
    """The page that follows a given last row (its key values by name); the first page without one."""
    keys = _keys(products)
    if last:
        later = F.lit(False)
        for key in reversed(keys):
            value = F.lit(last[key])
            later = (F.col(key) > value) | ((F.col(key) == value) & later)
        # The plain bound on the first key is implied by `later` but can be pushed into the scan.
        products = products.filter(F.col(keys[0]) >= F.lit(last[keys[0]])).filter(later)
    return products.orderBy(*keys).limit(size)


def top_by(products, kind, size=5):
    """The leading products by `{kind}_count`, a missing count being 0, with their 1-based position."""
    count = F.coalesce(F.col(f"{kind}_count"), F.lit(0))
    leading = products.withColumn("shown_count", count).orderBy(F.desc("shown_count"), *_keys(products)).limit(size)
    # The window runs over the `size` rows kept above.
    order = Window.orderBy(F.desc("shown_count"), *_keys(products))
    return leading.select(
        F.row_number().over(order).alias("position"), "product_id", "category_code", "shown_count"
    )


def with_match_score(products):
    return products.withColumn("match_score", metrics.match_score())


def with_display_text(products):
    return products.withColumns(
        {
            "category_text": display.category_text(),
            "brand_text": display.capitalised(),
            "price_text": display.price_text(),
        }
    )


def suggest(products, text, size=5):
    """The most popular products whose text contains the term; none until it is longer than two characters."""
    if len(text) <= 2:
        return products.filter(F.lit(False))
    found = products.filter(F.contains(shown_text(), F.lit(text.lower())))
    return found.withColumn("popularity_score", metrics.popularity()).orderBy(
        F.desc("popularity_score"), *_keys(products)
    ).limit(size).select(*products.columns)
