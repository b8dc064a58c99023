"""The registered queries: one per operator of the inventory, each over whole given tables.

Tables that several queries start from (silver events, gold tables, fitted models) are built once per session and folder
and written to the scratch folder, as the daily jobs would write them.
"""

import functools
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright import schema
from cartwright.functions import metrics
from cartwright.operators import (
    catalog, clustering, factorization, indexing, ingest, ranking, ratings, search, serving, similarity, statistics,
)
from cartwright.plans import fixtures
from cartwright.sources import files, records, scratch, sinks
from cartwright.streaming import ingest as stream_ingest
from cartwright.streaming import live

AS_OF = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
GIVEN_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
#: Rows per file of message records, and files a paced replay takes at a time.
FILE_ROWS, PACE = 5000, 2
#: Users and items a task of the check of recommendations scores against each other, at most about.
CHECK_USERS, CHECK_ITEMS = 1024, 8192
SEARCH_TERM = "brand#1"
SOME_ID = "1"

QUERIES = {}
_built = {}


def query(name):
    def register(function):
        QUERIES[name] = function
        return function

    return register


def built_once(function):
    """Keeps the result per Spark application and input folder."""

    @functools.wraps(function)
    def build(spark, sf_dir):
        key = (spark.sparkContext.applicationId, sf_dir, function.__name__)
        if key not in _built:
            _built[key] = function(spark, sf_dir)
        return _built[key]

    return build


def timeless(table):
    """Without the wall-clock column."""
    return table.drop("created_timestamp")


def local_time(table, *columns):
    return table.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})


# ---- shared tables -------------------------------------------------------------------------------------------------


@built_once
def silver_folder(spark, sf_dir):
    folder = scratch.scratch_path(spark, "silver")
    scratch.write_table(fixtures.commerce_events(spark, sf_dir), folder)
    return folder


@built_once
def silver(spark, sf_dir):
    return spark.read.schema(fixtures.commerce_events(spark, sf_dir).schema).parquet(silver_folder(spark, sf_dir))


@built_once
def record_files(spark, sf_dir):
    folder = scratch.scratch_path(spark, "records")
    records.publish_to_files(fixtures.raw_records(spark, sf_dir), folder, rows_per_file=FILE_ROWS)
    return folder


@built_once
def bronze_records(spark, sf_dir):
    return spark.read.schema(schema.RECORD).parquet(record_files(spark, sf_dir))


@built_once
def product_parts(spark, sf_dir):
    """From the activity, which no other query starts from: the largest table of all goes once the parts are written."""
    events, folder = silver(spark, sf_dir), scratch.scratch_path(spark, "product_parts")
    with scratch.run_folder(spark):
        parts = statistics.product_parts(statistics.written_activity(events))
        scratch.write_table(parts, folder)
    return spark.read.schema(parts.schema).parquet(folder)


@built_once
def product_stats(spark, sf_dir):
    return scratch.materialize(statistics.product_statistics(None, parts=product_parts(spark, sf_dir)), "product_statistics")


def _categories(spark, sf_dir):
    return statistics.category_statistics(None, parts=product_parts(spark, sf_dir))


def _brands(spark, sf_dir):
    return statistics.brand_statistics(None, parts=product_parts(spark, sf_dir))


@built_once
def category_stats(spark, sf_dir):
    return scratch.materialize(_categories(spark, sf_dir), "category_statistics")


@built_once
def brand_stats(spark, sf_dir):
    return scratch.materialize(_brands(spark, sf_dir), "brand_statistics")


@built_once
def rankings(spark, sf_dir):
    return scratch.materialize(ranking.product_rankings(product_stats(spark, sf_dir)), "product_rankings")


@built_once
def features(spark, sf_dir):
    return scratch.materialize(ranking.recommendation_features(product_stats(spark, sf_dir)), "features")


@built_once
def stand_in_clusters(spark, sf_dir):
    """Products with their category as the cluster, every fifth in its brand's as well, so that SQL can check what follows."""
    stats = product_stats(spark, sf_dir)
    second = stats.filter(F.col("product_id").cast("bigint") % 5 == 0).withColumn("cluster", F.col("brand"))
    return stats.withColumn("cluster", F.col("category_id")).unionByName(second)


@built_once
def similar(spark, sf_dir):
    return scratch.materialize(similarity.similar_products(stand_in_clusters(spark, sf_dir)), "similar_products")


@built_once
def all_ratings(spark, sf_dir):
    return scratch.materialize(ratings.user_product_ratings(silver(spark, sf_dir)), "ratings")


@built_once
def indexes(spark, sf_dir):
    return ratings.index_tables(all_ratings(spark, sf_dir))


@built_once
def indexed(spark, sf_dir):
    return scratch.materialize(
        ratings.indexed_ratings(all_ratings(spark, sf_dir), *indexes(spark, sf_dir)), "indexed_ratings"
    )


@built_once
def als_model(spark, sf_dir):
    train, _ = ratings.split_ratings(indexed(spark, sf_dir))
    return factorization.fit_factors(train)


@built_once
def product_clusters(spark, sf_dir):
    table = clustering.features_from_statistics(product_stats(spark, sf_dir))
    return clustering.fit_clusters(table)


@built_once
def recommendations(spark, sf_dir):
    table = factorization.user_recommendations(als_model(spark, sf_dir), *indexes(spark, sf_dir))
    return scratch.materialize(table, "user_recommendations")


@built_once
def catalogue_pages(spark, sf_dir):
    folder = scratch.scratch_path(spark, "pages")
    catalog.page_folder(shop_catalogue(spark, sf_dir), folder)
    return folder


def shop_catalogue(spark, sf_dir):
    return catalog.catalogue(product_stats(spark, sf_dir))


@built_once
def searchable_features(spark, sf_dir):
    folder = scratch.scratch_path(spark, "search")
    search.search_folder(features(spark, sf_dir), folder)
    return search.open_folder(spark, folder)


@built_once
def searchable_catalogue(spark, sf_dir):
    folder = scratch.scratch_path(spark, "search")
    search.search_folder(shop_catalogue(spark, sf_dir), folder)
    return search.open_folder(spark, folder)


# ---- sources and sinks ---------------------------------------------------------------------------------------------


@query("src_csv_events")
def _(spark, sf_dir):
    path = scratch.scratch_path(spark, "events-csv")
    sinks.csv_object(_quoted(fixtures.raw_events(spark, sf_dir).drop("event_id")), path)
    return files.event_csv(spark, path)


def _quoted(table, column="brand"):
    """Values with quotes, commas and line breaks in the given column."""
    return table.withColumn(column, F.concat(column, F.lit('"",\n"')))


def _rounded(table):
    """Mean prices cut to ten-thousandths off centre, where no mean of prices in cents lies on the edge."""
    means = [name for name in table.columns if name in ("avg_price", "avg_category_price", "avg_brand_price")]
    return table.withColumns({name: F.floor(F.col(name) * 10000 + F.lit(0.3585786438)) / F.lit(10000.0) for name in means})


def _finish(stream):
    stream.awaitTermination()


def _record_stream(spark, sf_dir, **options):
    return records.file_stream(spark, record_files(spark, sf_dir), **options)


@query("src_kafka_raw")
def _(spark, sf_dir):
    path, checkpoint = scratch.scratch_path(spark, "raw"), scratch.scratch_path(spark, "checkpoint")
    writer = _record_stream(spark, sf_dir).writeStream.format("parquet").option("path", path)
    _finish(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return local_time(ingest.record_text(files.parquet_table(spark, path)), "timestamp")


@query("src_kafka_events")
def _(spark, sf_dir):
    path, checkpoint = scratch.scratch_path(spark, "parsed"), scratch.scratch_path(spark, "checkpoint")
    parsed = ingest.parse_events(_record_stream(spark, sf_dir))
    writer = parsed.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    _finish(writer.trigger(availableNow=True).start())
    return local_time(files.parquet_table(spark, path), "kafka_timestamp")


@query("prj_kafka_cast")
def _(spark, sf_dir):
    return local_time(ingest.record_text(fixtures.raw_records(spark, sf_dir)), "timestamp")


def _bronze_by_stream(spark, sf_dir, **options):
    path, checkpoint = scratch.scratch_path(spark, "bronze"), scratch.scratch_path(spark, "checkpoint")
    _finish(stream_ingest.write_bronze(_record_stream(spark, sf_dir, **options), path, checkpoint))
    return path


@built_once
def bronze_folder(spark, sf_dir):
    return _bronze_by_stream(spark, sf_dir)


@query("snk_bronze_stream")
def _(spark, sf_dir):
    return local_time(files.bronze(spark, _bronze_by_stream(spark, sf_dir)), "timestamp")


SILVER_CHECKED = [name for name in schema.SILVER_COLUMNS if not name.startswith("processing")]


def _checked_silver(events):
    return local_time(events.select(*SILVER_CHECKED), "event_timestamp")


@query("snk_silver_stream")
def _(spark, sf_dir):
    path, checkpoint = scratch.scratch_path(spark, "silver"), scratch.scratch_path(spark, "checkpoint")
    _finish(stream_ingest.write_silver(_record_stream(spark, sf_dir), path, checkpoint))
    return _checked_silver(files.silver(spark, path))


@query("snk_console")
def _(spark, sf_dir):
    """What the console shows of all columns, and how many rows it says went through it."""
    events = ingest.parse_events(_record_stream(spark, sf_dir))
    shown = []
    _finish(stream_ingest.write_console(events, scratch.scratch_path(spark, "checkpoint"), rows=2, write=shown.append))
    taken = sum(int(text.removeprefix("Rows: ")) for text in shown if text.startswith("Rows: "))
    # A printed table is framed by three rules and has its names in the first line between them.
    lines = [line for text in shown for line in text.splitlines() if line.startswith("|")]
    columns = len(lines[0].strip("|").split("|")) if lines else 0
    return spark.createDataFrame([(taken, len(lines) - 1, columns)], "input_rows bigint, printed_rows bigint, columns bigint")


@query("src_bronze_batch")
def _(spark, sf_dir):
    return local_time(files.bronze(spark, bronze_folder(spark, sf_dir)), "timestamp")


@query("snk_silver_batch")
def _(spark, sf_dir):
    path = scratch.scratch_path(spark, "silver")
    sinks.silver_table(ingest.silver_events(files.bronze(spark, bronze_folder(spark, sf_dir)), AS_OF), path)
    return _checked_silver(files.silver(spark, path))


@query("src_silver")
def _(spark, sf_dir):
    path = scratch.scratch_path(spark, "silver")
    sinks.silver_table(ingest.silver_events(fixtures.raw_records(spark, sf_dir), AS_OF), path, compact=True)
    day = AS_OF.date()
    events = files.silver(spark, path, since=day, until=day)
    return events.groupBy("processing_date", "event_type").agg(F.count("*").alias("events"))


@query("snk_gold")
def _(spark, sf_dir):
    folder = scratch.scratch_path(spark, "gold")
    rows = sinks.gold_table(product_stats(spark, sf_dir), folder, "product_statistics", cluster_by=["product_id"])
    table = files.parquet_table(spark, f"{folder}/product_statistics")
    return timeless(table).withColumn("written_rows", F.lit(rows).cast("bigint"))


@query("snk_reco_tables")
def _(spark, sf_dir):
    folder = scratch.scratch_path(spark, "gold")
    sinks.recommendation_tables(recommendations(spark, sf_dir), similar(spark, sf_dir), folder)
    users = files.parquet_table(spark, f"{folder}/user_recommendations")
    products = files.parquet_table(spark, f"{folder}/similar_products")
    return (
        users.groupBy(F.lit("user_recommendations").alias("table"), F.col("user_id").alias("id"))
        .agg(F.count("*").alias("rows"))
        .unionByName(
            products.groupBy(F.lit("similar_products").alias("table"), F.col("product_id").alias("id")).agg(
                F.count("*").alias("rows")
            )
        )
    )


@query("snk_models")
def _(spark, sf_dir):
    folder = scratch.scratch_path(spark, "gold")
    sinks.models(als_model(spark, sf_dir), product_clusters(spark, sf_dir)[0], folder)
    factors = ALSModel.load(f"{folder}/models/als_model")
    clusters = PipelineModel.load(f"{folder}/models/clustering_model").stages[-1]
    counted = statistics.row_counts({"user_factors": factors.userFactors, "item_factors": factors.itemFactors})
    centers = spark.range(len(clusters.clusterCenters()))
    return counted.unionByName(statistics.row_counts({"cluster_centers": centers}))


@query("src_parquet_object")
def _(spark, sf_dir):
    return local_time(files.parquet_table(spark, f"{sf_dir}/orders.parquet"), "o_orderdate")


@query("src_parquet_folder")
def _(spark, sf_dir):
    folder = scratch.scratch_path(spark, "folder")
    orders = fixtures.table(spark, sf_dir, "orders")
    customers = fixtures.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    sinks.parquet_object(orders, f"{folder}/orders/open")
    sinks.parquet_object(customers, f"{folder}/customers")
    return local_time(files.parquet_folder(spark, folder, merge_schema=True), "o_orderdate")


@query("snk_parquet_object")
def _(spark, sf_dir):
    path = scratch.scratch_path(spark, "object")
    sinks.parquet_object(fixtures.raw_events(spark, sf_dir), path)
    return files.parquet_table(spark, path)


@query("src_csv_object")
def _(spark, sf_dir):
    path = scratch.scratch_path(spark, "csv")
    sinks.csv_object(_quoted(fixtures.table(spark, sf_dir, "part"), "p_name"), path)
    return files.csv_table(spark, path, fixtures.table(spark, sf_dir, "part").schema)


@query("snk_csv_object")
def _(spark, sf_dir):
    path = scratch.scratch_path(spark, "csv")
    events = _quoted(fixtures.raw_events(spark, sf_dir))
    sinks.csv_object(events, path)
    return files.csv_table(spark, path, events.schema)


@query("src_file_listing")
def _(spark, sf_dir):
    """Text files of one folder per event type, listed without being read: the bytes of each folder."""
    folder = scratch.scratch_path(spark, "listed")
    lines = fixtures.raw_events(spark, sf_dir).select(fixtures.text("event_id").alias("value"), "event_type")
    lines.write.partitionBy("event_type").text(folder)
    listed = files.file_listing(spark, folder, "*.txt")
    kind = F.regexp_extract("path", "event_type=([^/]*)/", 1).alias("event_type")
    return listed.groupBy(kind).agg(F.sum("size").alias("bytes"), F.count_if(F.col("name") == "").alias("nameless"))


@query("snk_kafka_events")
def _(spark, sf_dir):
    events = ingest.clean_raw(fixtures.raw_events(spark, sf_dir))
    return records.event_records(events, AS_OF)


@query("src_paced_replay")
def _(spark, sf_dir):
    path = _bronze_by_stream(spark, sf_dir, files_per_trigger=PACE)
    return local_time(files.bronze(spark, path), "timestamp")


@query("src_sample_events")
def _(spark, sf_dir):
    ids = fixtures.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return records.sample_events(ids, AS_OF)


@query("src_images_binary")
def _(spark, sf_dir):
    """Bytes written to one folder per category come back whole inside the messages."""
    folder = scratch.scratch_path(spark, "images")
    events = fixtures.raw_events(spark, sf_dir).filter(F.col("category_code").isNotNull())
    content = events.select(fixtures.text("event_id").alias("value"), F.translate("category_code", ".", "_").alias("c"))
    content.write.option("maxRecordsPerFile", 1000).partitionBy("c").text(folder)
    images = files.image_files(spark, folder).withColumn("folder", F.regexp_extract("folder", "^c=(.*)$", 1))
    categories = ingest.distinct_categories(events)
    named = F.from_json("value", "category STRING, image_name STRING, image_data STRING")
    messages = files.image_messages(images, categories).select(named.alias("m"))
    size = F.octet_length(F.unbase64("m.image_data"))
    return messages.groupBy(F.col("m.category").alias("category")).agg(F.sum(size).cast("bigint").alias("bytes"))


@query("src_model_parts")
def _(spark, sf_dir):
    folder = scratch.scratch_path(spark, "model")
    product_clusters(spark, sf_dir)[0].write().save(folder)
    return files.model_parts(spark, folder).groupBy("source").agg(F.count("*").alias("rows"))


# ---- ingest and cleaning -------------------------------------------------------------------------------------------


def raw(spark, sf_dir):
    return fixtures.raw_events(spark, sf_dir)


@query("ing_drop_missing")
def _(spark, sf_dir):
    return ingest.drop_missing(raw(spark, sf_dir))


@query("ing_valid_events")
def _(spark, sf_dir):
    return ingest.keep_known_events(raw(spark, sf_dir)).select("event_id", "event_type")


@query("ing_cast_ids")
def _(spark, sf_dir):
    numbered = fixtures.numbered_events(spark, sf_dir).select(
        "event_id", F.col("p_partkey").alias("product_id"), F.col("p_size").alias("category_id"), "user_id"
    )
    return ingest.ids_as_text(numbered)


@query("ing_fill_price")
def _(spark, sf_dir):
    return ingest.fill_price(raw(spark, sf_dir)).select("event_id", "price")


@query("ing_null_text")
def _(spark, sf_dir):
    spelled = raw(spark, sf_dir).select(
        "event_id",
        F.coalesce("category_code", F.lit("NaN")).alias("category_code"),
        F.coalesce("brand", F.lit("")).alias("brand"),
    )
    return ingest.null_text(spelled)


@query("ing_stamp")
def _(spark, sf_dir):
    return ingest.stamp(raw(spark, sf_dir), AS_OF).select("event_id", "processed_timestamp")


@query("ing_clean_report")
def _(spark, sf_dir):
    return ingest.clean_report(raw(spark, sf_dir))


@query("ing_parse_json")
def _(spark, sf_dir):
    return local_time(ingest.parse_events(fixtures.raw_records(spark, sf_dir)), "kafka_timestamp")


@query("ing_required")
def _(spark, sf_dir):
    return ingest.require_ids(raw(spark, sf_dir)).select("event_id", "product_id", "user_id")


@query("ing_event_ts")
def _(spark, sf_dir):
    timed = ingest.with_event_timestamp(raw(spark, sf_dir)).select("event_id", "event_timestamp")
    return local_time(timed, "event_timestamp")


@query("ing_norm_brand")
def _(spark, sf_dir):
    return ingest.normalise_brand(raw(spark, sf_dir)).select("event_id", "brand")


@query("ing_norm_category")
def _(spark, sf_dir):
    return ingest.normalise_category(raw(spark, sf_dir)).select("event_id", "category_code")


@query("ing_processing_cols")
def _(spark, sf_dir):
    timed = ingest.with_processing_columns(raw(spark, sf_dir), AS_OF)
    return local_time(timed.select("event_id", "processing_date", "processing_timestamp"), "processing_timestamp")


@query("ing_silver")
def _(spark, sf_dir):
    events = ingest.silver_events(fixtures.raw_records(spark, sf_dir), AS_OF)
    return local_time(events, "event_timestamp", "processing_timestamp")


@query("ing_distinct_categories")
def _(spark, sf_dir):
    return ingest.distinct_categories(raw(spark, sf_dir))


@query("ing_category_slug")
def _(spark, sf_dir):
    return ingest.category_folders(ingest.distinct_categories(raw(spark, sf_dir)))


# ---- aggregations --------------------------------------------------------------------------------------------------


def _per_product(spark, sf_dir, *aggregates):
    return silver(spark, sf_dir).groupBy(*schema.PRODUCT_KEYS).agg(*aggregates)


@query("agg_event_counts")
def _(spark, sf_dir):
    return statistics.event_counts(silver(spark, sf_dir))


@query("agg_distincts")
def _(spark, sf_dir):
    columns = ("user_id", "user_session", "product_id", "brand", "category_code")
    return statistics.distinct_counts(silver(spark, sf_dir), "category_id", columns)


@query("agg_price_stats")
def _(spark, sf_dir):
    return _rounded(_per_product(spark, sf_dir, *statistics.price_stats()))


@query("agg_time_bounds")
def _(spark, sf_dir):
    return _per_product(spark, sf_dir, *statistics.time_bounds("first_seen", "last_seen"))


@query("agg_conversion_rates")
def _(spark, sf_dir):
    return statistics.with_rates(statistics.event_counts(silver(spark, sf_dir))).select(
        *schema.PRODUCT_KEYS, "view_to_cart_rate", "cart_to_purchase_rate", "view_to_purchase_rate"
    )


@query("agg_popularity")
def _(spark, sf_dir):
    counted = statistics.event_counts(silver(spark, sf_dir))
    return counted.select(*schema.PRODUCT_KEYS, metrics.popularity().alias("popularity_score"))


@query("agg_engagement_score")
def _(spark, sf_dir):
    return product_stats(spark, sf_dir).select(*schema.PRODUCT_KEYS, metrics.engagement_score().alias("engagement_score"))


@query("agg_engagement_rate")
def _(spark, sf_dir):
    rate = metrics.engagement_rate("total_events").alias("engagement_rate")
    return product_stats(spark, sf_dir).select(*schema.PRODUCT_KEYS, rate)


@query("gold_product_statistics")
def _(spark, sf_dir):
    return _rounded(timeless(statistics.product_statistics(silver(spark, sf_dir))))


@query("gold_category_statistics")
def _(spark, sf_dir):
    return _rounded(timeless(_categories(spark, sf_dir)))


@query("gold_brand_statistics")
def _(spark, sf_dir):
    return _rounded(timeless(_brands(spark, sf_dir)))


@query("reco_ratings")
def _(spark, sf_dir):
    rated = ratings.user_product_ratings(silver(spark, sf_dir))
    return rated.withColumn("final_rating", F.round("final_rating", 9))


@query("reco_product_features")
def _(spark, sf_dir):
    return _rounded(clustering.product_features(silver(spark, sf_dir)))


@query("reco_cluster_sizes")
def _(spark, sf_dir):
    return clustering.cluster_sizes(stand_in_clusters(spark, sf_dir))


@query("agg_row_counts")
def _(spark, sf_dir):
    return statistics.row_counts({name: fixtures.table(spark, sf_dir, name) for name in GIVEN_TABLES})


# ---- joins, windows, rankings --------------------------------------------------------------------------------------


@query("join_same_cluster")
def _(spark, sf_dir):
    return similarity.neighbour_pairs(stand_in_clusters(spark, sf_dir)).drop("rank")


@query("join_index_lookup")
def _(spark, sf_dir):
    named = indexing.replace_ids(indexed(spark, sf_dir), *indexes(spark, sf_dir))
    return named.select("user_id", "product_id", F.round(F.col("rating").cast("double"), 3).alias("rating"))


def _ranking_query(rank_type):
    def run(spark, sf_dir):
        return ranking.top_products(product_stats(spark, sf_dir), rank_type)

    return run


for _rank_type in schema.RANKINGS:
    QUERIES[f"rank_{_rank_type}"] = _ranking_query(_rank_type)


@query("gold_product_rankings")
def _(spark, sf_dir):
    return timeless(ranking.product_rankings(product_stats(spark, sf_dir)))


@query("win_percent_rank")
def _(spark, sf_dir):
    scores = product_stats(spark, sf_dir).select(*schema.PRODUCT_KEYS, "popularity_score")
    return ranking.with_percent_rank(scores)


def _cheaper(stats):
    """Prices a hundredth of the order lines', to reach more than the top tier."""
    return stats.withColumn("avg_price", F.col("avg_price") / 100)


@query("feat_price_tier")
def _(spark, sf_dir):
    stats = _cheaper(product_stats(spark, sf_dir))
    return stats.select(*schema.PRODUCT_KEYS, "avg_price", metrics.price_tier().alias("price_tier"))


@query("feat_engagement_tier")
def _(spark, sf_dir):
    return product_stats(spark, sf_dir).select(
        *schema.PRODUCT_KEYS, "engagement_score", metrics.engagement_tier().alias("engagement_tier")
    )


@query("gold_recommendation_features")
def _(spark, sf_dir):
    return timeless(ranking.recommendation_features(product_stats(spark, sf_dir)))


@query("win_topk_similar")
def _(spark, sf_dir):
    pairs = similarity.neighbour_pairs(stand_in_clusters(spark, sf_dir)).drop("rank")
    return similarity.top_similar(pairs, 5)


@query("reco_similar_products")
def _(spark, sf_dir):
    return similarity.similar_products(stand_in_clusters(spark, sf_dir))


# ---- recommendation and clustering ---------------------------------------------------------------------------------


@query("ml_index_ids")
def _(spark, sf_dir):
    rated = all_ratings(spark, sf_dir)
    users, products = ratings.index_tables(rated)

    def listed(table, kind):
        label, index = F.col(f"{kind}_id").alias("label"), F.col(f"{kind}_index").alias("index")
        return table.select(F.lit(kind).alias("kind"), label, index)

    return listed(users, "user").unionByName(listed(products, "product"))


@query("ml_split")
def _(spark, sf_dir):
    train, test = ratings.split_ratings(indexed(spark, sf_dir))
    return train.select(F.lit("train").alias("side"), "user", "item").unionByName(
        test.select(F.lit("test").alias("side"), "user", "item")
    )


@query("ml_als_fit")
def _(spark, sf_dir):
    model = als_model(spark, sf_dir)
    width = F.size("features").alias("factors")
    return model.userFactors.select(F.lit("user").alias("side"), "id", width).unionByName(
        model.itemFactors.select(F.lit("item").alias("side"), "id", width)
    )


@query("ml_als_score")
def _(spark, sf_dir):
    _, test = ratings.split_ratings(indexed(spark, sf_dir))
    scored = factorization.score_pairs(als_model(spark, sf_dir), test)
    return scored.select("user", "item", (~F.isnan("prediction")).alias("scored"))


@query("ml_rmse")
def _(spark, sf_dir):
    scored = all_ratings(spark, sf_dir).select(
        F.col("final_rating").alias("rating"), F.col("interaction_count").alias("prediction")
    )
    return factorization.rmse(scored).select(F.round("rmse", 6).alias("rmse"))


def _product(left, right):
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _near(left, right):
    return F.abs(left - right) <= 1e-5 * F.greatest(F.lit(1.0), F.abs(left))


def _chunks(table, key, vector, size):
    """Rows of the table gathered into chunks of about `size` rows: chunk, keys, vectors."""
    count = max(1, -(-table.count() // size))
    chunk = F.pmod(F.hash(key), F.lit(count))
    pairs = F.collect_list(F.struct(F.col(key).alias("key"), F.col(vector).alias("vector")))
    return table.groupBy(chunk.alias("chunk")).agg(pairs.alias("rows"))


def _chunk_tops(users, items, k):
    """user and top: each user's k best inner products with the items of every chunk of items."""
    import numpy as np
    import pandas as pd

    def matrix(rows):
        keys = np.array([row["key"] for row in rows], dtype=np.int64)
        return keys, np.array([np.asarray(row["vector"], dtype=np.float64) for row in rows])

    def tops(frames):
        for frame in frames:
            for left, right in zip(frame["left_rows"], frame["right_rows"]):
                people, left = matrix(left)
                _, right = matrix(right)
                scores = left @ right.T
                keep = min(k, scores.shape[1])
                best = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep:]
                yield pd.DataFrame({"user": np.repeat(people, keep).astype(np.int32), "top": best.ravel()})

    pairs = users.select(F.col("rows").alias("left_rows")).crossJoin(items.select(F.col("rows").alias("right_rows")))
    return pairs.mapInPandas(tops, "user int, top double")


def _true_scores(spark, sf_dir, flat):
    """Whether each score is the product of the two factor rows; of every 50th user, also whether it is the best for its rank."""
    model = als_model(spark, sf_dir)
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("left"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("right"))
    own = flat.join(users, "user").join(items, "item").withColumn("own", _product("left", "right")).drop("left", "right")

    # The asked users against all items, a bounded chunk of users against a bounded chunk of items per task; each task
    # keeps only its users' 10 best scores, so no pair of user and item is shuffled or sorted.
    asked = users.filter(F.col("user") % 50 == 0)
    scored = _chunk_tops(_chunks(asked, "user", "left", CHECK_USERS), _chunks(items, "item", "right", CHECK_ITEMS), 10)
    place = F.row_number().over(Window.partitionBy("user").orderBy(F.desc("top")))
    tops = scored.withColumn("rank", place).filter(F.col("rank") <= 10)
    checked = own.join(tops, ["user", "rank"], "left")
    best = F.coalesce(_near(F.col("top"), F.col("score")), F.col("user") % 50 != 0)
    return checked.withColumn("scored", _near(F.col("own"), F.col("score")) & best)


@query("ml_recommend_all")
def _(spark, sf_dir):
    lists = factorization.recommend_all(als_model(spark, sf_dir))
    scores = F.col("recommendations.rating")
    falling = scores == F.reverse(F.array_sort(scores))
    once = F.size(F.array_distinct("recommendations.item")) == F.size("recommendations")
    return lists.select("user", F.size("recommendations").alias("picks"), falling.alias("falling"), once.alias("once"))


@query("ml_recommend_flat")
def _(spark, sf_dir):
    flat = factorization.flatten(factorization.recommend_all(als_model(spark, sf_dir)))
    return _true_scores(spark, sf_dir, flat).select("user", "rank", "scored")


@query("ml_user_range")
def _(spark, sf_dir):
    return indexing.dense_range(spark, indexes(spark, sf_dir)[0].count())


def _named_scores(spark, sf_dir, listed):
    """user_id, rank and whether the score belongs to the user and product named."""
    users, products = indexes(spark, sf_dir)
    numbered = listed.join(users, "user_id").join(products, "product_id").withColumnsRenamed(
        {"user_index": "user", "product_index": "item"}
    )
    return _true_scores(spark, sf_dir, numbered).select("user_id", "rank", "scored")


@query("ml_generate_recommendations")
def _(spark, sf_dir):
    listed = factorization.user_recommendations(als_model(spark, sf_dir), *indexes(spark, sf_dir))
    return _named_scores(spark, sf_dir, listed)


def _features_table(spark, sf_dir):
    return clustering.features_from_statistics(product_stats(spark, sf_dir))


def _pipeline_until(spark, sf_dir, stages):
    table = _features_table(spark, sf_dir)
    model = clustering.Pipeline(stages=stages).fit(table)
    return model.transform(table)


@query("ml_index_categorical")
def _(spark, sf_dir):
    return _pipeline_until(spark, sf_dir, clustering.indexers()).select("product_id", "brand_index", "category_index")


def _vector_columns(column, digits=None):
    values = vector_to_array(column)
    named = [(values[place], name) for place, name in enumerate(schema.CLUSTER_FEATURES)]
    return [(value if digits is None else F.round(value, digits)).alias(name) for value, name in named]


@query("ml_assemble")
def _(spark, sf_dir):
    stages = [*clustering.indexers(), clustering.assembler()]
    return _pipeline_until(spark, sf_dir, stages).select("product_id", *_vector_columns("features"))


@query("ml_scale")
def _(spark, sf_dir):
    stages = [*clustering.indexers(), clustering.assembler(), clustering.scaler()]
    return _pipeline_until(spark, sf_dir, stages).select("product_id", *_vector_columns("scaled_features", 6))


def _assigned(model, clustered):
    """Whether each product's cluster is the one whose centre lies nearest to its scaled features."""
    centres = [[float(x) for x in centre] for centre in model.stages[-1].clusterCenters()]

    def gap(centre):
        parts = F.zip_with(vector_to_array("scaled_features"), F.array(*map(F.lit, centre)), lambda a, b: (a - b) * (a - b))
        return F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)

    gaps = F.array(*[gap(centre) for centre in centres])
    own = F.element_at(gaps, F.col("cluster") + 1)
    nearest = own <= F.array_min(gaps) * (1 + 1e-9) + 1e-9
    return clustered.select("product_id", nearest.alias("assigned"))


@query("ml_kmeans")
def _(spark, sf_dir):
    model, _ = product_clusters(spark, sf_dir)
    return _assigned(model, model.transform(_features_table(spark, sf_dir)))


@query("ml_cluster_products")
def _(spark, sf_dir):
    return _assigned(*clustering.fit_clusters(_features_table(spark, sf_dir)))


# ---- serving -------------------------------------------------------------------------------------------------------


@query("q_product_statistics")
def _(spark, sf_dir):
    return timeless(serving.product_statistics(product_stats(spark, sf_dir)))


@query("q_top_products")
def _(spark, sf_dir):
    return timeless(serving.top_products(rankings(spark, sf_dir), "most_carted", 10))


def _found(table):
    return timeless(table).select("product_id", "category_code", "brand", "avg_price", "popularity_score", "price_tier")


@query("q_search_text")
def _(spark, sf_dir):
    return _found(search.search_text(searchable_features(spark, sf_dir), "Brand#1[0-5]|eco"))


@query("q_filter_category")
def _(spark, sf_dir):
    return _found(serving.filter_category(features(spark, sf_dir), "^s(?P<rest>.*)d$"))


@query("q_filter_brand")
def _(spark, sf_dir):
    return _found(serving.filter_brand(features(spark, sf_dir), SEARCH_TERM))


@query("q_filter_price")
def _(spark, sf_dir):
    return _found(serving.filter_price(features(spark, sf_dir), "40000", "52000"))


@query("q_filter_tier")
def _(spark, sf_dir):
    return _found(serving.filter_tier(_tiered_again(features(spark, sf_dir)), "premium"))


def _tiered_again(table):
    return _cheaper(table).withColumn("price_tier", metrics.price_tier())


@query("q_search_products")
def _(spark, sf_dir):
    tables = searchable_features(spark, sf_dir)
    return _found(search.search_products(tables, SEARCH_TERM, category="s", price_min="0", price_tier="luxury"))


@query("q_product_details")
def _(spark, sf_dir):
    return timeless(serving.product_details(product_stats(spark, sf_dir), SOME_ID))


@query("q_similar_products")
def _(spark, sf_dir):
    return serving.similar_to(similar(spark, sf_dir), SOME_ID)


@query("q_user_recommendations")
def _(spark, sf_dir):
    return _named_scores(spark, sf_dir, serving.recommendations_for(recommendations(spark, sf_dir), SOME_ID))


@query("q_category_statistics")
def _(spark, sf_dir):
    return timeless(serving.category_statistics(category_stats(spark, sf_dir)))


@query("q_brand_statistics")
def _(spark, sf_dir):
    return timeless(serving.brand_statistics(brand_stats(spark, sf_dir)))


@query("q_recommendations_table")
def _(spark, sf_dir):
    return _named_scores(spark, sf_dir, serving.recommendations_table(recommendations(spark, sf_dir)))


@query("q_dashboard")
def _(spark, sf_dir):
    return serving.dashboard(rankings(spark, sf_dir), category_stats(spark, sf_dir), brand_stats(spark, sf_dir))


# ---- catalogue -----------------------------------------------------------------------------------------------------


@query("ui_browse_filter")
def _(spark, sf_dir):
    tables = searchable_catalogue(spark, sf_dir)
    return search.browse(tables, "D Brand#1", category="standard", price_range="1000+")


@query("ui_price_range")
def _(spark, sf_dir):
    priced = shop_catalogue(spark, sf_dir).withColumn("price", F.col("price") / 100)
    return catalog.in_price_range(priced, "100-500")


@query("ui_filter_options")
def _(spark, sf_dir):
    return catalog.filter_options(shop_catalogue(spark, sf_dir))


@query("ui_page")
def _(spark, sf_dir):
    return catalog.stored_page(spark, catalogue_pages(spark, sf_dir), 3)


@query("ui_top5")
def _(spark, sf_dir):
    return catalog.top_by(shop_catalogue(spark, sf_dir), "purchase")


@query("ui_match_score")
def _(spark, sf_dir):
    return catalog.with_match_score(shop_catalogue(spark, sf_dir)).select("product_id", "match_score")


@query("ui_display_columns")
def _(spark, sf_dir):
    return catalog.with_display_text(shop_catalogue(spark, sf_dir))


@query("ui_suggest")
def _(spark, sf_dir):
    return search.suggest(searchable_catalogue(spark, sf_dir), "Brand#2")


@query("ui_live_top")
def _(spark, sf_dir):
    """Lists built by a stream over the silver files, some files per refresh."""
    stream = records.file_stream(spark, silver_folder(spark, sf_dir), silver(spark, sf_dir).schema, PACE)
    path, checkpoint = scratch.scratch_path(spark, "live"), scratch.scratch_path(spark, "checkpoint")
    _finish(live.write_live_rankings(stream, path, checkpoint))
    return _rounded(live.current_lists(spark, path))
