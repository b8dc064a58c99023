"""The daily job: records to bronze, silver, gold and recommendations, each layer read back from its written table."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from cartwright import schema
from cartwright.operators import clustering, factorization, indexing, ingest, ranking, ratings, similarity, statistics
from cartwright.sources import files, records, scratch, sinks
from cartwright.streaming import ingest as stream_ingest


def publish(spark, csv_path, folder, as_of=None):
    """Cleans a CSV of raw events and publishes its rows as message records. Returns the rows read and kept.

    Both counts are taken while publishing, without another pass over the file.
    """
    before, after = Observation("read"), Observation("kept")
    raw = files.event_csv(spark, csv_path).observe(before, F.count(F.lit(1)).alias("rows"))
    kept = ingest.clean_raw(raw).observe(after, F.count(F.lit(1)).alias("rows"))
    records.publish_to_files(records.event_records(kept, as_of), folder)
    return {"initial_rows": before.get.get("rows", 0), "final_rows": after.get.get("rows", 0)}


def build_silver(message_stream, base, as_of=None):
    """Takes in what the stream holds now: raw text to bronze, then clean events to silver."""
    spark = message_stream.sparkSession
    checkpoints = f"{base}/checkpoints"
    stream_ingest.write_bronze(message_stream, f"{base}/bronze", f"{checkpoints}/bronze").awaitTermination()
    bronze = records.file_stream(spark, f"{base}/bronze", columns=schema.BRONZE)
    stream_ingest.write_silver(bronze, f"{base}/silver", f"{checkpoints}/silver", as_of=as_of).awaitTermination()
    return f"{base}/silver"


def build_gold(events, gold, as_of=None, base=None):
    """Writes the five gold tables and returns their numbers of rows. Later tables start from written ones."""
    spark = events.sparkSession
    base = statistics.written_activity(events) if base is None else base
    rows = {}

    def write(name, table, cluster_by=None):
        rows[name] = sinks.gold_table(table, gold, name, cluster_by)

    parts = scratch.materialize(statistics.product_parts(base), "product_parts")
    write("product_statistics", statistics.product_statistics(events, as_of, parts=parts), ["product_id"])
    stats = files.parquet_table(spark, f"{gold}/product_statistics")
    write("category_statistics", statistics.category_statistics(events, as_of, parts=parts))
    write("brand_statistics", statistics.brand_statistics(events, as_of, parts=parts))
    write("product_rankings", ranking.product_rankings(stats, as_of))
    write("recommendation_features", ranking.recommendation_features(stats, as_of))
    return rows


def build_recommendations(events, gold, clusters=schema.CLUSTER_COUNT, base=None, blocks=None):
    """Fits and saves both models, writes both recommendation tables, and returns row counts, the held-out error and the hit rate.

    `blocks` is the number of rating blocks of the factor fit, one per core without it; one block must fit in a task.
    """
    spark = events.sparkSession
    rated = scratch.materialize(ratings.user_product_ratings(events, base), "ratings")
    users, products = ratings.index_tables(rated)
    indexed = scratch.materialize(ratings.indexed_ratings(rated, users, products), "indexed")
    train, test = ratings.split_ratings(indexed)
    factors = factorization.fit_factors(train, blocks=blocks)
    error = factorization.rmse(factorization.score_pairs(factors, test)).first()["rmse"]
    stats = files.parquet_table(spark, f"{gold}/product_statistics")
    cluster_model, clustered = clustering.fit_clusters(clustering.features_from_statistics(stats), clusters)
    plain = scratch.materialize(clustered.select(*schema.PRODUCT_KEYS, "popularity_score", "cluster"), "clustered")
    sinks.models(factors, cluster_model, gold)
    # Written before the sorted table is, whose range sampling would otherwise score all users twice.
    picked = scratch.materialize(factorization.user_recommendations(factors, users, products), "recommendations")
    rows = sinks.recommendation_tables(picked, similarity.similar_products(plain), gold)
    held_out = indexing.replace_ids(test.select("user", "item"), users, products)
    return {**rows, "rmse": error, "hit_rate": factorization.hit_rate(picked, held_out).first()["hit_rate"]}


def run(message_stream, base, as_of=None, since=None, until=None, clusters=schema.CLUSTER_COUNT, blocks=None):
    """All layers below `base`; `since` and `until` limit gold and recommendations to a range of processing dates.

    Silver is read once: its activity is written and everything after starts from it. Intermediate tables of the run are
    removed when it has written its last table.
    """
    spark = message_stream.sparkSession
    with scratch.run_folder(spark):
        silver_path = build_silver(message_stream, base, as_of)
        events = files.silver(spark, silver_path, since, until)
        gold = f"{base}/gold"
        activity = statistics.written_activity(events)
        report = build_gold(events, gold, as_of, activity)
        report.update(build_recommendations(events, gold, clusters, activity, blocks))
    return report
