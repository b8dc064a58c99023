"""Times the headline queries warm and prints one JSON line.

Each query is run once to warm up and then REPEATS times into a sink that discards rows; the median counts. Tables that
earlier jobs would have written (silver, product statistics, ratings, models) are built before the clock starts, and the
fits are timed as fits. `naive` holds one run each of the plain forms of the two redesigned operators, for comparison; they
are not part of the total.
"""

import json
import os
import statistics as stats_of
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cartwright.operators import clustering, factorization, ingest, ratings  # noqa: E402
from cartwright.plans import registry  # noqa: E402
from cartwright.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = (
    "gold_product_statistics", "gold_category_statistics", "gold_brand_statistics", "gold_product_rankings",
    "gold_recommendation_features", "win_percent_rank", "reco_ratings", "reco_product_features", "ml_index_ids",
    "join_index_lookup", "reco_similar_products", "ml_recommend_all", "ml_generate_recommendations", "q_search_products",
    "q_product_details", "q_dashboard", "ui_browse_filter", "ui_page", "ui_filter_options", "snk_silver_stream",
    "ui_live_top",
)


def discard(df):
    df.write.format("noop").mode("overwrite").save()


def seconds(run):
    run()
    taken = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(stats_of.median(taken), 3)


def once(run):
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def naive_percent_rank(stats):
    order = Window.orderBy("popularity_score")
    return stats.select("product_id", F.percent_rank().over(order).alias("popularity_percentile"))


def naive_similar(products):
    left = products.select("product_id", "cluster", "popularity_score")
    right = left.select(F.col("product_id").alias("similar_product_id"), "cluster", F.col("popularity_score").alias("other"))
    pairs = left.join(right, "cluster").filter("product_id <> similar_product_id")
    pairs = pairs.withColumn("score_diff", F.abs(F.col("popularity_score") - F.col("other")))
    order = Window.partitionBy("product_id").orderBy("score_diff", "similar_product_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter("rank <= 10")


def main():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    records = registry.bronze_records(spark, SF_DIR)
    train, _ = ratings.split_ratings(registry.indexed(spark, SF_DIR))
    features = clustering.features_from_statistics(registry.product_stats(spark, SF_DIR))
    registry.similar(spark, SF_DIR)

    runs = {
        "ing_silver": lambda: discard(ingest.silver_events(records, registry.AS_OF)),
        "ml_als_fit": lambda: factorization.fit_factors(train),
        "ml_cluster_products": lambda: discard(clustering.fit_clusters(features)[1]),
    }
    for name in HEADLINE:
        runs[name] = lambda name=name: discard(registry.QUERIES[name](spark, SF_DIR))
    timed = {name: seconds(run) for name, run in runs.items()}

    naive = {
        "win_percent_rank": once(lambda: discard(naive_percent_rank(registry.product_stats(spark, SF_DIR)))),
        "reco_similar_products": once(lambda: discard(naive_similar(registry.stand_in_clusters(spark, SF_DIR)))),
    }
    print(
        json.dumps(
            {
                "metric": "sum of warm median seconds over headline queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "naive": naive,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
