"""User-product ratings for collaborative filtering."""

from pyspark.sql import functions as F

from cartwright.functions import metrics
from cartwright.operators.indexing import label_index


def user_product_ratings(events, base=None):
    """Summed event weights per user and product, plus the logarithm of one more than the number of interactions.

    `base` is the activity of the events (statistics.activity) where it is at hand.
    """
    weight, rows = (F.sum(metrics.event_weight()), F.count("*")) if base is None else (F.sum("weight"), F.sum("total_events"))
    grouped = (events if base is None else base).groupBy("user_id", "product_id").agg(
        weight.cast("double").alias("total_rating"), rows.alias("interaction_count")
    )
    return grouped.withColumn("final_rating", F.col("total_rating") + F.log1p("interaction_count"))


def index_tables(ratings):
    """(users, products): the position of each label by its number of ratings."""
    return label_index(ratings, "user_id", "user_index"), label_index(ratings, "product_id", "product_index")


def indexed_ratings(ratings, user_index, product_index):
    """Ratings over integer user and item positions."""
    return (
        ratings.join(user_index, "user_id")
        .join(product_index, "product_id")
        .select(
            F.col("user_index").alias("user"),
            F.col("product_index").alias("item"),
            F.col("final_rating").cast("float").alias("rating"),
        )
    )


def split_ratings(indexed, train_share=0.8, seed=42):
    """(train, test) by a digest of the pair, so the same pair falls on the same side whatever the layout."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "user", "item"))
    draw = F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint")
    in_train = draw < F.lit(int(train_share * 16**7))
    return indexed.filter(in_train), indexed.filter(~in_train)
