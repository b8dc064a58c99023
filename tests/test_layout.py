"""The same rows come out however the input is spread over partitions."""

import pytest
from pyspark.sql import functions as F

from cartwright.operators import clustering, indexing, ranking, ratings, similarity, statistics
from cartwright.plans import fixtures, registry
from conftest import SMALL


def gold(function):
    return lambda events: function(statistics.product_statistics(events))


OPERATORS = {
    "product": statistics.product_statistics,
    "category": statistics.category_statistics,
    "brand": statistics.brand_statistics,
    "ratings from activity": lambda events: ratings.user_product_ratings(events, statistics.activity(events)),
    "ratings": ratings.user_product_ratings,
    "features": clustering.product_features,
    "rankings": gold(ranking.product_rankings),
    "recommendation features": gold(ranking.recommendation_features),
    "similar": gold(lambda stats: similarity.similar_products(stats.withColumn("cluster", F.col("category_id")))),
    "users": lambda events: indexing.label_index(events, "user_id", "user_index"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_layout_does_not_matter(spark, name):
    events = registry.silver(spark, SMALL)
    results = [
        sorted(map(str, OPERATORS[name](layout).drop("created_timestamp").collect()))
        for layout in (events.coalesce(1), events.repartition(16), events.orderBy(F.desc("price")))
    ]
    assert results[0] == results[1] == results[2] and results[0]


def test_hot_keys(spark):
    """A third of all events on one product, user and session changes nothing but the counts."""
    events = fixtures.commerce_events(spark, SMALL)
    size = events.count()
    one = events.limit(1)
    hot = events.unionByName(one.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(size // 2)))).drop("n"))
    key = one.first()
    before = {r.product_id: r for r in statistics.product_statistics(events).collect()}
    after = {r.product_id: r for r in statistics.product_statistics(hot).collect()}
    assert before.keys() == after.keys()
    old, new = before[key.product_id], after[key.product_id]
    assert new.total_events == old.total_events + size // 2
    assert (new.unique_users, new.unique_sessions) == (old.unique_users, old.unique_sessions)
