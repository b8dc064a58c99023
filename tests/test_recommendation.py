import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from cartwright.operators import clustering, factorization, indexing, ratings, scoring
from cartwright.plans import registry
from cartwright.sources import files, sinks
from conftest import SMALL


def test_ratings_weigh_events_and_add_the_log(spark):
    rows = [("u", "p", "view"), ("u", "p", "cart"), ("u", "p", "purchase"), ("u", "q", "other")]
    table = spark.createDataFrame(rows, "user_id STRING, product_id STRING, event_type STRING")
    found = {row.product_id: row for row in ratings.user_product_ratings(table).collect()}
    assert (found["p"].total_rating, found["p"].interaction_count) == (14.0, 3)
    assert found["p"].final_rating == pytest.approx(14 + math.log(4))
    assert found["q"].final_rating == pytest.approx(math.log(2))


@pytest.mark.parametrize("parts", [1, 7])
def test_label_index_orders_by_frequency_then_label(spark, parts):
    rows = [("b",)] * 3 + [("a",)] * 3 + [("z",)] * 5 + [(f"r{i:03d}",) for i in range(200)]
    table = spark.createDataFrame(rows, "user_id STRING").repartition(parts)
    found = {row.user_id: row.user_index for row in indexing.label_index(table, "user_id", "user_index").collect()}
    assert found == {label: i for i, label in enumerate(["z", "a", "b"] + [f"r{i:03d}" for i in range(200)])}


def test_split_does_not_depend_on_layout(spark):
    pairs = spark.range(3000).select(
        (F.col("id") % 60).cast("int").alias("user"), (F.col("id") / 60).cast("int").alias("item"), F.lit(1.0).alias("rating")
    )
    sides = []
    for parts in (1, 5):
        train, test = ratings.split_ratings(pairs.repartition(parts))
        assert train.count() + test.count() == 3000
        sides.append(sorted(map(tuple, train.collect())))
    assert sides[0] == sides[1] and 0.75 < len(sides[0]) / 3000 < 0.85


def test_rmse(spark):
    scored = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "rating DOUBLE, prediction DOUBLE")
    assert factorization.rmse(scored).first().rmse == pytest.approx(math.sqrt(2.5))


def test_hit_rate_counts_users(spark):
    shape = "user_id STRING, product_id STRING"
    listed = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("d", "9")], shape)
    held_out = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "7"), ("c", "1"), ("c", "1")], shape)
    assert factorization.hit_rate(listed, held_out).first().hit_rate == pytest.approx(1 / 3)
    assert factorization.hit_rate(listed, held_out.limit(0)).first().hit_rate is None


def test_recommendations_carry_original_ids(spark):
    model = registry.als_model(spark, SMALL)
    users, products = registry.indexes(spark, SMALL)
    flat = factorization.user_recommendations(model, users, products)
    known_users, known_products = users.select("user_id"), products.select("product_id")
    assert flat.join(known_users, "user_id", "left_anti").count() == 0
    assert flat.join(known_products, "product_id", "left_anti").count() == 0
    per_user = flat.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("product_id").alias("d"))
    assert per_user.filter("n > 10 OR n <> d").count() == 0
    lists = flat.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("s")).collect()
    for row in lists:
        scores = [entry.score for entry in row.s]
        assert scores == sorted(scores, reverse=True)


def lists(table):
    return {row.user: [(pick.item, round(pick.rating, 5)) for pick in row.recommendations] for row in table.collect()}


@pytest.mark.parametrize("size", [1, 10, 5000])
def test_lists_hold_the_best_items_in_order(spark, size):
    model = registry.als_model(spark, SMALL)
    users = {row.id: np.array(row.features) for row in model.userFactors.collect()}
    items = sorted((row.id, row.features) for row in model.itemFactors.collect())
    matrix = np.array([features for _, features in items])
    for user, picks in lists(scoring.best_items(model, size)).items():
        wanted = np.sort(matrix @ users[user])[::-1][:size]
        assert [score for _, score in picks] == pytest.approx(wanted.tolist(), abs=2e-5)
        assert len({item for item, _ in picks}) == len(picks) == min(size, len(items))


class Factors:
    def __init__(self, spark, users, items):
        shape = "id INT, features ARRAY<FLOAT>"
        self.userFactors, self.itemFactors = spark.createDataFrame(users, shape), spark.createDataFrame(items, shape)


def test_equal_ratings_go_by_item(spark):
    model = Factors(spark, [(1, [1.0, 0.0])], [(5, [1.0, 9.0]), (9, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 5.0]), (4, [0.5, 0.5])])
    assert lists(scoring.best_items(model, 4)) == {1: [(3, 2.0), (9, 2.0), (2, 1.0), (5, 1.0)]}
    assert scoring.best_items(Factors(spark, [(1, [1.0])], []), 4).count() == 0


@pytest.mark.parametrize("skew", [0.0, 2.0])
def test_waves_and_blocks_find_the_best_items(spark, monkeypatch, skew):
    """Small blocks and waves, items of like or of very unlike length, ties included; users leave in different waves."""
    for name, value in (("USER_BLOCK", 40), ("ITEM_BLOCK", 16), ("FIRST_WAVE", 20), ("GROWTH", 2), ("ROWS", 7), ("COLUMNS", 5)):
        monkeypatch.setattr(scoring, name, value)
    chance = np.random.default_rng(3)
    users = chance.integers(-4, 5, (100, 4)) / 4
    items = chance.integers(-4, 5, (300, 4)) / 4 * np.exp2(np.floor(-skew * np.log2(np.arange(1, 301))))[:, None]
    model = Factors(spark, [(i, row.tolist()) for i, row in enumerate(users)], [(i * 3, row.tolist()) for i, row in enumerate(items)])
    found = lists(scoring.best_items(model, 5))
    scores = (users @ items.T).astype(np.float32)
    for user in range(100):
        order = np.lexsort((np.arange(300), -scores[user]))[:5]
        assert found[user] == [(int(i) * 3, round(float(scores[user, i]), 5)) for i in order]


def test_held_out_pairs_of_unknown_users_are_not_scored(spark):
    model = registry.als_model(spark, SMALL)
    pairs = spark.createDataFrame([(0, 0, 1.0), (10**6, 0, 1.0)], "user INT, item INT, rating FLOAT")
    assert factorization.score_pairs(model, pairs).count() == 1


def test_models_and_parts_round_trip(spark, tmp_path):
    clusters, clustered = registry.product_clusters(spark, SMALL)
    sinks.models(registry.als_model(spark, SMALL), clusters, str(tmp_path))
    loaded = PipelineModel.load(str(tmp_path / "models" / "clustering_model"))
    table = clustering.features_from_statistics(registry.product_stats(spark, SMALL))
    before = sorted((row.product_id, row.cluster) for row in clustered.collect())
    assert sorted((row.product_id, row.cluster) for row in loaded.transform(table).collect()) == before
    assert ALSModel.load(str(tmp_path / "models" / "als_model")).rank == 10
    parts = files.model_parts(spark, str(tmp_path / "models" / "clustering_model"))
    assert {row.source for row in parts.select("source").distinct().collect()} == {"stages"}
    assert "clusterCenter" in parts.columns


def test_every_product_gets_one_cluster(spark):
    _, clustered = registry.product_clusters(spark, SMALL)
    sizes = clustering.cluster_sizes(clustered).collect()
    assert sum(row["count"] for row in sizes) == registry.product_stats(spark, SMALL).count()
    assert [row.cluster for row in sizes] == sorted(row.cluster for row in sizes)


def test_fewer_products_than_clusters(spark):
    stats = clustering.features_from_statistics(registry.product_stats(spark, SMALL))
    for size in (3, 19):
        table = spark.createDataFrame(stats.limit(size).collect(), stats.schema)
        _, clustered = clustering.fit_clusters(table)
        assert clustered.count() == size


def test_check_of_recommendations_keeps_only_each_chunks_best_scores(spark, monkeypatch):
    monkeypatch.setattr(registry, "CHECK_USERS", 3)
    monkeypatch.setattr(registry, "CHECK_ITEMS", 7)
    chance = np.random.default_rng(3)
    left, right = chance.normal(size=(11, 4)), chance.normal(size=(40, 4))
    users = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(left)], "user INT, left ARRAY<FLOAT>")
    items = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(right)], "item INT, right ARRAY<FLOAT>")
    user_chunks = registry._chunks(users, "user", "left", registry.CHECK_USERS)
    item_chunks = registry._chunks(items, "item", "right", registry.CHECK_ITEMS)
    scored = registry._chunk_tops(user_chunks, item_chunks, 10).collect()
    assert len(scored) <= 11 * item_chunks.count() * 10
    found = {}
    for row in scored:
        found.setdefault(row.user, []).append(row.top)
    exact = left.astype(np.float32).astype(np.float64) @ right.astype(np.float32).astype(np.float64).T
    for user in range(11):
        assert sorted(found[user], reverse=True)[:10] == pytest.approx(sorted(exact[user], reverse=True)[:10])
