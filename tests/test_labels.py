"""Label positions against MLlib's indexer, which keeps its labels on the driver."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from cartwright.operators import clustering
from cartwright.operators.labels import LabelPositions

VALUES = ["b"] * 40 + ["a", "a", "c", "c", "", "é", "E", None, None, "long" * 500]


@pytest.fixture(scope="module")
def table(spark):
    data = [(n, value, VALUES[-n]) for n, value in enumerate(VALUES)]
    return spark.createDataFrame(data, "n INT, brand STRING, label STRING").withColumn("position", F.lit("x")).repartition(3)


def _positions(frame, column="out"):
    return sorted((row["n"], row["brand"], row["label"], row["position"], row[column]) for row in frame.fillna("-").collect())


def test_positions_equal_the_indexer(spark, table):
    expected = StringIndexer(inputCol="brand", outputCol="out", handleInvalid="keep").fit(table)
    found = LabelPositions("brand", "out").fit(table)
    assert found.transform(table).columns == [*table.columns, "out"]
    assert _positions(found.transform(table)) == _positions(expected.transform(table))
    unseen = spark.createDataFrame([(1, "new", "b"), (2, None, "a"), (3, "b", None)], "n INT, brand STRING, label STRING")
    unseen = unseen.withColumn("position", F.lit(None).cast("string"))
    assert _positions(found.transform(unseen)) == _positions(expected.transform(unseen))


def test_empty_table_and_existing_column(spark, table):
    empty = LabelPositions("brand", "out").fit(table.limit(0))
    assert {row["out"] for row in empty.transform(table).collect()} == {0.0}
    assert empty.transform(table.limit(0)).count() == 0
    with pytest.raises(ValueError, match="position"):
        LabelPositions("brand", "position").fit(table).transform(table)


def test_saved_with_the_pipeline_as_a_table(spark, table, tmp_path):
    model = Pipeline(stages=[LabelPositions("brand", "out"), LabelPositions("label", "other")]).fit(table)
    for _ in range(2):
        model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert _positions(loaded.transform(table)) == _positions(model.transform(table))
    assert _positions(loaded.transform(table), "other") == _positions(model.transform(table), "other")
    assert [stage.uid for stage in loaded.stages] == [stage.uid for stage in model.stages]
    stored = spark.read.parquet(str(tmp_path / "model" / "stages" / f"0_{model.stages[0].uid}" / "data"))
    assert stored.count() == 7 and stored.columns == ["label", "position"]


def test_no_stage_of_the_clustering_holds_labels(spark):
    assert not any(isinstance(stage, StringIndexer) for stage in clustering.indexers())
