"""Content features and k-means clusters of products."""

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from cartwright import schema
from cartwright.functions import metrics
from cartwright.operators import statistics
from cartwright.operators.labels import LabelPositions

FEATURE_COLUMNS = (
    *schema.PRODUCT_KEYS, "avg_price", "interaction_count", "view_count", "cart_count", "purchase_count",
    "unique_users", "popularity_score", "engagement_rate",
)


def product_features(events, base=None):
    """Content features straight from events, or from their activity."""
    return features_from_statistics(statistics.product_statistics(events, base=base))


def features_from_statistics(stats):
    """The same features as a projection of product statistics, without another pass over the events."""
    counted = stats.withColumnRenamed("total_events", "interaction_count")
    return counted.withColumn("engagement_rate", metrics.engagement_rate()).select(*FEATURE_COLUMNS)


def indexers():
    """Positions of brand and category by falling frequency; null and a value unseen in fitting get one extra position."""
    return [LabelPositions("brand", "brand_index"), LabelPositions("category_code", "category_index")]


def assembler():
    return VectorAssembler(inputCols=list(schema.CLUSTER_FEATURES), outputCol="features")


def scaler():
    """Divides each feature by its sample standard deviation, without centring."""
    return StandardScaler(inputCol="features", outputCol="scaled_features", withStd=True, withMean=False)


def kmeans(clusters=schema.CLUSTER_COUNT, seed=42):
    return KMeans(featuresCol="scaled_features", predictionCol="cluster", k=clusters, seed=seed)


def fit_clusters(features, clusters=schema.CLUSTER_COUNT, seed=42):
    """(model, products with their cluster). The fit passes over `features` many times: hand in a written table.

    MLlib returns fewer centres where there are fewer points, but fails on a handful of them; so k follows the points when
    the catalogue has fewer rows than clusters, which a look at that many rows tells.
    """
    first = features.limit(clusters).select("avg_price", "popularity_score", "engagement_rate", "brand", "category_code").collect()
    if len(first) < clusters:
        clusters = max(2, len(set(first)))
    model = Pipeline(stages=[*indexers(), assembler(), scaler(), kmeans(clusters, seed)]).fit(features)
    return model, model.transform(features)


def cluster_sizes(clustered, cluster="cluster"):
    return clustered.groupBy(cluster).agg(F.count("*").alias("count")).orderBy(cluster)
