"""k-means segmentation on standardized features."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import and_, itemgetter

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemodels.operators.relational import col
from lakemodels.sources.workspace import freeze

# Distinct rows per partition of the fit; fixed, as partitions decide about the starts.
_ROWS_PER_PART = 1_000_000


def kmeans_clusters(
    df: DataFrame, features: Sequence[str], k: int = 3, restarts: int = 10, seed: int = 42, max_iter: int = 20
) -> DataFrame:
    """Add ``cluster_id`` and ``centroid``, a struct of the cluster's means on the original scale.

    The best of ``restarts`` seeded runs counts. Clusters are numbered by their
    centroids in ascending order, so the numbers do not depend on the seed's
    order. Centroid members are rounded to two digits.
    """
    centroids = fit_centroids(df, features, k, restarts, seed, max_iter)
    assigned = assign_clusters(df, features, centroids["scaled"], centroids["mean"], centroids["deviation"])
    members = F.create_map(
        *[
            piece
            for i, center in enumerate(centroids["original"])
            for piece in (
                F.lit(i).cast("smallint"),
                F.struct(*[F.lit(round(value, 2)).alias(name) for name, value in zip(features, center)]),
            )
        ]
    )
    return assigned.withColumn("centroid", members[F.col("cluster_id")])


def fit_centroids(
    df: DataFrame, features: Sequence[str], k: int = 3, restarts: int = 10, seed: int = 42, max_iter: int = 20
) -> Mapping[str, list]:
    """Centroids of the best run: ``scaled`` and ``original`` (k lists each), with mean and deviation.

    Only k centers and two vectors of statistics reach the driver.
    """
    # Every run passes over the features many times. Equal rows count once, by weight; they lie in partitions and in an order that
    # follow from their values alone, so that the seeded starts do not depend on how the input was dealt.
    spark, names = df.sparkSession, [f"x{i}" for i in range(len(features))]
    rows = df.select(*[col(c).cast("double").alias(x) for c, x in zip(features, names)])
    valid = rows.where(reduce(and_, [F.col(x).isNotNull() & ~F.isnan(x) for x in names]))
    weighed = freeze(valid.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("weight")))
    parts = 1 + weighed.count() // _ROWS_PER_PART
    dealt = freeze(weighed.repartition(parts, F.xxhash64(*names)).sortWithinPartitions(*names))
    share = F.col("weight") / F.lit(dealt.agg(F.sum("weight")).first()[0])
    mean = list(dealt.agg(*[F.sum(share * F.col(x)) for x in names]).first())
    spread = [F.sum(F.col("weight") * (F.col(x) - F.lit(m)) ** 2) / (F.sum("weight") - 1) for x, m in zip(names, mean)]
    deviation = [math.sqrt(v or 0.0) or 1.0 for v in dealt.agg(*spread).first()]
    units = [((F.col(x) - F.lit(m)) / F.lit(d)).alias(x) for x, m, d in zip(names, mean, deviation)]
    scaled = VectorAssembler(inputCols=names, outputCol="features").transform(dealt.select(*units, "weight"))
    scaled = scaled.select("features", "weight").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Runs are independent: a few at a time keep the executors busy.
        def run(attempt: int):
            model = KMeans(k=k, seed=seed + attempt, maxIter=max_iter, weightCol="weight").fit(scaled)
            return model.summary.trainingCost, attempt, model

        with ThreadPool(min(8, restarts)) as pool:
            best = min(pool.map(inheritable_thread_target(spark)(run), range(restarts)), key=itemgetter(0, 1))[2]
    finally:
        scaled.unpersist()
    centers = sorted(
        ([float(v) * d + m for v, d, m in zip(center, deviation, mean)], [float(v) for v in center])
        for center in best.clusterCenters()
    )
    return {
        "original": [original for original, _ in centers],
        "scaled": [center for _, center in centers],
        "mean": mean,
        "deviation": deviation,
    }


def assign_clusters(
    df: DataFrame,
    features: Sequence[str],
    centroids: Sequence[Sequence[float]],
    mean: Sequence[float] | None = None,
    deviation: Sequence[float] | None = None,
) -> DataFrame:
    """Add ``cluster_id``: the nearest centroid, the first of equals; a native expression, no shuffle."""
    mean = mean or [0.0] * len(features)
    deviation = deviation or [1.0] * len(features)

    def scaled(i: int, name: str):
        return (col(name).cast("double") - F.lit(mean[i])) / F.lit(deviation[i] or 1.0)

    def distance(center: Sequence[float]):
        total = F.lit(0.0)
        for i, name in enumerate(features):
            gap = scaled(i, name) - F.lit(center[i])
            total = total + gap * gap
        return total

    nearest = F.least(*[distance(c) for c in centroids]) if len(centroids) > 1 else distance(centroids[0])
    label = F.lit(None).cast("smallint")
    for number, center in reversed(list(enumerate(centroids))):
        label = F.when(distance(center) == nearest, F.lit(number).cast("smallint")).otherwise(label)
    return df.withColumn("cluster_id", label)


def cluster_summary(df: DataFrame, features: Sequence[str], cluster: str = "cluster_id") -> DataFrame:
    """Rows and feature means per cluster."""
    return df.groupBy(col(cluster)).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.avg(col(c)).alias(f"avg_{c}") for c in features]
    )
