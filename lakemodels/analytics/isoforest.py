"""Isolation forest (Liu, Ting and Zhou 2008) as Spark jobs.

Every tree learns from its own sample of at most ``sample_size`` rows, chosen
by a hash of the row's id, so the training data stays bounded whatever the
table holds. Trees are grown in parallel, one small group each; all rows are
then scored in Arrow batches against the broadcast node table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Iterator, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemodels.operators.quantile import exact_quantile
from lakemodels.operators.relational import col
from lakemodels.operators.windows import top_per_group
from lakemodels.sources.workspace import fresh_dir, ship_package

_NODES = "tree int, node int, feature int, threshold double, depth double"
_UNIT = float(2**53)


def isolation_forest(
    df: DataFrame,
    id_column: str,
    features: Sequence[str],
    trees: int = 100,
    contamination: float = 0.005,
    sample_size: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Add ``anomaly_score`` (negative is anomalous) and ``is_anomaly``.

    The score is the paper's ``-2 ** (-E[h] / c)`` minus its contamination
    quantile, so the lowest ``contamination`` share of rows is flagged. Rows
    must have a unique id; a null feature counts as 0.
    """
    nodes = grow_forest(df, id_column, features, trees, sample_size, seed)
    raw = score_forest(df, features, nodes, trees, min(sample_size, _bounded_count(df, sample_size)))
    # Stored once: the quantile reads the scores several times.
    path = fresh_dir(df.sparkSession, "scores")
    raw.write.parquet(path)
    raw = df.sparkSession.read.parquet(path)
    offset = exact_quantile(raw, F.col("anomaly_score"), contamination)
    if offset is None:
        return raw.withColumn("is_anomaly", F.lit(None).cast("boolean"))
    return raw.withColumn("anomaly_score", F.col("anomaly_score") - F.lit(offset)).withColumn(
        "is_anomaly", F.col("anomaly_score") < 0
    )


def tree_samples(df: DataFrame, id_column: str, trees: int, sample_size: int, seed: int) -> DataFrame:
    """``sample_size`` rows per tree, without replacement, the same on every run.

    Each row draws a hash number per tree. A first cut keeps slightly more than
    is needed (six deviations above the wanted mean), the rank the exact number.
    """
    n = df.count()
    share = 1.0 if n <= 2 * sample_size else min(1.0, (sample_size + 6 * math.sqrt(sample_size) + 16) / n)

    def draw(tree: Column) -> Column:
        return _uniform(col(id_column), tree, F.lit(seed + 2))

    # A row draws for every tree; only the trees that it is in become rows.
    mine = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: draw(tree) < share)
    chosen = df.withColumn("tree", F.explode(mine)).withColumn("draw", draw(F.col("tree")))
    return top_per_group(chosen, ["tree"], [F.col("draw"), col(id_column)], sample_size).drop("draw", "rank")


def grow_forest(
    df: DataFrame, id_column: str, features: Sequence[str], trees: int = 100, sample_size: int = 256, seed: int = 42
) -> DataFrame:
    """Node rows of all trees: inner nodes carry feature and threshold, leaves their path length.

    The children of node i are 2i + 1 and 2i + 2.
    """
    ship_package(df.sparkSession)
    names = list(features)
    slim = df.select(
        col(id_column), *[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(names)]
    )
    samples = tree_samples(slim, id_column, trees, sample_size, seed)
    columns = [f"f{i}" for i in range(len(names))]

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rows = pdf[columns].to_numpy()
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(rows), 2)))
        nodes, open_nodes = [], [(0, 0, rows)]
        while open_nodes:
            node, depth, part = open_nodes.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            splittable = np.flatnonzero(low < high)
            if depth >= limit or len(part) <= 1 or len(splittable) == 0:
                nodes.append((tree, node, -1, 0.0, depth + average_path(len(part))))
                continue
            feature = int(rng.choice(splittable))
            threshold = float(rng.uniform(low[feature], high[feature]))
            goes_left = part[:, feature] <= threshold
            nodes.append((tree, node, feature, threshold, 0.0))
            open_nodes.append((2 * node + 1, depth + 1, part[goes_left]))
            open_nodes.append((2 * node + 2, depth + 1, part[~goes_left]))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "depth"])

    return samples.groupBy("tree").applyInPandas(grow, _NODES)


def score_forest(df: DataFrame, features: Sequence[str], nodes: DataFrame, trees: int, sample_size: int) -> DataFrame:
    """Add ``anomaly_score`` in [-1, 0): the shorter the paths, the lower.

    The node table has at most trees x 2 x sample_size rows and is broadcast.
    """
    names = list(features)
    table = nodes.toPandas()
    width = int(table["node"].max()) + 1 if len(table) else 1
    feature = np.full((trees, width), -1, dtype=np.int16)
    threshold = np.zeros((trees, width))
    depth = np.zeros((trees, width))
    at = (table["tree"].to_numpy(), table["node"].to_numpy())
    feature[at], threshold[at], depth[at] = table["feature"], table["threshold"], table["depth"]
    forest = df.sparkSession.sparkContext.broadcast((feature, threshold, depth))
    scale = average_path(sample_size) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[Tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        feature, threshold, depth = forest.value
        for batch in batches:
            x = np.column_stack([part.to_numpy() for part in batch])
            row = np.arange(len(x))
            total = np.zeros(len(x))
            for tree in range(trees):
                node = np.zeros(len(x), dtype=np.int64)
                while True:
                    split = feature[tree, node]
                    inner = split >= 0
                    if not inner.any():
                        break
                    right = x[row, np.maximum(split, 0)] > threshold[tree, node]
                    node = np.where(inner, 2 * node + 1 + right, node)
                total += depth[tree, node]
            yield pd.Series(-np.exp2(-total / trees / scale))

    filled = [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in names]
    return df.withColumn("anomaly_score", score(*filled))


def average_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash: the same for the same row on every run."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(_UNIT)


def _bounded_count(df: DataFrame, most: int) -> int:
    return df.limit(most).count()
