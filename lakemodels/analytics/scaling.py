"""Standardizing features with whole-table statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemodels.operators.relational import col


def standardize(df: DataFrame, features: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Add (x - mean) / population deviation per feature; a constant feature becomes 0.

    The statistics are one aggregated row, read through a scalar subquery.
    """
    stats = df.agg(
        F.struct(
            *[F.avg(col(c)).alias(f"mean_{i}") for i, c in enumerate(features)],
            *[F.stddev_pop(col(c)).alias(f"dev_{i}") for i, c in enumerate(features)],
        ).alias("stats")
    ).scalar()

    def scaled(i: int, name: str):
        centered, deviation = col(name) - stats[f"mean_{i}"], stats[f"dev_{i}"]
        return F.when(deviation == 0, F.when(col(name).isNotNull(), F.lit(0.0))).otherwise(centered / deviation)

    return df.withColumns({f"{c}{suffix}": scaled(i, c) for i, c in enumerate(features)})
