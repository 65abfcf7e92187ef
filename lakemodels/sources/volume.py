"""Row count, byte size, and the opt-in volume gate."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemodels.sources.scan import file_sizes, reads_files


@dataclass(frozen=True)
class VolumeLimits:
    """Thresholds of the gate. None switches a threshold off; all are off by default."""

    max_rows: int | None = None
    warn_rows: int | None = None
    max_bytes: int | None = None
    warn_bytes: int | None = None
    batch_size: int = 100_000
    allow_large_tables: bool = False
    chunked_mode: bool = False

    def __post_init__(self):
        for name in ("max_rows", "warn_rows", "max_bytes", "warn_bytes", "batch_size"):
            value = getattr(self, name)
            if value is not None and (isinstance(value, bool) or not isinstance(value, int) or value < 0):
                raise ValueError(f"{name} must be an integer >= 0, got {value!r}")


# The conservative limits of a single-machine run, for users who want them.
LOCAL_LIMITS = VolumeLimits(
    max_rows=1_000_000,
    warn_rows=200_000,
    max_bytes=512 * 1024 * 1024,
    warn_bytes=128 * 1024 * 1024,
)


def row_count(df: DataFrame) -> DataFrame:
    """One row ``n_rows``; filters and projections before it are pushed to the scan."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def relation_bytes(df: DataFrame) -> DataFrame:
    """One row ``n_bytes``: total size of the files of a scan; null for an empty or a derived relation."""
    if not reads_files(df):
        return df.sparkSession.sql("SELECT CAST(NULL AS BIGINT) AS n_bytes")
    return file_sizes(df).agg(F.sum("file_size").alias("n_bytes"))


def volume_check(df: DataFrame, limits: VolumeLimits, for_batches: bool = False, with_bytes: bool = True) -> DataFrame:
    """One row: n_rows, n_bytes and a status of ok, warn or fail.

    Limits are strict. ``allow_large_tables`` turns a fail into a warning, and so
    does ``chunked_mode`` for reads in batches only. The size of a join, an
    aggregate or a range is unknown: ``n_bytes`` is null, and rows alone decide.
    """
    if with_bytes and reads_files(df):
        totals = file_sizes(df).agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.sum("file_size").alias("n_bytes")
        )
    else:
        totals = row_count(df).withColumn("n_bytes", F.lit(None).cast("bigint"))

    too_many = _above("n_rows", limits.max_rows) | _above("n_bytes", limits.max_bytes)
    many = _above("n_rows", limits.warn_rows) | _above("n_bytes", limits.warn_bytes)
    excused = limits.allow_large_tables or (limits.chunked_mode and for_batches)
    status = (
        F.when(too_many, F.lit("warn" if excused else "fail")).when(many, F.lit("warn")).otherwise(F.lit("ok"))
    )
    return totals.withColumn("status", status)


def enforce_volume(df: DataFrame, limits: VolumeLimits, for_batches: bool = False) -> DataFrame:
    """Run the check, raise on fail, warn on warn, and hand the frame back."""
    check = volume_check(df, limits, for_batches).first()
    message = f"{check.n_rows} rows, {check.n_bytes} bytes against {limits}"
    if check.status == "fail":
        raise RuntimeError(f"Relation is over its limits: {message}")
    if check.status == "warn":
        warnings.warn(f"Large relation: {message}", stacklevel=2)
    return df


def _above(column: str, limit: int | None) -> Column:
    if limit is None:
        return F.lit(False)
    return F.coalesce(F.col(column) > F.lit(limit), F.lit(False))
