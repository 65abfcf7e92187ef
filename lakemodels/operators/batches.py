"""Batch transforms: a Python function over bounded batches of rows, in parallel on all partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakemodels.sources.workspace import ship_package

BACKENDS = ("pandas", "arrow")


def map_batches(
    df: DataFrame,
    fn: Callable,
    schema: str | T.StructType,
    batch_size: int = 100_000,
    backend: str = "pandas",
) -> DataFrame:
    """Apply ``fn`` to batches of at most ``batch_size`` rows; its results form one frame.

    ``fn`` takes and returns a pandas frame, or with the ``arrow`` backend a
    ``pyarrow.Table`` (which polars and others read without a copy). The
    declared schema fixes the output columns: a result is lined up by name, and
    one with other columns fails the job.

    Memory is bounded by the batch. Batches follow Spark's partitions: ``fn``
    must not depend on their boundaries or order.
    """
    if backend not in BACKENDS:
        raise ValueError(f"Unknown backend {backend!r}; expected one of {BACKENDS}")
    if isinstance(batch_size, bool) or not isinstance(batch_size, int) or batch_size <= 0:
        raise ValueError(f"batch_size must be a positive integer, got {batch_size!r}")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    ship_package(df.sparkSession)

    if backend == "pandas":

        def over_pandas(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in _regroup(frames, batch_size, len, lambda f, a, n: f.iloc[a : a + n], _concat_pandas):
                yield _lined_up(fn(batch), names)

        return df.mapInPandas(over_pandas, schema)

    def over_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = (pa.Table.from_batches([b]) for b in batches)
        for batch in _regroup(tables, batch_size, len, lambda t, a, n: t.slice(a, n), pa.concat_tables):
            result = fn(batch)
            _check_names(result.column_names, names)
            yield from result.select(names).to_batches()

    return df.mapInArrow(over_arrow, schema)


def _regroup(pieces, size: int, length, cut, concat):
    """Cut and join incoming pieces to ``size`` rows; the last one of a partition may be short."""
    held, count = [], 0
    for piece in pieces:
        start = 0
        while start < length(piece):
            take = min(size - count, length(piece) - start)
            held.append(cut(piece, start, take))
            start, count = start + take, count + take
            if count == size:
                yield concat(held)
                held, count = [], 0
    if held:
        yield concat(held)


def _concat_pandas(frames: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(frames, ignore_index=True)


def _lined_up(frame: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    _check_names(list(frame.columns), names)
    return frame[names]


def _check_names(found: list[str], wanted: list[str]) -> None:
    if sorted(map(str, found)) != sorted(wanted):
        missing = sorted(set(wanted) - set(found))
        new = sorted(set(map(str, found)) - set(wanted))
        raise ValueError(f"Batch columns differ from the declared schema; missing {missing}, new {new}")
