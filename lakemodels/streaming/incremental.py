"""A stream kept as an incremental table: each micro-batch is appended, merged or exchanged by key."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemodels.operators.merge import normalize_key
from lakemodels.operators.relational import col
from lakemodels.sinks.materialize import drop_partitions, partition_values, rewrite_partitions, table_properties, write_incremental
from lakemodels.sources.scan import relation_kind

# Finished partitions of appended batches are put together by so many, so many times over.
FAN_IN = 16
LEVELS = 3


def stream_incremental(
    stream: DataFrame,
    name: str,
    checkpoint: str,
    strategy: str = "default",
    unique_key=None,
    batch_column: str = "stream_batch",
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start a query that applies every micro-batch to table ``name``.

    A batch that Spark delivers again after a failure has no second effect:

    * merge and delete+insert store the batch's number with the published
      version and skip a number already stored;
    * append writes each batch into a partition of its own
      (``batch_column``), which a repeated delivery overwrites. Whenever
      ``FAN_IN`` of them are finished they become one partition, and so on for
      ``LEVELS`` levels, so that files follow from the rows and not from the
      number of batches; every row is written again at most ``LEVELS`` times.
      :func:`streamed_rows` reads such a table without the column.

    Partition a large target by columns of its key (``partition_by``): a batch
    then rewrites only the partitions it touches, else the whole table.

    ``options`` go to ``write_incremental``. The default trigger processes what
    is there and stops.
    """
    if strategy == "default":
        strategy = "merge" if normalize_key(unique_key) else "append"
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def apply(batch: DataFrame, batch_id: int) -> None:
        if strategy == "append":
            _append_batch(batch, name, batch_column, Span(run, 0, batch_id, batch_id), options)
            return
        mark = f"lakemodels.stream.{run}"
        if _applied(batch.sparkSession, name, mark) >= batch_id:
            return
        write_incremental(
            batch, name, strategy=strategy, unique_key=unique_key, properties={mark: str(batch_id)}, **options
        )

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


@dataclass(frozen=True, order=True)
class Span:
    """The batches that a partition holds: those from ``first`` to ``last`` of one query, put together ``level`` times."""

    run: str
    level: int
    first: int
    last: int

    @staticmethod
    def of(value: str) -> Span | None:
        found = re.fullmatch(r"([0-9a-f]+)-(\d+)-(\d+)-(\d+)", value)
        return Span(found[1], *map(int, found.groups()[1:])) if found else None

    def __str__(self) -> str:
        return f"{self.run}-{self.level}-{self.first}-{self.last}"

    def covers(self, other: Span) -> bool:
        return self.run == other.run and self.level > other.level and self.first <= other.first and other.last <= self.last


def streamed_rows(spark: SparkSession, name: str, batch_column: str = "stream_batch") -> DataFrame:
    """The rows that streams appended to a table, without the column of their batches.

    Partitions that were put together are passed over, also if they could not be removed yet: every row is read once.
    """
    rows = spark.table(name)
    if stale := _covered(_spans(spark, name, batch_column)):
        rows = rows.where(~col(batch_column).isin(sorted(map(str, stale))))
    return rows.drop(batch_column)


def _append_batch(batch: DataFrame, name: str, batch_column: str, span: Span, options: dict) -> None:
    spark = batch.sparkSession
    held = _spans(spark, name, batch_column)
    if any(other.covers(span) for other in held):
        return
    # Keyed by its own number, a batch replaces nothing but itself.
    write_incremental(
        batch.withColumn(batch_column, F.lit(str(span))),
        name,
        strategy="delete+insert",
        unique_key=batch_column,
        **{**options, "partition_by": [batch_column]},
    )
    _put_together(spark, name, batch_column, span.run)


def _put_together(spark: SparkSession, name: str, batch_column: str, run: str) -> None:
    """Copy full levels into one partition each, then drop what was copied.

    The copy is complete before anything goes. After a failure in between, readers pass over the copied
    partitions, and the next batch drops them.
    """
    for level in range(LEVELS):
        held = _spans(spark, name, batch_column)
        stale = {span for span in _covered(held) if span.run == run}
        drop_partitions(spark, name, batch_column, sorted(map(str, stale)))
        parts = sorted(span for span in held - stale if (span.run, span.level) == (run, level))
        if len(parts) < FAN_IN:
            continue
        whole = Span(run, level + 1, parts[0].first, parts[-1].last)
        rows = spark.table(name).where(col(batch_column).isin([str(span) for span in parts]))
        rewrite_partitions(rows.withColumn(batch_column, F.lit(str(whole))), name)
        drop_partitions(spark, name, batch_column, [str(span) for span in parts])


def _spans(spark: SparkSession, name: str, batch_column: str) -> set[Span]:
    if relation_kind(spark, name) != "table":
        return set()
    return {span for value in partition_values(spark, name, batch_column) if (span := Span.of(value))}


def _covered(spans: set[Span]) -> set[Span]:
    by_run: dict[str, list[Span]] = defaultdict(list)
    for span in spans:
        if span.level:
            by_run[span.run].append(span)
    return {span for span in spans if any(other.covers(span) for other in by_run[span.run])}


def _applied(spark: SparkSession, name: str, mark: str) -> int:
    if relation_kind(spark, name) != "table":
        return -1
    return int(table_properties(spark, name).get(mark, -1))
