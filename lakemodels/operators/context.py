"""Models: Python functions from a context to a frame, published as they are configured."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakemodels.sinks.materialize import Written, materialize
from lakemodels.sources.scan import read_ref, read_source, relation_kind


@dataclass
class ModelContext:
    """What a model sees: upstream relations, its configuration, its own table.

    ``refs`` and ``sources`` map names to frames, table names or Parquet paths.
    ``config`` holds ``materialized`` and the arguments of its writer.
    """

    spark: SparkSession
    this: str
    refs: Mapping[str, object] = field(default_factory=dict)
    sources: Mapping[str, object] | None = None
    config: dict = field(default_factory=dict)

    def ref(self, *args: str, version: str | int | None = None) -> DataFrame:
        """The upstream model ``name`` or ``package, name``, in a given version if asked."""
        return read_ref(self.spark, self.refs, *args, version=version)

    def source(self, schema: str, table: str) -> DataFrame:
        return read_source(self.spark, schema, table, self.sources)

    @property
    def is_incremental(self) -> bool:
        """True when the run adds to an existing table rather than building it."""
        return (
            self.config.get("materialized") == "incremental"
            and not self.config.get("full_refresh", False)
            and relation_kind(self.spark, self.this) == "table"
        )


def run_model(model: Callable[[ModelContext], DataFrame], context: ModelContext) -> Written:
    """Call the model in this process and publish the frame it returns."""
    if not callable(model):
        raise TypeError("A model must be callable")
    result = model(context)
    if not isinstance(result, DataFrame):
        raise TypeError(f"A model must return a DataFrame, not {type(result).__name__}")
    options = {k: v for k, v in context.config.items() if k != "materialized"}
    return materialize(result, context.this, context.config.get("materialized", "table"), **options)


def run_sql_model(sql: str, context: ModelContext, **frames: DataFrame) -> Written:
    """A model written as SQL; ``{name}`` in the text stands for a frame passed by that name."""
    return run_model(lambda ctx: ctx.spark.sql(sql, **frames), context)
