"""The registered queries: a Spark plan each, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def plan(sql: str | None = None, name: str | None = None) -> Callable[[Plan], Plan]:
    """Register a function (spark, folder of tables) -> DataFrame under its name."""

    def register(fn: Plan) -> Plan:
        key = name or fn.__name__
        if key in PLANS:
            raise ValueError(f"Query {key!r} is registered twice")
        PLANS[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def path(folder: str, table: str) -> str:
    return f"{folder}/{table}.parquet"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(path(folder, table))
