"""Reading relations: named models, raw tables, CSV seeds, JDBC, and catalog look-ups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemodels.operators.relational import col, quoted


def table_name(*parts: str | None) -> str:
    """Backtick-quoted multi-part name; missing parts are left out."""
    return ".".join(quoted(p) for p in parts if p)


def ref_key(*args: str, version: str | int | None = None) -> str:
    """``[package.]name[.vN]``."""
    if len(args) not in (1, 2) or not all(isinstance(a, str) and a for a in args):
        raise ValueError(f"ref takes a name, or a package and a name; got {args!r}")
    key = ".".join(args)
    return key if version is None else f"{key}.v{version}"


def read_ref(spark: SparkSession, refs: Mapping[str, object], *args: str, version=None) -> DataFrame:
    """The upstream model of that name: a frame, a table name, or a path to Parquet files."""
    return _resolve(spark, refs, ref_key(*args, version=version), "ref")


def read_source(spark: SparkSession, schema: str, table: str, sources: Mapping[str, object] | None = None) -> DataFrame:
    """A declared raw table, ``schema.table``; without declarations the catalog is asked directly."""
    if sources is None:
        return spark.table(table_name(schema, table))
    return _resolve(spark, sources, f"{schema}.{table}", "source")


def _resolve(spark: SparkSession, relations: Mapping[str, object], key: str, what: str) -> DataFrame:
    if key not in relations:
        raise KeyError(f"Unknown {what} {key!r}; available: {sorted(relations)}")
    relation = relations[key]
    if isinstance(relation, DataFrame):
        return relation
    if "/" in str(relation):
        return spark.read.parquet(str(relation))
    return spark.table(str(relation))


def read_seed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header line and a declared schema (never inferred); bad rows fail the job."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST", enforceSchema=False)


def stage_casts(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Select and cast the named columns, the staging step after a seed."""
    return df.select(*[col(name).cast(kind).alias(name) for name, kind in types.items()])


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    fetch_size: int = 100_000,
    user: str | None = None,
    password: str | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``; a partition column makes the read parallel.

    ``table`` may be a subquery with an alias, which runs in the database.
    """
    if fetch_size <= 0:
        raise ValueError(f"fetch_size must be positive, got {fetch_size}")
    if partitions > 1 and not (partition_column and bounds):
        raise ValueError("A parallel read needs a partition column and its bounds")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column and bounds:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    if user:
        options["user"] = user
    if password:
        options["password"] = password
    return options


def relation_kind(spark: SparkSession, name: str) -> str | None:
    """``table``, ``view`` or None for what the catalog holds under that name."""
    if not spark.catalog.tableExists(name):
        return None
    return "view" if "VIEW" in spark.catalog.getTable(name).tableType.upper() else "table"


def target_columns(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """Ordered (name, type) pairs of a table; empty if there is none."""
    if relation_kind(spark, name) != "table":
        return []
    return [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]


def reads_files(df: DataFrame) -> bool:
    """Whether the rows of a frame still know the file they come from."""
    try:
        df.select("_metadata.file_path").schema  # noqa: B018
    except AnalysisException:
        return False
    return True


def file_sizes(df: DataFrame) -> DataFrame:
    """Rows and bytes per file of a file-based frame. One pass; of the columns only the file's name and size are read."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count(F.lit(1)).alias("n_rows"))
