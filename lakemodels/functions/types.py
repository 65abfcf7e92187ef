"""Column type pins: database type names on one side, Spark types on the other."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemodels.functions.encode import parse_bool, variant_of_text
from lakemodels.operators.merge import check_unique_columns
from lakemodels.operators.relational import col

# Database type names and the Spark type each one is stored as.
TYPE_NAMES = {
    "bigint": "bigint",
    "bool": "boolean",
    "boolean": "boolean",
    "bytea": "binary",
    "char": "string",
    "character": "string",
    "character varying": "string",
    "citext": "string",
    "date": "date",
    "decimal": "decimal(38,18)",
    "double precision": "double",
    "float4": "float",
    "float8": "double",
    "int": "int",
    "int2": "smallint",
    "int4": "int",
    "int8": "bigint",
    "integer": "int",
    "interval": "interval day to second",
    "json": "variant",
    "jsonb": "variant",
    "numeric": "decimal(38,18)",
    "real": "float",
    "smallint": "smallint",
    "text": "string",
    "time": "time(6)",
    "time without time zone": "time(6)",
    "time with time zone": "string",
    "timestamp": "timestamp_ntz",
    "timestamp without time zone": "timestamp_ntz",
    "timestamp with time zone": "timestamp",
    "timestamptz": "timestamp",
    "timetz": "string",
    "uuid": "string",
    "varchar": "string",
}

_SIZED = re.compile(r"(?P<name>[a-z ]*[a-z]) ?\( ?(?P<size>\d+) ?(?:, ?(?P<scale>\d+) ?)?\)")
_TEXT_LENGTH = {"varchar", "character varying", "char", "character"}


def normalize_type_name(type_sql: str) -> str:
    """Lower case, every run of blanks one blank, none at the ends."""
    return re.sub(r"\s+", " ", type_sql).strip().lower()


@dataclass(frozen=True)
class DatabaseType:
    """A database type name taken apart: base name, numbers in brackets, array dimensions."""

    name: str
    size: int | None = None
    scale: int | None = None
    dimensions: int = 0

    @classmethod
    def parse(cls, type_sql: str) -> DatabaseType:
        text = normalize_type_name(type_sql)
        element = re.sub(r"( ?\[ ?\])+$", "", text)
        sized = _SIZED.fullmatch(element)
        name = sized["name"] if sized else element
        if name not in TYPE_NAMES:
            raise ValueError(f"Unknown column type {type_sql!r}")
        numbers = [int(sized[part]) if sized[part] else None for part in ("size", "scale")] if sized else [None, None]
        return cls(name, *numbers, dimensions=text.count("["))

    @property
    def most_characters(self) -> int | None:
        """The length that a character type enforces; a bare ``char`` holds one character."""
        if self.name not in _TEXT_LENGTH:
            return None
        return self.size or (1 if self.name.startswith("char") and self.name != "character varying" else None)


def spark_type(type_sql: str, spark: SparkSession | None = None) -> str:
    """The Spark DDL type for a database type name.

    Decimals keep precision and scale, at most 38 digits. ``time`` needs Spark's TIME type; where the
    session has it switched off the column is stored as text.
    """
    wanted = DatabaseType.parse(type_sql)
    stored = TYPE_NAMES[wanted.name]
    if wanted.size is not None and wanted.name in ("numeric", "decimal"):
        scale = wanted.scale or 0
        if wanted.size > 38 or scale > wanted.size:
            raise ValueError(f"{type_sql!r}: Spark decimals hold at most 38 digits, scale within precision")
        stored = f"decimal({wanted.size},{scale})"
    if stored.startswith("time(") and not _time_type_enabled(spark):
        stored = "string"
    return "array<" * wanted.dimensions + stored + ">" * wanted.dimensions


def database_type(kind: T.DataType) -> str:
    """The database type name a Spark column would have, the inverse of :func:`spark_type`."""
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision},{kind.scale})"
    if isinstance(kind, T.ArrayType):
        element = kind.elementType
        if isinstance(element, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            return "jsonb"
        return "numeric[]" if isinstance(element, T.DecimalType) else f"{database_type(element)}[]"
    if isinstance(kind, (T.StructType, T.MapType, T.VariantType)):
        return "jsonb"
    if isinstance(kind, T.DayTimeIntervalType):
        return "interval"
    if isinstance(kind, (T.CharType, T.VarcharType)):
        return "text"
    if kind.simpleString().startswith("time("):
        return "time"
    return {
        "boolean": "boolean",
        "tinyint": "smallint",
        "smallint": "smallint",
        "int": "integer",
        "bigint": "bigint",
        "float": "real",
        "double": "double precision",
        "string": "text",
        "binary": "bytea",
        "date": "date",
        "timestamp": "timestamptz",
        "timestamp_ntz": "timestamp",
        "void": "text",
    }.get(kind.simpleString(), "text")


def pin_types(
    df: DataFrame,
    column_types: Mapping[str, str] | None = None,
    category_types: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Cast pinned columns, check category columns, keep the others.

    A pin wins over a category. Values that do not fit fail the job, as ANSI
    casts do. Columns of unknown type (all null) become text.
    """
    check_unique_columns(df.columns)
    pins = dict(column_types or {})
    categories = dict(category_types or {})
    for label, mapping in (("column_types", pins), ("category_types", categories)):
        unknown = sorted(set(mapping) - set(df.columns))
        if unknown:
            raise ValueError(f"{label} names columns that are not in the frame: {unknown}; have {df.columns}")
    spark = df.sparkSession
    columns = []
    for field in df.schema.fields:
        if field.name in pins:
            value = _cast(field, normalize_type_name(pins[field.name]), spark)
        elif field.name in categories:
            if not isinstance(field.dataType, T.StringType):
                raise TypeError(f"Category column {field.name!r} is {field.dataType.simpleString()}, not text")
            value = check_domain(col(field.name), categories[field.name], field.name)
        elif isinstance(field.dataType, T.NullType):
            value = col(field.name).cast("string")
        else:
            value = col(field.name)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def check_domain(value: Column, domain: Sequence[str], name: str = "column") -> Column:
    """The value itself if it is null or in the domain; fails the job otherwise."""
    bad = F.concat(F.lit(f"Value outside the domain of {name}: "), value)
    return F.when(value.isNull() | value.isin(*domain), value).otherwise(F.raise_error(bad))


def domain_violations(df: DataFrame, name: str, domain: Sequence[str]) -> DataFrame:
    """Values outside the domain with their row counts (a report; does not fail)."""
    value = col(name)
    return df.where(value.isNotNull() & ~value.isin(*domain)).groupBy(value.alias("value")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def _cast(field: T.StructField, pin: str, spark: SparkSession) -> Column:
    value = col(field.name)
    if pin in ("json", "jsonb"):
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_variant_object(value)
        if isinstance(field.dataType, T.VariantType):
            return value
        if isinstance(field.dataType, T.StringType):
            return variant_of_text(value)
        return value.cast("variant")
    if pin == "uuid":
        return F.lower(F.trim(value.cast("string")))
    if pin == "boolean" and isinstance(field.dataType, T.StringType):
        return parse_bool(value)
    most = DatabaseType.parse(pin).most_characters
    if most is not None and not pin.endswith("]"):
        return _at_most(value.cast("string"), most, field.name, pin)
    return value.cast(spark_type(pin, spark))


def _at_most(value: Column, characters: int, name: str, pin: str) -> Column:
    """The text if it fits; blanks beyond the length are cut off, anything else there fails the job."""
    over = F.concat(F.lit(f"Value of {name} is too long for {pin}: "), value)
    return (
        F.when(F.length(value) <= characters, value)
        .when(F.length(F.rtrim(value)) <= characters, F.substring(value, 1, characters))
        .when(value.isNotNull(), F.raise_error(over))
    )


def _time_type_enabled(spark: SparkSession | None) -> bool:
    return bool(spark) and spark.conf.get("spark.sql.timeType.enabled", "false") == "true"
