"""Type inference: from the schema where it says enough, else from all values in one pass.

Each report is a frame with one row per column. The values are folded by
aggregates that combine before the shuffle; no sample decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemodels.functions.encode import is_json_container
from lakemodels.functions.types import database_type
from lakemodels.operators.relational import col

# Text patterns of the classes a text column can be found to hold.
TEXT_PATTERNS = {
    "boolean": r"(?i)^(true|false)$",
    "bigint": r"^[+-]?[0-9]{1,19}$",
    "numeric": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$",
    "double precision": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "time": r"^[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$",
    "timetz": r"^[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|[+-][0-9]{2}:?[0-9]{2})$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$",
    "timestamptz": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|[+-][0-9]{2}:?[0-9]{2})$",
    "uuid": r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    "jsonb": r"^\s*[{\[]",
}

# Element types of a homogeneous JSON list and the array type each gives.
ELEMENT_TYPES = {
    "BOOLEAN": "boolean[]",
    "BIGINT": "bigint[]",
    "DECIMAL": "numeric[]",
    "DOUBLE": "double precision[]",
    "STRING": "text[]",
    "DATE": "date[]",
    "TIMESTAMP": "timestamptz[]",
    "TIMESTAMP_NTZ": "timestamp[]",
}


def infer_types(df: DataFrame) -> dict[str, str]:
    """Database type per column from the schema alone; no job runs."""
    return {f.name: database_type(f.dataType) for f in df.schema.fields}


def infer_text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The narrowest class all non-null texts of a column share; mixed or empty means text.

    Rows: column_name, non_null, inferred_type.
    """

    def verdict(name: str) -> list[Column]:
        value = col(name)
        tests = {kind: value.rlike(pattern) for kind, pattern in TEXT_PATTERNS.items()}
        # A text of the right form can still be no value: the 30th of February, 25 o'clock, too many digits.
        for kind, spark_name in (("bigint", "bigint"), ("date", "date"), ("timestamp", "timestamp_ntz"), ("timestamptz", "timestamp")):
            tests[kind] = tests[kind] & value.try_cast(spark_name).isNotNull()
        for kind in ("time", "timetz"):
            tests[kind] = tests[kind] & value.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]")
        tests["jsonb"] = is_json_container(value)
        every = F.lit("text")
        for kind in reversed(list(tests)):
            passed = F.every(F.when(value.isNotNull(), tests[kind]))
            every = F.when(passed, F.lit(kind)).otherwise(every)
        return [F.count(value).alias("non_null"), every.alias("inferred_type")]

    return _per_column(df, columns, verdict)


def infer_integer_widths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The narrowest integer type that holds all values of a column of digits or integers.

    Rows: column_name, min_value, max_value (text), inferred_type.
    """
    limits = {"smallint": 2**15, "integer": 2**31, "bigint": 2**63}

    def verdict(name: str) -> list[Column]:
        value = col(name).cast("decimal(38,0)")
        whole = F.every(col(name).cast("double") == F.floor(col(name).cast("double")))
        low, high = F.min(value), F.max(value)
        width = F.lit("numeric")
        for kind, limit in reversed(limits.items()):
            fits = (low >= F.lit(-limit).cast("decimal(38,0)")) & (high < F.lit(str(limit)).cast("decimal(38,0)"))
            width = F.when(fits, F.lit(kind)).otherwise(width)
        return [
            low.cast("string").alias("min_value"),
            high.cast("string").alias("max_value"),
            F.when(low.isNull(), F.lit("bigint")).when(whole, width).otherwise(F.lit("numeric")).alias("inferred_type"),
        ]

    return _per_column(df, columns, verdict)


def infer_decimals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Precision and scale that hold every value: most integer digits plus most fraction digits.

    Columns are decimals or plain decimal text (no exponent). Anything over 38
    digits, or a text that is no plain decimal, gives ``numeric``.
    Rows: column_name, int_digits, frac_digits, inferred_type.
    """

    def verdict(name: str) -> list[Column]:
        text = F.trim(col(name).cast("string"))
        plain = text.rlike(TEXT_PATTERNS["numeric"])
        digits = F.ltrim(text, F.lit("+-"))
        whole = F.length(F.ltrim(F.substring_index(digits, ".", 1), F.lit("0")))
        fraction = F.when(F.contains(digits, F.lit(".")), F.length(F.substring_index(digits, ".", -1))).otherwise(0)
        most_whole, most_fraction = F.max(whole), F.max(fraction)
        precision = F.greatest(most_whole + most_fraction, F.lit(1))
        fits = F.every(plain) & (precision <= 38)
        named = F.concat(
            F.lit("numeric("), precision.cast("string"), F.lit(","), most_fraction.cast("string"), F.lit(")")
        )
        return [
            most_whole.alias("int_digits"),
            most_fraction.alias("frac_digits"),
            F.when(fits, named).otherwise(F.lit("numeric")).alias("inferred_type"),
        ]

    return _per_column(df, columns, verdict)


def infer_json_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Array type of columns that hold JSON lists as text.

    Lists of one scalar kind give an array type: whole numbers are one kind (numeric[] if any is beyond bigint), numbers
    with a fraction or an exponent another. Mixed or nested lists, lists without any value, and texts
    that are no list give jsonb. Rows: column_name, inferred_type.

    Every column is one fold of ``schema_of_variant_agg``: a text is parsed once, and what is merged and shuffled
    is a schema, whose size depends on the kinds of items and not on the rows. A merged schema of numbers does
    not tell whole numbers from others, so two flags do, which look at how the numbers are written.
    """
    numbered = list(enumerate(columns))
    parsed = []
    for i, name in numbered:
        text = col(name)
        # Of a flat list all but its strings is free of brackets, so its end is the end of the text.
        bare = F.when(F.contains(text, F.lit('"')), F.regexp_replace(text, _STRING, "0")).otherwise(text)
        flat = bare.rlike(_FLAT_LIST)
        parsed += [F.when(flat, F.try_parse_json(text)).alias(f"v{i}"), text.alias(f"t{i}")]
    folded = []
    for i, name in numbered:
        text, value = F.col(f"t{i}"), F.col(f"v{i}")
        shape = F.regexp_extract(F.schema_of_variant_agg(value), "^ARRAY<(.*)>$", 1)
        every = F.coalesce(F.bool_and(F.when(text.isNotNull(), value.isNotNull())), F.lit(False))
        # They count only where all items are numbers: then no text holds a string.
        bare = F.when(~F.contains(text, F.lit('"')), text)
        fraction = F.coalesce(F.bool_or(bare.rlike("[0-9][.eE]")), F.lit(False))
        whole = F.coalesce(F.bool_or(bare.rlike(r"[\[,\s]-?[0-9]+\s*[,\]]")), F.lit(False))
        number = F.when(fraction & whole, F.lit("")).when(fraction, F.lit("DOUBLE")).otherwise(F.regexp_extract(shape, "^[A-Z]+", 0))
        known = F.when(shape.rlike("^(BIGINT|DECIMAL|DOUBLE)"), number).otherwise(shape)
        kind = F.lit("jsonb")
        for spark_name, array_type in ELEMENT_TYPES.items():
            kind = F.when(every & (known == spark_name), F.lit(array_type)).otherwise(kind)
        folded.append(F.struct(F.lit(name).alias("column_name"), kind.alias("inferred_type")).alias(f"c{i}"))
    return df.select(*parsed).agg(*folded).select(F.inline(F.array(*[f"c{i}" for i, _ in numbered])))


# A string of a JSON text, and a list whose strings are gone. Both are matched without going back.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_FLAT_LIST = r"""^\s*\[[^\[\]{}"']*\]\s*$"""


def _per_column(df: DataFrame, columns: Sequence[str], verdict) -> DataFrame:
    """One aggregate over all columns, turned into one row per column."""
    folded = [
        F.struct(F.lit(name).alias("column_name"), *verdict(name)).alias(f"c{i}") for i, name in enumerate(columns)
    ]
    names = [f"c{i}" for i in range(len(columns))]
    return df.agg(*folded).select(F.inline(F.array(*names)))
