"""Value encoders as native column expressions: JSON, binary, boolean, array and timestamp text.

They produce the text forms a bulk load into a database reads. Nothing here
leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemodels.operators.relational import col

# Words read as booleans.
TRUE_WORDS = ("t", "true", "y", "yes", "on", "1")
FALSE_WORDS = ("f", "false", "n", "no", "off", "0")

# Array element types by the way their values are written.
NUMERIC_ELEMENTS = ("smallint", "integer", "bigint", "real", "double precision", "numeric")
JSON_ELEMENTS = ("json", "jsonb")


def nan_to_null(value: Column, kind: T.DataType) -> Column:
    """NaN counts as null, in scalars, array elements, map values and struct members."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    if isinstance(kind, T.ArrayType) and _has_float(kind.elementType):
        return F.transform(value, lambda v: nan_to_null(v, kind.elementType))
    if isinstance(kind, T.MapType) and _has_float(kind.valueType):
        return F.transform_values(value, lambda _, v: nan_to_null(v, kind.valueType))
    if isinstance(kind, T.StructType) and _has_float(kind):
        members = [nan_to_null(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*members))
    return value


def normalize_nulls(df: DataFrame) -> DataFrame:
    """Apply :func:`nan_to_null` to every column that can hold a NaN."""
    if not any(_has_float(f.dataType) for f in df.schema.fields):
        return df
    return df.select(*[nan_to_null(col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def is_json_container(value: Column) -> Column:
    """Whether a text is one JSON object or array from its first to its last character.

    Spark's parsers stop behind the first value. So the text is put into a list in front of its own
    digest: only if the list has two items and the second is the digest, the text was one whole value.
    Repeated keys are allowed; strings in single quotes are not.
    """
    digest = F.sha2(value, 256)
    listed = F.concat(F.lit("["), value, F.lit(',"'), digest, F.lit('"]'))
    whole = (F.json_array_length(listed) == 2) & (F.get_json_object(listed, "$[1]") == digest)
    outside = F.regexp_replace(value, r'"(?:[^"\\]|\\.)*"', "")
    return F.coalesce(value.rlike(r"^\s*[{\[]") & whole & ~F.contains(outside, F.lit("'")), F.lit(False))


def encode_json_text(value: Column) -> Column:
    """JSON objects and arrays given as text pass; any other text becomes a JSON string."""
    return F.when(is_json_container(value), value).otherwise(F.to_json(value.cast("variant")))


def variant_of_text(value: Column) -> Column:
    """A variant that loses nothing of a text.

    A JSON container is stored as its value, any other text as a string. So is a container that repeats
    a key, which a variant cannot hold.
    """
    return F.coalesce(F.try_parse_json(encode_json_text(value)), F.parse_json(F.to_json(value.cast("variant"))))


def encode_json_value(value: Column, kind: T.DataType) -> Column:
    """JSON text of a struct, map or array; null members are kept.

    Decimals become strings, dates and times ISO text, binary bare hex.
    """
    return F.to_json(_json_ready(value, kind), {"ignoreNullFields": "false"})


def encode_bytea(value: Column) -> Column:
    r"""``\x`` and lower-case hex."""
    return F.concat(F.lit("\\x"), F.lower(F.hex(value)))


def parse_bool(value: Column) -> Column:
    """Boolean from text such as yes/off/1; fails the job on any other word."""
    word = F.lower(F.regexp_replace(value, r"^\s+|\s+$", ""))
    return (
        F.when(value.isNull(), F.lit(None).cast("boolean"))
        .when(word.isin(*TRUE_WORDS), F.lit(True))
        .when(word.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.raise_error(F.concat(F.lit("Not a boolean: "), value)).cast("boolean"))
    )


def encode_bool(value: Column, kind: T.DataType) -> Column:
    """``true`` / ``false`` from booleans, the integers 1 and 0, or boolean words."""
    if isinstance(kind, T.BooleanType):
        return value.cast("string")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)):
        return parse_bool(value.cast("string")).cast("string")
    raise TypeError(f"Cannot write {kind.simpleString()} as boolean")


def encode_timestamp(value: Column, separator: str = " ", with_offset: bool = False) -> Column:
    """ISO text; six fraction digits only where microseconds are not zero."""
    if not with_offset:
        # The plain cast knows no zone; date_format would move values in a gap of the session's zone.
        text = F.replace(value.cast("string"), F.lit(" "), F.lit(separator))
        fraction = F.rpad(F.substring_index(text, ".", -1), 6, "0")
        return F.when(F.contains(text, F.lit(".")), F.concat_ws(".", F.substring_index(text, ".", 1), fraction)).otherwise(text)
    joint = "' '" if separator == " " else f"'{separator}'"
    whole = F.date_format(value, f"yyyy-MM-dd{joint}HH:mm:ssxxx")
    micros = F.date_format(value, f"yyyy-MM-dd{joint}HH:mm:ss.SSSSSSxxx")
    return F.when(F.date_trunc("second", value) == value, whole).otherwise(micros)


def encode_array_literal(value: Column, kind: T.DataType, element_type: str) -> Column:
    """``{a,b,NULL}`` by element type. Text passes as a ready literal; nested arrays are rejected."""
    if isinstance(kind, T.StringType):
        return value
    if not isinstance(kind, T.ArrayType):
        raise TypeError(f"Cannot write {kind.simpleString()} as {element_type}[]")
    element = kind.elementType
    if isinstance(element, T.ArrayType):
        raise TypeError("Nested arrays cannot be written as an array literal")
    if element_type in NUMERIC_ELEMENTS and isinstance(element, T.BooleanType):
        raise TypeError("Booleans cannot be written as numeric array elements")

    def text(item: Column) -> Column:
        if element_type == "boolean":
            plain = encode_bool(item, element)
        elif element_type in NUMERIC_ELEMENTS:
            plain = item.cast("string")
        else:
            plain = _quoted_element(encode_scalar(item, element, element_type))
        missing = item.isNull()
        if isinstance(element, (T.FloatType, T.DoubleType)):
            missing = missing | F.isnan(item)
        return F.when(missing, F.lit("NULL")).otherwise(plain)

    return F.concat(F.lit("{"), F.array_join(F.transform(value, text), ","), F.lit("}"))


def encode_scalar(value: Column, kind: T.DataType, database_type: str) -> Column:
    """Text form of one value for a column (or array element) of ``database_type``."""
    if database_type in JSON_ELEMENTS:
        if isinstance(kind, T.StringType):
            return encode_json_text(value)
        if isinstance(kind, T.VariantType):
            return F.to_json(value)
        if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
            return encode_json_value(value, kind)
        return F.to_json(_json_ready(value, kind).cast("variant"))
    if database_type == "bytea":
        if isinstance(kind, T.BinaryType):
            return encode_bytea(value)
        if isinstance(kind, T.StringType):
            return value
        raise TypeError(f"Cannot write {kind.simpleString()} as bytea")
    if database_type == "boolean":
        return encode_bool(value, kind)
    if isinstance(kind, T.TimestampNTZType):
        return encode_timestamp(value)
    if isinstance(kind, T.TimestampType):
        return encode_timestamp(value, with_offset=True)
    if isinstance(kind, T.BinaryType):
        return encode_bytea(value)
    if isinstance(kind, (T.StructType, T.MapType, T.ArrayType)):
        return encode_json_value(value, kind)
    if isinstance(kind, T.VariantType):
        return F.to_json(value)
    return value.cast("string")


def encode_frame(df: DataFrame, database_types: Mapping[str, str] | None = None) -> DataFrame:
    """Every column as text, encoded for its database type (by default the one its Spark type maps to)."""
    from lakemodels.functions.types import database_type, normalize_type_name

    pins = dict(database_types or {})
    columns = []
    for field in normalize_nulls(df).schema.fields:
        name = normalize_type_name(pins.get(field.name) or database_type(field.dataType))
        value = nan_to_null(col(field.name), field.dataType)
        if name.endswith("[]"):
            text = encode_array_literal(value, field.dataType, name[:-2])
        else:
            text = encode_scalar(value, field.dataType, name)
        columns.append(text.alias(field.name))
    return df.select(*columns)


def _quoted_element(text: Column) -> Column:
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def _json_ready(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        return value.cast("string")
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(value))
    if isinstance(kind, T.TimestampNTZType):
        return encode_timestamp(value, "T")
    if isinstance(kind, T.TimestampType):
        return encode_timestamp(value, "T", with_offset=True)
    if isinstance(kind, T.DateType):
        return value.cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return nan_to_null(value, kind)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _json_ready(v, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: _json_ready(v, kind.valueType))
    if isinstance(kind, T.StructType):
        members = [_json_ready(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*members))
    return value


def _has_float(kind: T.DataType) -> bool:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_float(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_float(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_has_float(f.dataType) for f in kind.fields)
    return False
