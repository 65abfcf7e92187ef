import datetime as dt
import decimal
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemodels.functions import infer, scalars
from lakemodels.functions.encode import (
    encode_array_literal,
    encode_bytea,
    encode_frame,
    encode_json_text,
    encode_json_value,
    encode_scalar,
    encode_timestamp,
    is_json_container,
    normalize_nulls,
    parse_bool,
)
from lakemodels.functions.types import check_domain, database_type, domain_violations, pin_types, spark_type
from lakemodels.sinks.export import export_text


def one(spark, value, kind, expression):
    frame = spark.createDataFrame([(value,)], f"c {kind}")
    return frame.select(expression(F.col("c"), frame.schema["c"].dataType).alias("r")).first().r


def test_row_of_array_json_and_binary(spark):
    frame = spark.createDataFrame([([1, 2], {"a": 1}, bytearray(b"\x00\x01"))], "arr array<bigint>, payload map<string,int>, blob binary")
    assert encode_frame(frame).first() == ("{1,2}", '{"a":1}', "\\x0001")


@pytest.mark.parametrize("text", ["no json here", "false", "-77", "nil", "null"])
def test_json_scalars_given_as_text_become_strings(spark, text):
    assert one(spark, text, "string", lambda c, _: encode_json_text(c)) == f'"{text}"'


@pytest.mark.parametrize("text", ['{"a":1}', "[1,2,3]", '  {"a": [1, 2]}'])
def test_json_containers_given_as_text_pass(spark, text):
    assert one(spark, text, "string", lambda c, _: encode_json_text(c)) == text


def test_broken_json_becomes_a_string(spark):
    assert one(spark, '{"a":', "string", lambda c, _: encode_json_text(c)) == '"{\\"a\\":"'
    assert one(spark, None, "string", lambda c, _: encode_json_text(c)) is None


def test_json_of_nested_values(spark):
    kind = "struct<d:decimal(5,2),day:date,at:timestamp_ntz,raw:binary,none:int,x:double,l:array<decimal(3,1)>>"
    value = (
        decimal.Decimal("1.50"), dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 600), bytearray(b"\xab"), None,
        float("nan"), [decimal.Decimal("1.0"), None],
    )
    assert one(spark, value, kind, encode_json_value) == (
        '{"d":"1.50","day":"2024-01-02","at":"2024-01-02T03:04:05.000600","raw":"ab","none":null,"x":null,"l":["1.0",null]}'
    )


def test_binary(spark):
    assert one(spark, bytearray(b"\x00\xfe"), "binary", lambda c, _: encode_bytea(c)) == "\\x00fe"
    assert one(spark, "\\xff", "string", lambda c, k: encode_scalar(c, k, "bytea")) == "\\xff"
    with pytest.raises(TypeError):
        one(spark, 1, "int", lambda c, k: encode_scalar(c, k, "bytea"))


@pytest.mark.parametrize("word, value", [("yes", True), (" T ", True), ("ON", True), ("1", True), ("off", False), ("No", False), ("0", False), (None, None)])
def test_boolean_words(spark, word, value):
    assert one(spark, word, "string", lambda c, _: parse_bool(c)) is value


@pytest.mark.parametrize("word", ["maybe", "", "2", "tr ue"])
def test_other_words_are_no_booleans(spark, word):
    with pytest.raises(Exception, match="Not a boolean"):
        one(spark, word, "string", lambda c, _: parse_bool(c))


def test_boolean_columns(spark):
    assert one(spark, True, "boolean", lambda c, k: encode_scalar(c, k, "boolean")) == "true"
    assert one(spark, 0, "int", lambda c, k: encode_scalar(c, k, "boolean")) == "false"
    with pytest.raises(TypeError):
        one(spark, 1.0, "double", lambda c, k: encode_scalar(c, k, "boolean"))


@pytest.mark.parametrize(
    "value, kind, element, text",
    [
        ([1, None], "array<bigint>", "bigint", "{1,NULL}"),
        ([], "array<bigint>", "bigint", "{}"),
        ([1.5, float("nan")], "array<double>", "double precision", "{1.5,NULL}"),
        (['a"b', "c\\d", None], "array<string>", "text", '{"a\\"b","c\\\\d",NULL}'),
        (["yes", "0"], "array<string>", "boolean", "{true,false}"),
        ([bytearray(b"\x01")], "array<binary>", "bytea", '{"\\\\x01"}'),
        (["x", "[1]"], "array<string>", "jsonb", '{"\\"x\\"","[1]"}'),
        ([dt.date(2024, 1, 2)], "array<date>", "date", '{"2024-01-02"}'),
        ([dt.datetime(2024, 1, 2, 3, 4, 5)], "array<timestamp_ntz>", "timestamp", '{"2024-01-02 03:04:05"}'),
        ("{1,2}", "string", "bigint", "{1,2}"),
    ],
)
def test_array_literals(spark, value, kind, element, text):
    assert one(spark, value, kind, lambda c, k: encode_array_literal(c, k, element)) == text


@pytest.mark.parametrize(
    "value, kind, element", [([[1]], "array<array<int>>", "bigint"), ([True], "array<boolean>", "bigint"), (1, "int", "bigint")]
)
def test_bad_arrays(spark, value, kind, element):
    with pytest.raises(TypeError):
        one(spark, value, kind, lambda c, k: encode_array_literal(c, k, element))


def test_bad_boolean_in_an_array(spark):
    with pytest.raises(Exception, match="maybe"):
        one(spark, ["maybe"], "array<string>", lambda c, k: encode_array_literal(c, k, "boolean"))


def test_timestamps(spark):
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, at, "timestamp_ntz", lambda c, _: encode_timestamp(c)) == "2024-01-02 03:04:05"
    assert one(spark, at.replace(microsecond=7), "timestamp_ntz", lambda c, _: encode_timestamp(c)) == "2024-01-02 03:04:05.000007"
    assert one(spark, at.replace(tzinfo=dt.timezone.utc), "timestamp", lambda c, k: encode_scalar(c, k, "timestamptz")).endswith("+00:00")


def test_nan_counts_as_null_everywhere(spark):
    nan = float("nan")
    frame = spark.createDataFrame([(nan, [1.0, nan], (nan, "x"))], "a double, b array<double>, c struct<x:double,y:string>")
    assert normalize_nulls(frame).first() == (None, [1.0, None], (None, "x"))


def test_export_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a,b\n\"q\""), (None, None), (3, "")], "id bigint, name string")
    target = str(tmp_path / "out")
    token = export_text(frame, target)
    back = spark.read.csv(target, schema="id bigint, name string", nullValue=token, escape='"', multiLine=True)
    assert rows(back) == rows(frame)


@pytest.mark.parametrize(
    "name, kind",
    [
        ("BIGINT", "bigint"), (" double  precision ", "double"), ("numeric(18,4)", "decimal(18,4)"), ("numeric", "decimal(38,18)"),
        ("numeric(5)", "decimal(5,0)"), ("varchar(20)", "string"), ("character varying(3)", "string"), ("timestamptz", "timestamp"),
        ("timestamp", "timestamp_ntz"), ("text[]", "array<string>"), ("numeric(4,2)[]", "array<decimal(4,2)>"), ("jsonb", "variant"),
        ("uuid", "string"), ("bytea", "binary"), ("interval", "interval day to second"), ("time", "string"),
    ],
)
def test_type_names(spark, name, kind):
    assert spark_type(name, spark) == kind


@pytest.mark.parametrize("name", ["", "  ", "text; drop", "my_enum", "numeric(39,2)", "int'"])
def test_bad_type_names(spark, name):
    with pytest.raises(ValueError):
        spark_type(name, spark)


@pytest.mark.parametrize(
    "ddl, name",
    [
        ("tinyint", "smallint"), ("int", "integer"), ("float", "real"), ("double", "double precision"), ("boolean", "boolean"),
        ("string", "text"), ("binary", "bytea"), ("date", "date"), ("timestamp", "timestamptz"), ("timestamp_ntz", "timestamp"),
        ("interval day to second", "interval"), ("decimal(4,2)", "numeric(4,2)"), ("array<bigint>", "bigint[]"),
        ("array<array<int>>", "jsonb"), ("struct<a:int>", "jsonb"), ("map<string,int>", "jsonb"), ("variant", "jsonb"), ("void", "text"),
    ],
)
def test_types_from_the_schema(spark, ddl, name):
    assert database_type(T.StructType.fromDDL(f"c {ddl}")["c"].dataType) == name


def test_infer_types_runs_no_job(spark):
    assert infer.infer_types(spark.range(1).withColumn("d", F.lit(1.5))) == {"id": "bigint", "d": "double precision"}


def test_pins(spark):
    frame = spark.createDataFrame([("1", 2.0, "ABC", '{"a":1}')], "id string, amount double, u string, doc string")
    pinned = pin_types(frame, {"id": "bigint", "amount": "numeric(18,4)", "u": "uuid", "doc": "jsonb"})
    assert pinned.schema.simpleString() == "struct<id:bigint,amount:decimal(18,4),u:string,doc:variant>"
    assert pinned.select("id", "amount", "u", F.to_json("doc")).first() == (1, decimal.Decimal("2.0000"), "abc", '{"a":1}')


@pytest.mark.parametrize("value, pin", [("abc", "bigint"), ("99999", "smallint"), ("123456", "numeric(4,2)")])
def test_values_that_do_not_fit_fail(spark, value, pin):
    with pytest.raises(Exception):
        pin_types(spark.createDataFrame([(value,)], "c string"), {"c": pin}).collect()


def test_unknown_columns_are_rejected(spark):
    frame = spark.createDataFrame([("a", 1)], "status string, id int")
    with pytest.raises(ValueError, match="nope"):
        pin_types(frame, {"nope": "text"})
    with pytest.raises(ValueError, match="nope"):
        pin_types(frame, category_types={"nope": ["a"]})
    with pytest.raises(TypeError):
        pin_types(frame, category_types={"id": ["a"]})


def test_categories(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "status string, id int")
    assert rows(pin_types(frame, category_types={"status": ["a", "b"]})) == rows(frame)
    with pytest.raises(Exception, match="domain"):
        pin_types(frame, category_types={"status": ["a"]}).collect()
    # A pin wins over a category.
    assert pin_types(frame, {"status": "text"}, {"status": ["a"]}).count() == 3
    assert rows(domain_violations(frame, "status", ["a"])) == [("b", 1)]
    assert one(spark, None, "string", lambda c, _: check_domain(c, ["a"])) is None


def text_type(spark, *values):
    frame = spark.createDataFrame([(v,) for v in values], "c string")
    return infer.infer_text_columns(frame, ["c"]).first().inferred_type


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "-2", None], "bigint"), (["1", "2.5"], "numeric"), (["1e3", "2"], "double precision"), (["true", "FALSE"], "boolean"),
        (["2024-01-02"], "date"), (["03:04:05"], "time"), (["03:04:05+01:00"], "timetz"), (["2024-01-02 03:04:05"], "timestamp"),
        (["2024-01-02T03:04:05Z"], "timestamptz"), (["2024-01-02T03:04:05Z", "2024-01-02T03:04:05"], "text"),
        (["6f9619ff-8b86-d011-b42d-00c04fc964ff"], "uuid"), (['{"a":1}', "[1]"], "jsonb"), (["{x"], "text"),
        (["1", "x"], "text"), ([None, None], "text"),
    ],
)
def test_text_columns(spark, values, kind):
    assert text_type(spark, *values) == kind


@pytest.mark.parametrize(
    "values, kind",
    [
        (["123", "0.001"], "numeric(6,3)"), (["12.34"], "numeric(4,2)"), (["-0.05"], "numeric(2,2)"), (["0"], "numeric(1,0)"),
        (["1" * 39], "numeric"), (["NaN", "1"], "numeric"), ([None], "numeric"),
    ],
)
def test_decimals(spark, values, kind):
    frame = spark.createDataFrame([(v,) for v in values], "c string")
    assert infer.infer_decimals(frame, ["c"]).first().inferred_type == kind


@pytest.mark.parametrize(
    "low, high, kind",
    [(0, 32767, "smallint"), (-32769, 0, "integer"), (0, 2**31, "bigint"), (0, 2**63 - 1, "bigint"), (0, 2**63, "numeric"), (0, 2**64 - 1, "numeric")],
)
def test_integer_widths(spark, low, high, kind):
    frame = spark.createDataFrame([(str(low),), (str(high),)], "c string")
    assert infer.infer_integer_widths(frame, ["c"]).first().inferred_type == kind


@pytest.mark.parametrize(
    "values, kind",
    [
        (["[1, null]", "[]"], "bigint[]"), (['["a"]'], "text[]"), (["[true]"], "boolean[]"), (["[1.5]"], "double precision[]"), (["[2.0]", "[1e3]"], "double precision[]"), (["[1, 2.5]"], "jsonb"), (["[1]", "not a list"], "jsonb"),
        (["[12345678901234567890]"], "numeric[]"),
        (["[1]", "[12345678901234567890]"], "numeric[]"), (["[1.5]", "[12345678901234567890]"], "jsonb"), (["[-1.5e-10, 2.5E+3]"], "double precision[]"),
        (["[1] x"], "jsonb"), (["[1]", None], "bigint[]"), ([None, None], "jsonb"), (['["a]", "[", "\\\\\\"", "x"]'], "text[]"), (['["a"] "b"'], "jsonb"),
        (["['a']"], "jsonb"), (["[01]"], "jsonb"), (['["1.5", null]', '["2"]'], "text[]"), (["5"], "jsonb"), (['[{"a": 1}]'], "jsonb"), ([" [ 1 , 2 ] "], "bigint[]"),
        (['["' + "x" * 200_000 + '"]'], "text[]"), (["[" + "1, " * 100_000 + "1]"], "bigint[]"), (["[" + '"a", ' * 100_000 + '"b"]'], "text[]"), (["[1, tru]"], "jsonb"),
        (['[1, "a"]'], "jsonb"), (["[[1]]"], "jsonb"), (["[null]"], "jsonb"), (['{"a":1}'], "jsonb"),
    ],
)
def test_json_arrays(spark, values, kind):
    frame = spark.createDataFrame([(v,) for v in values], "c string").repartition(2)
    assert infer.infer_json_arrays(frame, ["c"]).first().inferred_type == kind


def test_scalars(spark):
    assert one(spark, "x1", "string", lambda c, _: scalars.coerce_number(c)) is None
    assert one(spark, "1e2", "string", lambda c, _: scalars.coerce_number(c)) == 100.0
    for value, wanted in ((100.0, "high"), (99.9, "standard"), (None, "standard")):
        assert one(spark, value, "double", lambda c, _: scalars.bucket(c, 100)) == wanted
    assert one(spark, "A", "string", lambda c, _: scalars.joint_text(c, F.lit("B"))) == "a b"
    assert one(spark, None, "string", lambda c, _: scalars.joint_text(c, F.lit("B"))) is None
    sunday = dt.datetime(2026, 2, 15, 3, 14)
    assert one(spark, sunday, "timestamp_ntz", lambda c, _: scalars.day_of_week(c)) == 6
    assert one(spark, sunday, "timestamp_ntz", lambda c, _: scalars.hour_of_day(c)) == 3
    assert one(spark, sunday, "timestamp_ntz", lambda c, _: scalars.add_minutes(c, F.lit(60))) == dt.datetime(2026, 2, 15, 4, 14)
    assert one(spark, -1.0, "double", lambda c, _: scalars.clip_low(c)) == 0.0
    assert one(spark, decimal.Decimal("2.345"), "decimal(5,3)", lambda c, _: scalars.round_half_even(c)) == decimal.Decimal("2.34")
    assert one(spark, 1, "int", lambda c, _: scalars.load_timestamp()) is not None


def test_encoders_stay_in_the_jvm(spark, data):
    plan = encode_frame(spark.read.parquet(f"{data}/events.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_json_is_one_value_to_its_end(spark):
    texts = {
        '[1] Smith et al. (2020)': False, '{"a":1} and more': False, '[1],[2]': False, '[1],0] forged': False, '{"a":1,"a":2}': True,
        " [1, 2] ": True, '{"it\'s": [true]}': True, "{'a': 1}": False, "[": False, "plain": False,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "c string")
    got = {r.c: r.ok for r in frame.select("c", is_json_container(F.col("c")).alias("ok")).collect()}
    assert got == texts
    pinned = pin_types(frame, {"c": "jsonb"}).select(F.to_json("c").alias("j")).collect()
    kept = {json.loads(r.j) if isinstance(json.loads(r.j), str) else r.j for r in pinned}
    # Nothing is cut off: what a variant cannot hold as a value is there as text.
    assert {"[1] Smith et al. (2020)", '{"a":1} and more', "[1],0] forged", '{"a":1,"a":2}', "[1,2]"} <= kept


def test_timestamps_without_zone_do_not_move(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        frame = spark.sql("SELECT timestamp_ntz '2024-03-31 02:30:00' AS a, timestamp_ntz '2024-03-31 02:30:00.00012' AS b")
        assert encode_frame(frame).first() == ("2024-03-31 02:30:00", "2024-03-31 02:30:00.000120")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_impossible_values_are_text(spark):
    for texts in (["2023-02-30"], ["99:99:99"], ["2024-01-01 25:00:00"], ["2024-01-01", "x"]):
        assert text_type(spark, *texts) == "text"
    assert text_type(spark, "9223372036854775807") == "bigint"
    assert text_type(spark, "9223372036854775808") == "numeric"


def test_character_lengths_are_enforced(spark):
    frame = spark.createDataFrame([("abc",), ("ab ",), (None,), ("abc  ",)], "c string")
    assert [r.c for r in pin_types(frame, {"c": "varchar(3)"}).collect()] == ["abc", "ab ", None, "abc"]
    with pytest.raises(Exception, match="too long"):
        pin_types(frame, {"c": "character varying(2)"}).collect()


def test_nan_in_map_values_is_null(spark):
    frame = spark.sql("SELECT map('a', double('NaN'), 'b', 1.0D) AS m")
    assert normalize_nulls(frame).first().m == {"a": None, "b": 1.0}


def test_fractions_are_no_integers(spark):
    frame = spark.createDataFrame([(1.5,), (2.0,)], "c double")
    assert infer.infer_integer_widths(frame, ["c"]).first().inferred_type == "numeric"
