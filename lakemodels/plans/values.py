"""Scalar functions, value encoders, type inference and type pins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemodels.functions import infer, scalars
from lakemodels.functions.encode import (
    encode_array_literal,
    encode_bytea,
    encode_json_text,
    encode_json_value,
    encode_timestamp,
    normalize_nulls,
    parse_bool,
)
from lakemodels.functions.types import domain_violations, pin_types
from lakemodels.operators.relational import project
from lakemodels.plans.registry import plan, read
from lakemodels.sinks.export import export_text
from lakemodels.sources.workspace import fresh_dir


@plan("""
    SELECT o_orderkey AS order_id,
           TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS revenue
    FROM orders
""")
def coerce_numeric(spark, folder):
    text = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), scalars.coerce_number(text).alias("revenue")
    )


@plan("SELECT p_partkey, lower(p_name || ' ' || p_type || ' ' || p_brand) AS text FROM part")
def text_concat_lower(spark, folder):
    return read(spark, folder, "part").select(
        "p_partkey", scalars.joint_text(F.col("p_name"), F.col("p_type"), F.col("p_brand")).alias("text")
    )


@plan("""
    SELECT event_id, CAST(extract(hour FROM ts) AS SMALLINT) AS hour_of_day,
           CAST(isodow(ts) - 1 AS SMALLINT) AS day_of_week
    FROM events
""")
def time_features(spark, folder):
    return read(spark, folder, "events").select(
        "event_id", scalars.hour_of_day(F.col("ts")).alias("hour_of_day"), scalars.day_of_week(F.col("ts")).alias("day_of_week")
    )


@plan("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS balance,
           CAST(CASE WHEN (c_custkey // 2) % 2 = 0 THEN c_custkey // 2 ELSE (c_custkey + 1) // 2 END AS DOUBLE) AS half_key
    FROM customer
""")
def clip_round(spark, folder):
    return read(spark, folder, "customer").select(
        "c_custkey",
        scalars.clip_low(F.col("c_acctbal")).alias("balance"),
        scalars.round_half_even(F.col("c_custkey") / 2, 0).alias("half_key"),
    )


@plan("SELECT event_id, ts + to_minutes(user_id) AS due FROM events")
def timestamp_add(spark, folder):
    return read(spark, folder, "events").select(
        "event_id", scalars.add_minutes(F.col("ts"), F.col("user_id").cast("int")).alias("due")
    )


_JSON_TEXT = "CASE WHEN json_valid({0}) AND ltrim({0})[1] IN ('{{', '[') THEN {0} ELSE CAST(to_json({0}) AS VARCHAR) END"


@plan(f"""
    SELECT event_id, {_JSON_TEXT.format('props')} AS props, {_JSON_TEXT.format('event_type')} AS event_type,
           {_JSON_TEXT.format("CAST(user_id AS VARCHAR)")} AS user_id,
           {_JSON_TEXT.format("('[' || user_id || ']')")} AS list, {_JSON_TEXT.format("('[' || event_type)")} AS broken
    FROM events
""", name="encode_json_text")
def json_text_of_events(spark, folder):
    return read(spark, folder, "events").select(
        "event_id",
        encode_json_text(F.col("props")).alias("props"),
        encode_json_text(F.col("event_type")).alias("event_type"),
        encode_json_text(F.col("user_id").cast("string")).alias("user_id"),
        encode_json_text(F.concat(F.lit("["), F.col("user_id"), F.lit("]"))).alias("list"),
        encode_json_text(F.concat(F.lit("["), F.col("event_type"))).alias("broken"),
    )


@plan(f"""
    SELECT doc_id, {_JSON_TEXT.format('text')} AS text, {_JSON_TEXT.format('source')} AS source FROM documents
""")
def encode_json_documents(spark, folder):
    return read(spark, folder, "documents").select(
        "doc_id", encode_json_text(F.col("text")).alias("text"), encode_json_text(F.col("source")).alias("source")
    )


@plan("""
    SELECT o_orderkey AS order_id, CAST(json_object(
        'key', o_orderkey, 'price', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR),
        'ordered_at', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'),
        'note', CASE WHEN o_orderstatus = 'O' THEN 'open' END,
        'raw', lower(hex(CAST(o_orderstatus AS BLOB)))) AS VARCHAR) AS payload
    FROM orders
""")
def encode_json_struct(spark, folder):
    payload = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.struct(
            F.col("o_orderkey").alias("key"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
            F.col("o_orderdate").alias("ordered_at"),
            F.when(F.col("o_orderstatus") == "O", "open").alias("note"),
            F.col("o_orderstatus").cast("binary").alias("raw"),
        ).alias("payload"),
    )
    return payload.select("order_id", encode_json_value(F.col("payload"), payload.schema["payload"].dataType).alias("payload"))


@plan(r"SELECT c_custkey, '\x' || lower(hex(CAST(c_name AS BLOB))) AS name_bytes FROM customer", name="encode_bytea")
def bytea_of_names(spark, folder):
    return read(spark, folder, "customer").select(
        "c_custkey", encode_bytea(F.col("c_name").cast("binary")).alias("name_bytes")
    )


@plan("""
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN true
           WHEN '3-MEDIUM' THEN false WHEN '4-NOT SPECIFIED' THEN NULL ELSE false END AS flag
    FROM orders
""", name="parse_bool")
def boolean_words(spark, folder):
    priority = F.col("o_orderpriority")
    word = (
        F.when(priority == "1-URGENT", " Yes")
        .when(priority == "2-HIGH", "ON")
        .when(priority == "3-MEDIUM", "off ")
        .when(priority == "5-LOW", "0")
    )
    return read(spark, folder, "orders").select("o_orderkey", parse_bool(word).alias("flag"))


@plan(r"""
    SELECT o_orderkey, '{' || o_orderkey || ',NULL,' || o_custkey || '}' AS numbers,
           '{"' || o_orderpriority || '","a \"quoted\" \\ text",NULL}' AS texts,
           '{' || CASE WHEN o_totalprice > 250000 THEN 'true' ELSE 'false' END || ',NULL}' AS flags
    FROM orders
""", name="encode_array_literal")
def array_literals(spark, folder):
    orders = read(spark, folder, "orders").select(
        "o_orderkey",
        F.array("o_orderkey", F.lit(None).cast("bigint"), "o_custkey").alias("numbers"),
        F.array("o_orderpriority", F.lit('a "quoted" \\ text'), F.lit(None).cast("string")).alias("texts"),
        F.array(F.col("o_totalprice") > 250000, F.lit(None).cast("boolean")).alias("flags"),
    )
    kinds = {f.name: f.dataType for f in orders.schema.fields}
    return orders.select(
        "o_orderkey",
        encode_array_literal(F.col("numbers"), kinds["numbers"], "bigint").alias("numbers"),
        encode_array_literal(F.col("texts"), kinds["texts"], "text").alias("texts"),
        encode_array_literal(F.col("flags"), kinds["flags"], "boolean").alias("flags"),
    )


@plan("""
    SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
           ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS at,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at_second
    FROM events
""", name="encode_timestamp")
def timestamp_texts(spark, folder):
    return read(spark, folder, "events").select(
        "event_id",
        encode_timestamp(F.col("ts")).alias("at"),
        encode_timestamp(F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")).alias("at_second"),
    )


@plan("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN event_type <> 'error' THEN value END AS first_reading, CAST(event_id AS DOUBLE) AS second_reading
    FROM events
""")
def nan_to_null(spark, folder):
    noisy = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    readings = read(spark, folder, "events").select(
        "event_id", noisy.alias("value"), F.array(noisy, F.col("event_id").cast("double")).alias("readings")
    )
    clean = normalize_nulls(readings)
    return clean.select(
        "event_id",
        "value",
        F.get("readings", F.lit(0)).alias("first_reading"),
        F.get("readings", F.lit(1)).alias("second_reading"),
    )


@plan("""
    SELECT o_orderkey AS order_id, CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) AS amount,
           '{"' || o_orderpriority || '",' || CASE WHEN o_orderstatus = 'F' THEN '"done"' ELSE 'NULL' END || '}' AS tags,
           CAST(json_object('channel', CASE WHEN o_totalprice > 250000 THEN 'web' ELSE 'mobile' END,
                            'promo', CASE WHEN o_orderstatus = 'P' THEN 'SPRING25' END) AS VARCHAR) AS attributes
    FROM orders
""")
def struct_array_columns(spark, folder):
    orders = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        F.array("o_orderpriority", F.when(F.col("o_orderstatus") == "F", "done")).alias("tags"),
        F.struct(
            F.when(F.col("o_totalprice") > 250000, "web").otherwise("mobile").alias("channel"),
            F.when(F.col("o_orderstatus") == "P", "SPRING25").alias("promo"),
        ).alias("attributes"),
    )
    pinned = pin_types(orders, {"amount": "numeric(18,4)", "tags": "text[]", "attributes": "jsonb"})
    return pinned.select(
        "order_id",
        F.col("amount").cast("string").alias("amount"),
        encode_array_literal(F.col("tags"), T.ArrayType(T.StringType()), "text").alias("tags"),
        F.to_json("attributes").alias("attributes"),
    )


@plan("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           regexp_replace(event_type, '[aeiou]', '_', 'g') AS masked
    FROM events
""")
def json_extract(spark, folder):
    return read(spark, folder, "events").select(
        "event_id",
        F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k"),
        F.regexp_replace("event_type", "[aeiou]", "_").alias("masked"),
    )


@plan("""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered_at,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
           CASE WHEN o_totalprice > 250000 THEN 'true' ELSE 'false' END AS is_large,
           CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN '' ELSE 'say "hi", ok' END AS note
    FROM orders
""")
def text_export_rows(spark, folder):
    orders = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ordered_at"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        (F.col("o_totalprice") > 250000).alias("is_large"),
        F.when(F.col("o_orderstatus") == "O", 'say "hi", ok').when(F.col("o_orderstatus") == "F", "").alias("note"),
    )
    target = fresh_dir(spark, "export")
    token = export_text(orders, target)
    schema = ", ".join(f"{c} string" for c in orders.columns)
    return spark.read.csv(target, schema=schema, nullValue=token, escape='"')


def _order_texts(spark, folder):
    return read(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("price_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("time_text"),
        F.when(F.col("o_orderstatus") == "F", "true").when(F.col("o_orderstatus") == "O", "False").alias("flag_text"),
        F.when(F.col("o_orderstatus") == "F", "1").otherwise("many").alias("mixed_text"),
        F.lit(None).cast("string").alias("empty_text"),
        F.concat(F.lit('{"k": '), F.col("o_orderkey"), F.lit("}")).alias("json_text"),
    )


@plan("""
    WITH o AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price_text,
               strftime(o_orderdate, '%Y-%m-%d') AS date_text, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time_text,
               CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'False' END AS flag_text,
               CASE o_orderstatus WHEN 'F' THEN '1' ELSE 'many' END AS mixed_text,
               CAST(NULL AS VARCHAR) AS empty_text, '{"k": ' || o_orderkey || '}' AS json_text
        FROM orders
    ), long AS (SELECT * FROM o UNPIVOT INCLUDE NULLS (v FOR column_name IN (COLUMNS(*))))
    SELECT column_name, count(v) AS non_null, CASE
        WHEN count(v) = 0 THEN 'text'
        WHEN bool_and(lower(v) IN ('true', 'false')) THEN 'boolean'
        WHEN bool_and(TRY_CAST(v AS BIGINT) IS NOT NULL AND regexp_matches(v, '^[0-9]+$')) THEN 'bigint'
        WHEN bool_and(TRY_CAST(v AS DECIMAL(18,2)) IS NOT NULL) THEN 'numeric'
        WHEN bool_and(length(v) = 10 AND TRY_CAST(v AS DATE) IS NOT NULL) THEN 'date'
        WHEN bool_and(length(v) = 19 AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL) THEN 'timestamp'
        WHEN bool_and(json_valid(v) AND v[1] IN ('{', '[')) THEN 'jsonb'
        ELSE 'text' END AS inferred_type
    FROM long GROUP BY column_name
""")
def infer_text_column(spark, folder):
    texts = _order_texts(spark, folder)
    return infer.infer_text_columns(texts, texts.columns)


@plan("""
    WITH o AS (
        SELECT CAST(l_linenumber AS BIGINT) AS line_number, CAST(l_orderkey + 100000 AS BIGINT) AS order_number,
               CAST(l_orderkey * 1000000000 AS BIGINT) AS wide_number, CAST(l_suppkey AS BIGINT) - 40000 AS signed_number
        FROM lineitem
    ), long AS (UNPIVOT o ON COLUMNS(*) INTO NAME column_name VALUE v)
    SELECT column_name, CAST(min(v) AS VARCHAR) AS min_value, CAST(max(v) AS VARCHAR) AS max_value,
           CASE WHEN min(v) >= -32768 AND max(v) <= 32767 THEN 'smallint'
                WHEN min(v) >= -2147483648 AND max(v) <= 2147483647 THEN 'integer' ELSE 'bigint' END AS inferred_type
    FROM long GROUP BY column_name
""")
def infer_integer_width(spark, folder):
    numbers = read(spark, folder, "lineitem").select(
        F.col("l_linenumber").alias("line_number"),
        (F.col("l_orderkey") + 100_000).cast("string").alias("order_number"),
        (F.col("l_orderkey") * 1_000_000_000).alias("wide_number"),
        (F.col("l_suppkey") - 40_000).cast("string").alias("signed_number"),
    )
    return infer.infer_integer_widths(numbers, numbers.columns)


@plan("""
    WITH o AS (
        SELECT CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
               CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS discount,
               CAST(l_orderkey AS VARCHAR) AS whole, '-' || CAST(CAST(l_tax AS DECIMAL(6,5)) AS VARCHAR) AS negative_tax
        FROM lineitem
    ), long AS (UNPIVOT o ON COLUMNS(*) INTO NAME column_name VALUE v),
    sized AS (SELECT column_name, max(length(ltrim(split_part(ltrim(v, '-'), '.', 1), '0'))) AS int_digits,
                     max(length(split_part(v, '.', 2))) AS frac_digits FROM long GROUP BY column_name)
    SELECT column_name, CAST(int_digits AS INTEGER) AS int_digits, CAST(frac_digits AS INTEGER) AS frac_digits,
           'numeric(' || greatest(int_digits + frac_digits, 1) || ',' || frac_digits || ')' AS inferred_type
    FROM sized
""")
def infer_decimal(spark, folder):
    amounts = read(spark, folder, "lineitem").select(
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_discount").cast("decimal(4,2)").cast("string").alias("discount"),
        F.col("l_orderkey").alias("whole"),
        F.concat(F.lit("-"), F.col("l_tax").cast("decimal(6,5)").cast("string")).alias("negative_tax"),
    )
    return infer.infer_decimals(amounts, amounts.columns)


@plan("""
    WITH o AS (
        SELECT '[' || o_orderkey || ', null, ' || o_custkey || ']' AS numbers,
               '["' || o_orderpriority || '", "x"]' AS texts, '[true, null]' AS flags,
               '[' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || ']' AS prices,
               '[1, "' || o_orderstatus || '"]' AS mixed, '[[' || o_orderkey || ']]' AS nested, '[null]' AS empties
        FROM orders
    ), long AS (UNPIVOT o ON COLUMNS(*) INTO NAME column_name VALUE v),
    parts AS (SELECT column_name, unnest(CAST(json_extract(v, '$[*]') AS JSON[])) AS e FROM long),
    kinds AS (SELECT DISTINCT column_name, CASE json_type(e) WHEN 'UBIGINT' THEN 'bigint[]' WHEN 'BIGINT' THEN 'bigint[]'
                  WHEN 'DOUBLE' THEN 'double precision[]' WHEN 'VARCHAR' THEN 'text[]' WHEN 'BOOLEAN' THEN 'boolean[]'
                  WHEN 'NULL' THEN NULL ELSE 'jsonb' END AS kind FROM parts)
    SELECT column_name, CASE WHEN count(kind) = 1 THEN max(kind) ELSE 'jsonb' END AS inferred_type
    FROM kinds GROUP BY column_name
""")
def infer_array_element(spark, folder):
    def lists(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    orders = read(spark, folder, "orders").select(
        lists("[", F.col("o_orderkey"), ", null, ", F.col("o_custkey"), "]").alias("numbers"),
        lists('["', F.col("o_orderpriority"), '", "x"]').alias("texts"),
        F.lit("[true, null]").alias("flags"),
        lists("[", F.col("o_totalprice").cast("decimal(12,2)").cast("string"), "]").alias("prices"),
        lists('[1, "', F.col("o_orderstatus"), '"]').alias("mixed"),
        lists("[[", F.col("o_orderkey"), "]]").alias("nested"),
        F.lit("[null]").alias("empties"),
    )
    return infer.infer_json_arrays(orders, orders.columns)


@plan("""
    SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) AS amount,
           strftime(o_orderdate, '%Y-%m-%d') AS ordered_on, CAST(o_custkey AS VARCHAR) AS customer,
           o_orderstatus = 'F' AS done
    FROM orders
""", name="pin_types")
def pinned_orders(spark, folder):
    orders = project(
        read(spark, folder, "orders"),
        "o_orderkey AS order_id, o_totalprice AS amount, o_orderdate AS ordered_on, o_custkey AS customer, "
        "IF(o_orderstatus = 'F', 'yes', 'no') AS done",
    )
    pins = {"order_id": "integer", "amount": "numeric(18,4)", "ordered_on": "date", "customer": "varchar(20)", "done": "boolean"}
    pinned = pin_types(orders, pins)
    return pinned.withColumns({"amount": F.col("amount").cast("string"), "ordered_on": F.col("ordered_on").cast("string")})


@plan("""
    SELECT o_orderpriority AS value, count(*) AS n_rows FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1
""")
def category_domain_check(spark, folder):
    return domain_violations(read(spark, folder, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])
