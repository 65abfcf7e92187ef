"""What publishing and typing promise, as queries: refused drift, kept tables, counted rows, types by value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemodels.functions import infer
from lakemodels.functions.scalars import load_timestamp
from lakemodels.functions.types import pin_types
from lakemodels.operators.context import ModelContext, run_model
from lakemodels.operators.relational import join_using, project
from lakemodels.plans.registry import plan, read
from lakemodels.sinks.materialize import write_incremental, write_table, write_view
from lakemodels.sources.scan import relation_kind, target_columns
from lakemodels.sources.volume import VolumeLimits, volume_check
from lakemodels.sources.workspace import scratch_schema

_COLUMNS = "o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status"


def _orders(spark, folder) -> DataFrame:
    return project(read(spark, folder, "orders"), _COLUMNS)


def _published(spark, folder, label: str) -> str:
    name = f"{scratch_schema(spark, label)}.orders"
    write_table(_orders(spark, folder), name)
    return name


def _refused(write) -> bool:
    try:
        write()
    except ValueError:
        return True
    return False


def _after_refusals(spark, name: str, *writes) -> DataFrame:
    """The table after writes that must all be refused."""
    refused = [_refused(write) for write in writes]
    return spark.table(name).withColumn("refused", F.lit(sum(refused)))


@plan(f"SELECT {_COLUMNS}, 2 AS refused FROM orders")
def drift_refused(spark, folder):
    """Added and dropped columns under the modes that forbid them leave the table as it was."""
    name = _published(spark, folder, "drift")
    more = _orders(spark, folder).withColumn("extra", F.lit(1))
    return _after_refusals(
        spark,
        name,
        lambda: write_incremental(more, name, "append", on_schema_change="fail"),
        lambda: write_incremental(more.drop("status"), name, "append", on_schema_change="ignore"),
    )


@plan(f"SELECT {_COLUMNS}, 4 AS refused FROM orders")
def unknown_modes_refused(spark, folder):
    """Unknown strategies and modes, keys that are not there and ambiguous names are refused before the first job."""
    name = _published(spark, folder, "modes")
    rows = _orders(spark, folder)
    return _after_refusals(
        spark,
        name,
        lambda: write_incremental(rows, name, "upsert", "order_id"),
        lambda: write_incremental(rows, name, "append", on_schema_change="perhaps"),
        lambda: write_incremental(rows, name, "merge", "no_such_key"),
        lambda: write_incremental(rows.select("*", F.lit("?").alias("STATUS")), name, "append"),
    )


@plan("SELECT o_orderkey AS order_id, o_custkey AS customer_id, 1 AS n_views FROM orders")
def drop_cascade(spark, folder):
    """Dropping a column with cascade drops the view that reads it, not the one that only has its name in the text."""
    name = _published(spark, folder, "cascade")
    schema = name.split(".")[0]
    spark.sql(f"CREATE VIEW {schema}.reader AS SELECT status FROM {name}")
    spark.sql(f"CREATE VIEW {schema}.unrelated AS SELECT 1 AS orders")
    slim = _orders(spark, folder).drop("status")
    write_incremental(slim, name, "merge", "order_id", on_schema_change="sync_all_columns", cascade=True)
    views = spark.sql(f"SHOW VIEWS IN {schema}").count()
    return spark.table(name).withColumn("n_views", F.lit(views))


@plan(f"SELECT {_COLUMNS}, 'table' AS kind FROM orders")
def replace_other_kind(spark, folder):
    """A table takes the place of a view of that name."""
    name = f"{scratch_schema(spark, 'kind')}.orders"
    write_view(_orders(spark, folder).limit(1), name)
    write_table(_orders(spark, folder), name)
    return spark.table(name).withColumn("kind", F.lit(relation_kind(spark, name)))


@plan(f"SELECT {_COLUMNS} FROM orders")
def publish_failure_keeps_table(spark, folder):
    """A model that fails on its last rows leaves the published table as it was."""
    name = _published(spark, folder, "failure")
    most = read(spark, folder, "orders").agg(F.max("o_orderkey")).first()[0]
    broken = _orders(spark, folder).withColumn(
        "status", F.when(F.col("order_id") == most, F.raise_error(F.lit("no status"))).otherwise(F.col("status")).cast("string")
    )
    for write in (lambda: write_table(broken, name), lambda: write_incremental(broken, name, "merge", "order_id")):
        try:
            write()
        except Exception as error:  # noqa: BLE001  Spark reports a failed task by several classes
            if "no status" not in str(error):
                raise
    return spark.table(name)


@plan("SELECT count(*) AS written, count(*) FILTER (o_orderstatus = 'F') AS merged FROM orders")
def rows_written(spark, folder):
    """The rows a model handed over, as the writers count them."""
    name = f"{scratch_schema(spark, 'counted')}.orders"
    written = write_table(_orders(spark, folder), name)
    merged = write_incremental(_orders(spark, folder).where("status = 'F'"), name, "merge", "ORDER_ID")
    return spark.createDataFrame([(written.rows, merged.rows)], "written bigint, merged bigint")


@plan("""
    SELECT o_orderkey AS order_id, c_name AS customer, o_totalprice * 2 AS double_amount
    FROM orders JOIN customer ON c_custkey = o_custkey
""")
def model_run(spark, folder):
    """A model function over two upstream relations, published through its context."""

    def model(context: ModelContext) -> DataFrame:
        orders = project(context.ref("orders"), "o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount")
        customers = project(context.ref("customers"), "c_custkey AS customer_id, c_name AS customer")
        joined = join_using(orders, customers, "customer_id")
        return joined.select("order_id", "customer", (F.col("amount") * 2).alias("double_amount"))

    name = f"{scratch_schema(spark, 'model')}.features"
    refs = {"orders": read(spark, folder, "orders"), "customers": read(spark, folder, "customer")}
    run_model(model, ModelContext(spark, name, refs=refs, config={"materialized": "table"}))
    return spark.table(name)


@plan("""
    SELECT column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'double precision'
        WHEN 'VARCHAR' THEN 'text' ELSE 'timestamp' END AS inferred_type
    FROM (SELECT column_name, column_type AS data_type FROM (DESCRIBE SELECT * FROM orders))
""")
def infer_schema_types(spark, folder):
    """Database types of a published table, from its schema alone."""
    name = f"{scratch_schema(spark, 'types')}.orders"
    write_table(read(spark, folder, "orders"), name)
    found = infer.infer_types(spark.table(name))
    return spark.createDataFrame([(c, found[c]) for c, _ in target_columns(spark, name)], "column_name string, inferred_type string")


@plan("""
    SELECT * FROM (VALUES ('day', 'date'), ('never', 'text'), ('big', 'numeric'), ('key', 'bigint')) AS t(column_name, inferred_type)
    WHERE (SELECT count(*) FROM orders) > 0
""")
def infer_text_dates(spark, folder):
    """Every value is tried: one impossible day makes a column text, one digit too many makes it numeric."""
    orders = read(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-'31'").alias("never"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit("0000000000000000000")).alias("big"),
        F.col("o_orderkey").cast("string").alias("key"),
    )
    return infer.infer_text_columns(orders, orders.columns).select("column_name", "inferred_type")


@plan("""
    SELECT * FROM (VALUES ('whole', 'bigint[]'), ('fractions', 'double precision[]'), ('both', 'jsonb'), ('broken', 'jsonb')) AS t(column_name, inferred_type)
    WHERE (SELECT count(*) FROM orders) > 0
""")
def infer_array_numbers(spark, folder):
    """Whole numbers are one kind, numbers with a fraction another; a text that is no list is neither."""
    whole, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    orders = read(spark, folder, "orders").select(
        F.concat(F.lit("["), whole, F.lit("]")).alias("whole"),
        F.concat(F.lit("["), price, F.lit("]")).alias("fractions"),
        F.concat(F.lit("["), whole, F.lit(","), price, F.lit("]")).alias("both"),
        F.concat(F.lit("["), whole).alias("broken"),
    )
    return infer.infer_json_arrays(orders, orders.columns)


@plan("""
    SELECT event_id, '"[' || event_id || '] ' || event_type || '"' AS noted, '[' || event_id || ']' AS listed,
           '"{\\"k\\":1,\\"k\\":' || event_id || '}"' AS repeated
    FROM events
""")
def pin_json_trailing_text(spark, folder):
    """Text behind a JSON list, and a key that is there twice, are kept: as text, which a variant can hold."""
    event = F.col("event_id").cast("string")
    events = read(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("["), event, F.lit("] "), "event_type").alias("noted"),
        F.concat(F.lit("["), event, F.lit("]")).alias("listed"),
        F.concat(F.lit('{"k":1,"k":'), event, F.lit("}")).alias("repeated"),
    )
    pinned = pin_types(events, dict.fromkeys(["noted", "listed", "repeated"], "jsonb"))
    return pinned.select("event_id", *[F.to_json(c).alias(c) for c in ("noted", "listed", "repeated")])


@plan("SELECT o_orderkey AS order_id, o_orderpriority || repeat(' ', 15 - length(o_orderpriority)) AS priority FROM orders")
def pin_varchar_length(spark, folder):
    """Blanks beyond the length of a character type are cut; anything else there would fail the job."""
    orders = project(read(spark, folder, "orders"), "o_orderkey AS order_id, rpad(o_orderpriority, 40, ' ') AS priority")
    return pin_types(orders, {"priority": "varchar(15)"})


@plan("""
    SELECT count(*) AS n_rows, CAST(NULL AS BIGINT) AS n_bytes, CASE WHEN count(*) > 100 THEN 'warn' ELSE 'ok' END AS status
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def volume_gate_joined(spark, folder):
    """The size of a join is unknown; its rows decide."""
    lines, orders = read(spark, folder, "lineitem"), read(spark, folder, "orders")
    joined = lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return volume_check(joined, VolumeLimits(warn_rows=100, max_bytes=1))


@plan("SELECT count(*) AS n_rows, 1 AS n_times FROM orders")
def loaded_at(spark, folder):
    """One load has one load time."""
    stamped = _orders(spark, folder).withColumn("at", load_timestamp())
    recent = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.max("at"))) < 3600
    return stamped.agg(F.count("*").alias("n_rows"), (F.count_distinct("at") * recent.cast("int")).cast("int").alias("n_times"))
