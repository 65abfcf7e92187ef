"""Table, view and incremental materializations, written and read back.

The loaded state is the orders up to 1998. The batch is what changed since:
later orders, and earlier ones that were still open, all repriced.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemodels.operators.batches import map_batches
from lakemodels.operators.merge import align_columns
from lakemodels.operators.relational import keep, project
from lakemodels.plans.registry import path, plan, read
from lakemodels.sinks.materialize import stored_rows, write_incremental, write_table, write_view
from lakemodels.sources.workspace import fresh_dir, scratch_schema
from lakemodels.streaming.incremental import stream_incremental, streamed_rows

_COLUMNS = "o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS amount"
_LOADED = "o_orderdate < TIMESTAMP '1999-01-01 00:00:00'"
_CHANGED = "o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' OR o_orderstatus <> 'F'"
_REPRICED = _COLUMNS.replace("o_totalprice AS", "o_totalprice * 1.5 AS")

_T = f"t AS (SELECT {_COLUMNS} FROM orders WHERE {_LOADED})"
_S = f"s AS (SELECT {_REPRICED} FROM orders WHERE {_CHANGED})"


def _loaded(spark, folder, columns=_COLUMNS):
    return project(keep(read(spark, folder, "orders"), _LOADED), columns)


def _changed(spark, folder, columns=_REPRICED):
    return project(keep(read(spark, folder, "orders"), _CHANGED), columns)


def _target(spark, frame, label, **options):
    name = f"{scratch_schema(spark, label)}.orders"
    write_table(frame, name, **options)
    return name


_SUPPLIER_SALES = """
    SELECT l_suppkey AS supplier_id, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1
"""


def _supplier_sales(spark, folder):
    lines = read(spark, folder, "lineitem")
    return lines.groupBy(F.col("l_suppkey").alias("supplier_id")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )


@plan(_SUPPLIER_SALES)
def mat_table(spark, folder):
    name = f"{scratch_schema(spark, 'table')}.supplier_sales"
    write_table(_supplier_sales(spark, folder), name, {"supplier_id": "bigint", "n_lines": "bigint"})
    return spark.table(name)


@plan("SELECT o_orderkey AS order_id, o_totalprice AS amount, o_totalprice * 2 AS double_amount FROM orders")
def mat_table_batched(spark, folder):
    name = f"{scratch_schema(spark, 'batched')}.orders"
    orders = project(read(spark, folder, "orders"), "o_orderkey AS order_id, o_totalprice AS amount")
    doubled = map_batches(
        orders,
        lambda batch: batch.assign(double_amount=batch["amount"] * 2)[["double_amount", "order_id", "amount"]],
        "order_id bigint, amount double, double_amount double",
        batch_size=20_000,
    )
    write_table(doubled, name)
    return spark.table(name)


@plan(_SUPPLIER_SALES)
def mat_view(spark, folder):
    name = f"{scratch_schema(spark, 'view')}.supplier_sales"
    sales = _supplier_sales(spark, folder)
    write_view(sales.withColumn("n_lines", F.lit(0).cast("bigint")), name)
    write_view(sales, name)
    return spark.table(name)


@plan(f"WITH {_T}, {_S} SELECT * FROM t UNION ALL SELECT * FROM s")
def inc_append(spark, folder):
    name = _target(spark, _loaded(spark, folder), "append")
    write_incremental(_changed(spark, folder), name, "append")
    return spark.table(name)


_MERGED = f"""
    WITH {_T}, {_S}
    SELECT order_id,
           CASE WHEN s.order_id IS NULL THEN t.customer_id ELSE s.customer_id END AS customer_id,
           CASE WHEN s.order_id IS NULL THEN t.status ELSE s.status END AS status,
           CASE WHEN s.order_id IS NULL THEN t.amount ELSE s.amount END AS amount
    FROM t LEFT JOIN s USING (order_id)
    UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = s.order_id)
"""


@plan(_MERGED)
def inc_merge(spark, folder):
    name = _target(spark, _loaded(spark, folder), "merge")
    write_incremental(_changed(spark, folder), name, "merge", "order_id")
    return spark.table(name)


@plan(_MERGED)
def inc_default_strategy(spark, folder):
    name = _target(spark, _loaded(spark, folder), "default")
    write_incremental(_changed(spark, folder), name, unique_key=["order_id"])
    return spark.table(name)


@plan(_MERGED)
def inc_merge_partitioned(spark, folder):
    """Only the status partitions that the batch touches are rewritten; an order never changes status here."""
    name = _target(spark, _loaded(spark, folder), "partitioned", partition_by=["status"])
    write_incremental(_changed(spark, folder), name, "merge", ["status", "order_id"])
    return spark.table(name)


@plan(_MERGED)
def inc_merge_widen(spark, folder):
    narrow = _loaded(spark, folder).withColumn("customer_id", F.col("customer_id").cast("int"))
    name = _target(spark, narrow, "widen")
    write_incremental(_changed(spark, folder), name, "merge", "order_id", widen=True)
    return spark.table(name)


_PAIRS = "SELECT l_partkey AS part_id, l_suppkey AS supplier_id, sum(l_quantity) AS quantity, count(*) AS n_lines FROM lineitem"
_PAIRS_LOADED = "l_shipdate < TIMESTAMP '1999-01-01 00:00:00'"
_PAIRS_CHANGED = "l_shipdate >= TIMESTAMP '1999-01-01 00:00:00' OR l_returnflag = 'R'"


@plan(f"""
    WITH t AS ({_PAIRS} WHERE {_PAIRS_LOADED} GROUP BY 1, 2), s AS ({_PAIRS} WHERE {_PAIRS_CHANGED} GROUP BY 1, 2)
    SELECT part_id, supplier_id, coalesce(s.quantity, t.quantity) AS quantity, coalesce(s.n_lines, t.n_lines) AS n_lines
    FROM t FULL JOIN s USING (part_id, supplier_id)
""")
def inc_merge_composite_key(spark, folder):
    def pairs(condition):
        lines = keep(read(spark, folder, "lineitem"), condition)
        return lines.groupBy(F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id")).agg(
            F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n_lines")
        )

    name = _target(spark, pairs(_PAIRS_LOADED), "composite")
    write_incremental(pairs(_PAIRS_CHANGED), name, "merge", ["part_id", "supplier_id"])
    return spark.table(name)


_PLACED = "o_custkey AS customer_id, o_orderpriority AS priority"


@plan(f"""
    WITH t AS (SELECT {_PLACED} FROM orders WHERE {_LOADED}), s AS (SELECT {_PLACED} FROM orders WHERE {_CHANGED})
    SELECT * FROM t UNION ALL SELECT * FROM s
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.customer_id = s.customer_id AND t.priority = s.priority)
""")
def inc_merge_keys_only(spark, folder):
    name = _target(spark, _loaded(spark, folder, _PLACED), "keys")
    write_incremental(_changed(spark, folder, _PLACED), name, "merge", ["customer_id", "priority"])
    return spark.table(name)


_NULL_KEY = "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS order_id, o_custkey AS customer_id"


@plan(f"""
    WITH t AS (SELECT {_NULL_KEY}, o_totalprice AS amount FROM orders WHERE {_LOADED}),
         s AS (SELECT {_NULL_KEY}, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * 1.5 END AS amount
               FROM orders WHERE {_CHANGED})
    SELECT t.order_id, t.customer_id, CASE WHEN s.order_id IS NULL THEN t.amount ELSE s.amount END AS amount
    FROM t LEFT JOIN s ON t.order_id = s.order_id
    UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = s.order_id)
""")
def inc_merge_null_key(spark, folder):
    """Null keys are inserted again; a null amount in the batch overwrites."""
    name = _target(spark, _loaded(spark, folder, f"{_NULL_KEY}, o_totalprice AS amount"), "nulls")
    batch = f"{_NULL_KEY}, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * 1.5 END AS amount"
    write_incremental(_changed(spark, folder, batch), name, "merge", "order_id")
    return spark.table(name)


_TWO_VERSIONS = f"""
    v AS (SELECT {_COLUMNS}, 1 AS version FROM orders WHERE {_CHANGED}
          UNION ALL SELECT {_REPRICED}, 2 AS version FROM orders WHERE {_CHANGED})
"""


def _two_versions(spark, folder):
    first = _changed(spark, folder, f"{_COLUMNS}, 1 AS version")
    return first.unionByName(_changed(spark, folder, f"{_REPRICED}, 2 AS version"))


@plan(f"""
    WITH {_T}, {_S}, {_TWO_VERSIONS}
    SELECT t.order_id, t.customer_id, t.status, coalesce(s.amount, t.amount) AS amount
    FROM t LEFT JOIN s ON t.order_id = s.order_id
    UNION ALL SELECT order_id, customer_id, status, amount FROM v
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = v.order_id)
""")
def inc_merge_duplicate_source(spark, folder):
    """Two batch rows per key: the later version updates, both are inserted where the key is new."""
    name = _target(spark, _loaded(spark, folder), "duplicates")
    write_incremental(_two_versions(spark, folder), name, "merge", "order_id", order_by=["version"])
    return spark.table(name)


@plan(f"""
    WITH {_T}, {_S}, open AS (SELECT * FROM t WHERE status = 'O')
    SELECT t.order_id, t.customer_id, t.status,
           CASE WHEN t.status = 'O' AND s.order_id IS NOT NULL THEN s.amount ELSE t.amount END AS amount
    FROM t LEFT JOIN s ON t.order_id = s.order_id
    UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM open WHERE open.order_id = s.order_id)
""")
def inc_merge_predicate(spark, folder):
    """Only open orders of the target may match."""
    name = _target(spark, _loaded(spark, folder), "predicate")
    write_incremental(_changed(spark, folder), name, "merge", "order_id", predicate="status = 'O'")
    return spark.table(name)


@plan(_MERGED)
def inc_merge_bucketed(spark, folder):
    """The key is no partition column of the user; the writer finds the touched rows by a hash of it."""
    name = f"{scratch_schema(spark, 'bucketed')}.orders"
    write_incremental(_loaded(spark, folder), name, "merge", "order_id", buckets=8)
    write_incremental(_changed(spark, folder), name, "merge", "order_id")
    return stored_rows(spark, name)


@plan(f"""
    WITH {_T}, {_S}
    SELECT t.order_id, t.customer_id, t.status,
           CASE WHEN t.status IN ('O', 'P') AND t.amount > 50000 AND s.order_id IS NOT NULL THEN s.amount ELSE t.amount END AS amount
    FROM t LEFT JOIN s ON t.order_id = s.order_id
    UNION ALL SELECT * FROM s WHERE NOT EXISTS (
        SELECT 1 FROM t WHERE t.order_id = s.order_id AND t.status IN ('O', 'P') AND t.amount > 50000)
""")
def inc_merge_predicate_pruned(spark, folder):
    """Status is a partition column outside of the key; partitions the predicate excludes are neither read nor written."""
    name = _target(spark, _loaded(spark, folder), "pruned", partition_by=["status"])
    write_incremental(_changed(spark, folder), name, "merge", "order_id", predicate="status IN ('O', 'P') AND amount > 50000")
    return spark.table(name)


@plan(f"""
    WITH {_T}, {_TWO_VERSIONS}
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.order_id = t.order_id)
    UNION ALL SELECT order_id, customer_id, status, amount FROM v
""")
def inc_delete_insert(spark, folder):
    """The whole batch is inserted, both versions of each order."""
    name = _target(spark, _loaded(spark, folder), "exchange")
    write_incremental(_two_versions(spark, folder).drop("version"), name, "delete+insert", "order_id")
    return spark.table(name)


@plan(f"SELECT {_COLUMNS} FROM orders")
def inc_first_run(spark, folder):
    name = f"{scratch_schema(spark, 'first')}.orders"
    write_incremental(project(read(spark, folder, "orders"), _COLUMNS), name, "merge", "order_id")
    return spark.table(name)


@plan(f"SELECT {_COLUMNS} FROM orders")
def inc_empty_batch(spark, folder):
    orders = project(read(spark, folder, "orders"), _COLUMNS)
    name = _target(spark, orders, "empty")
    write_incremental(keep(orders, "amount < 0").withColumn("unknown", F.lit(1)), name, "merge", "order_id")
    return spark.table(name)


@plan(f"WITH {_S} SELECT * FROM s")
def inc_full_refresh(spark, folder):
    name = _target(spark, _loaded(spark, folder, "o_orderkey AS order_id"), "refresh")
    write_incremental(_changed(spark, folder), name, "merge", "order_id", full_refresh=True)
    return spark.table(name)


# Three batches in a row: everything changed, then urgent orders at twice the price, then open ones at half.
_BATCHES = f"""
    b AS (SELECT {_REPRICED}, 1 AS batch FROM orders WHERE {_CHANGED}
          UNION ALL SELECT {_COLUMNS.replace('o_totalprice AS', 'o_totalprice * 2 AS')}, 2 AS batch
          FROM orders WHERE o_orderpriority = '1-URGENT'
          UNION ALL SELECT {_COLUMNS.replace('o_totalprice AS', 'o_totalprice * 0.5 AS')}, 3 AS batch
          FROM orders WHERE o_orderstatus = 'O')
"""


def _batches(spark, folder):
    orders = read(spark, folder, "orders")
    second = project(
        keep(orders, "o_orderpriority = '1-URGENT'"),
        _COLUMNS.replace("o_totalprice AS", "o_totalprice * 2 AS") + ", 2 AS batch",
    )
    third = project(
        keep(orders, "o_orderstatus = 'O'"), _COLUMNS.replace("o_totalprice AS", "o_totalprice * 0.5 AS") + ", 3 AS batch"
    )
    return _changed(spark, folder, f"{_REPRICED}, 1 AS batch").unionByName(second).unionByName(third)


@plan(f"WITH {_T}, {_BATCHES} SELECT * FROM t UNION ALL SELECT order_id, customer_id, status, amount FROM b")
def inc_chunked_append(spark, folder):
    name = _target(spark, _loaded(spark, folder), "chunked")
    write_incremental(_batches(spark, folder), name, "append", batch_column="batch")
    return spark.table(name)


_LAST_OF_BATCHES = f"""
    WITH {_T}, {_BATCHES}, w AS (SELECT * FROM b QUALIFY batch = max(batch) OVER (PARTITION BY order_id))
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.order_id = t.order_id)
    UNION ALL SELECT order_id, customer_id, status, amount FROM w
"""


@plan(_LAST_OF_BATCHES)
def inc_chunked_merge(spark, folder):
    name = _target(spark, _loaded(spark, folder), "chunked")
    write_incremental(_batches(spark, folder), name, "merge", "order_id", batch_column="batch")
    return spark.table(name)


@plan(_LAST_OF_BATCHES)
def inc_chunked_delete_insert(spark, folder):
    name = _target(spark, _loaded(spark, folder), "chunked")
    write_incremental(_batches(spark, folder), name, "delete+insert", "order_id", batch_column="batch")
    return spark.table(name)


@plan(f"""
    WITH {_T}, s AS (SELECT {_REPRICED}, o_orderpriority AS priority FROM orders WHERE {_CHANGED})
    SELECT t.order_id, t.customer_id, t.status, coalesce(s.amount, t.amount) AS amount, s.priority
    FROM t LEFT JOIN s ON t.order_id = s.order_id
    UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = s.order_id)
""")
def schema_append_new(spark, folder):
    name = _target(spark, _loaded(spark, folder), "drift")
    batch = _changed(spark, folder, f"{_REPRICED}, o_orderpriority AS priority")
    write_incremental(batch, name, "merge", "order_id", "append_new_columns")
    return spark.table(name)


@plan(f"""
    WITH {_T}, s AS (SELECT {_REPRICED}, o_orderpriority AS priority FROM orders WHERE {_CHANGED})
    SELECT t.order_id, t.customer_id, coalesce(s.amount, t.amount) AS amount, s.priority
    FROM t LEFT JOIN s ON t.order_id = s.order_id
    UNION ALL SELECT order_id, customer_id, amount, priority FROM s
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = s.order_id)
""")
def schema_sync_all(spark, folder):
    name = _target(spark, _loaded(spark, folder), "drift")
    batch = _changed(spark, folder, f"{_REPRICED}, o_orderpriority AS priority").drop("status")
    write_incremental(batch, name, "merge", "order_id", "sync_all_columns")
    return spark.table(name)


@plan(f"SELECT {_COLUMNS} FROM orders", name="align_columns")
def aligned_orders(spark, folder):
    orders = read(spark, folder, "orders").select(
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
    )
    return align_columns(orders, ["order_id", "customer_id", "status", "amount"])


def _order_stream(spark, folder):
    # As a pattern the path may be a folder or a single file.
    source = path(folder, "order[s]")
    return spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)


@plan(_MERGED)
def stream_merge(spark, folder):
    name = _target(spark, _loaded(spark, folder), "stream")
    stream = _order_stream(spark, folder).where(_CHANGED).selectExpr(*_REPRICED.split(", "))
    stream_incremental(stream, name, fresh_dir(spark, "stream"), "merge", "order_id").awaitTermination()
    return spark.table(name)


@plan(f"WITH {_S} SELECT * FROM s")
def stream_append(spark, folder):
    name = f"{scratch_schema(spark, 'stream')}.orders"
    stream = _order_stream(spark, folder).where(_CHANGED).selectExpr(*_REPRICED.split(", "))
    stream_incremental(stream, name, fresh_dir(spark, "stream"), "append").awaitTermination()
    return streamed_rows(spark, name)
