"""Scans, projections, filters, joins, unions and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemodels.functions.scalars import bucket
from lakemodels.operators.batches import map_batches
from lakemodels.operators.relational import anti_join, join_using, keep, project, semi_join, union_all
from lakemodels.plans.registry import path, plan, read
from lakemodels.sources.scan import read_ref, read_seed, read_source, stage_casts
from lakemodels.sources.volume import VolumeLimits, row_count, volume_check
from lakemodels.sources.workspace import fresh_dir


@plan("SELECT * FROM orders")
def ref_scan(spark, folder):
    return read_ref(spark, {"orders": path(folder, "orders")}, "orders")


@plan("SELECT * FROM lineitem")
def source_scan(spark, folder):
    return read_source(spark, "raw", "lineitem", {"raw.lineitem": path(folder, "lineitem")})


@plan("SELECT count(*) AS n_rows FROM lineitem WHERE l_quantity > 25")
def relation_row_count(spark, folder):
    lines = read(spark, folder, "lineitem")
    return row_count(project(keep(lines, "l_quantity > 25"), "l_orderkey, l_quantity"))


@plan("""
    SELECT count(*) AS n_rows,
           CASE WHEN count(*) > 1000000 THEN 'fail' WHEN count(*) > 50000 THEN 'warn' ELSE 'ok' END AS status
    FROM lineitem
""")
def volume_gate(spark, folder):
    limits = VolumeLimits(max_rows=1_000_000, warn_rows=50_000, max_bytes=512 * 1024**4)
    return volume_check(read(spark, folder, "lineitem"), limits).drop("n_bytes")


@plan("""
    SELECT o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS ordered_on,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount
    FROM orders
""")
def seed_csv_staging(spark, folder):
    seed = fresh_dir(spark, "seed")
    orders = read(spark, folder, "orders")
    orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("ordered_on"),
        F.col("o_totalprice").alias("amount"),
    ).write.csv(seed, header=True)
    raw = read_seed(spark, seed, "order_id string, ordered_on date, amount string")
    staged = stage_casts(raw, {"order_id": "bigint", "ordered_on": "string", "amount": "decimal(12,2)"})
    return staged.withColumn("amount", F.col("amount").cast("double"))


@plan("""
    SELECT o_orderkey AS order_id, o_totalprice AS amount, o_totalprice * 2 AS double_amount,
           o_totalprice * 2 - o_totalprice AS delta
    FROM orders
""")
def sql_model_delta(spark, folder):
    features = read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_totalprice") * 2).alias("double_amount"),
    )
    return spark.sql(
        "SELECT order_id, amount, double_amount, double_amount - amount AS delta FROM {customer_features}",
        customer_features=features,
    )


@plan("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_projection(spark, folder):
    return project(read(spark, folder, "orders"), "o_orderkey, o_custkey, o_totalprice")


@plan("""
    SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer, strftime(o_orderdate, '%Y-%m-%d') AS ordered_on,
           o_totalprice > 250000 AS is_large
    FROM orders
""")
def select_cast_alias(spark, folder):
    return project(
        read(spark, folder, "orders"),
        "o_orderkey AS order_id, o_custkey::string AS customer, o_orderdate::date::string AS ordered_on, "
        "o_totalprice > 250000 AS is_large",
    )


@plan("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def select_distinct(spark, folder):
    return project(read(spark, folder, "orders"), "DISTINCT o_orderstatus, o_orderpriority")


@plan("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'O'")
def where_filter(spark, folder):
    return keep(read(spark, folder, "orders"), "o_totalprice > 250000 AND o_orderstatus = 'O'").select(
        "o_orderkey", "o_totalprice"
    )


@plan("""
    SELECT o_orderkey AS order_id, amount, c_mktsegment AS segment
    FROM (SELECT o_orderkey, o_custkey, o_totalprice AS amount FROM orders) o
    JOIN customer ON c_custkey = o_custkey
    WHERE amount > 200000 AND c_acctbal > 0
""")
def select_where_chain(spark, folder):
    orders = project(read(spark, folder, "orders"), "o_orderkey, o_custkey AS custkey, o_totalprice AS amount")
    customers = project(keep(read(spark, folder, "customer"), "c_acctbal > 0"), "c_custkey AS custkey, c_mktsegment")
    joined = join_using(keep(orders, "amount > 200000"), customers, "custkey")
    return project(joined, "o_orderkey AS order_id, amount, c_mktsegment AS segment")


@plan("SELECT o_orderkey AS order_id, o_totalprice AS amount, o_totalprice * 2 AS double_amount FROM orders")
def double_amount(spark, folder):
    orders = project(read(spark, folder, "orders"), "o_orderkey AS order_id, o_totalprice AS amount")
    return orders.withColumns({"double_amount": F.col("amount") * 2})


_BUCKETS = """
    SELECT o_orderkey AS order_id, o_totalprice AS amount,
           CASE WHEN o_totalprice >= 250000 THEN 'high' ELSE 'standard' END AS amount_bucket
    FROM orders
"""


@plan(_BUCKETS)
def amount_bucket(spark, folder):
    orders = project(read(spark, folder, "orders"), "o_orderkey AS order_id, o_totalprice AS amount")
    return orders.withColumn("amount_bucket", bucket(F.col("amount"), 250_000))


@plan(_BUCKETS)
def batch_bucket(spark, folder):
    orders = project(read(spark, folder, "orders"), "o_orderkey AS order_id, o_totalprice AS amount")

    def with_bucket(batch):
        return batch.assign(amount_bucket=(batch["amount"] >= 250_000).map({True: "high", False: "standard"}))

    return map_batches(orders, with_bucket, "order_id bigint, amount double, amount_bucket string", 50_000)


@plan("SELECT o_orderkey AS order_id, o_totalprice AS amount, o_totalprice * 2 AS double_amount FROM orders")
def batch_arrow_double(spark, folder):
    import pyarrow.compute as pc

    orders = project(read(spark, folder, "orders"), "o_orderkey AS order_id, o_totalprice AS amount")

    def doubled(table):
        return table.append_column("double_amount", pc.multiply(table["amount"], 2.0))

    return map_batches(
        orders, doubled, "order_id bigint, amount double, double_amount double", 50_000, backend="arrow"
    )


@plan("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def top_k_orders(spark, folder):
    orders = keep(read(spark, folder, "orders"), "o_orderstatus = 'O'")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_custkey", "o_totalprice")


def _orders(spark, folder):
    return project(read(spark, folder, "orders"), "o_custkey AS custkey, o_orderkey, o_totalprice")


def _customers(spark, folder):
    return project(read(spark, folder, "customer"), "c_custkey AS custkey, c_name, c_acctbal")


@plan("""
    SELECT c_custkey AS custkey, o_orderkey, o_totalprice, c_name, c_acctbal
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def join_inner(spark, folder):
    return join_using(_orders(spark, folder), _customers(spark, folder), "custkey")


@plan("""
    SELECT o_custkey AS custkey, o_orderkey, o_totalprice, c_name, c_acctbal
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 2000) c ON o_custkey = c_custkey
""")
def join_left(spark, folder):
    rich = keep(_customers(spark, folder), "c_acctbal > 2000")
    return join_using(_orders(spark, folder), rich, ["custkey"], "left outer")


@plan("""
    SELECT c_custkey AS custkey, o_orderkey, o_totalprice, c_name, c_acctbal
    FROM (SELECT * FROM orders WHERE o_totalprice > 400000) o RIGHT JOIN customer ON o_custkey = c_custkey
""")
def join_right(spark, folder):
    large = keep(_orders(spark, folder), "o_totalprice > 400000")
    return join_using(large, _customers(spark, folder), ["custkey"], "right", split_outer=True)


@plan("""
    SELECT coalesce(o_custkey, c_custkey) AS custkey, o_orderkey, o_totalprice, c_name, c_acctbal
    FROM (SELECT * FROM orders WHERE o_totalprice > 400000) o
    FULL JOIN (SELECT * FROM customer WHERE c_acctbal > 2000) c ON o_custkey = c_custkey
""")
def join_full(spark, folder):
    large = keep(_orders(spark, folder), "o_totalprice > 400000")
    rich = keep(_customers(spark, folder), "c_acctbal > 2000")
    return join_using(large, rich, "custkey", "full outer")


@plan("SELECT c_custkey, r_regionkey, r_name FROM customer CROSS JOIN region")
def join_cross(spark, folder):
    return join_using(
        read(spark, folder, "customer").select("c_custkey"), read(spark, folder, "region"), None, "cross"
    )


@plan("""
    SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, pair_quantity, pair_lines
    FROM lineitem JOIN (
        SELECT l_partkey, l_suppkey, sum(l_quantity) AS pair_quantity, count(*) AS pair_lines
        FROM lineitem GROUP BY ALL
    ) p USING (l_partkey, l_suppkey)
""")
def join_multi_key(spark, folder):
    lines = read(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    pairs = lines.groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("pair_quantity"), F.count(F.lit(1)).alias("pair_lines")
    )
    return join_using(lines, pairs, ["l_partkey", "l_suppkey"])


@plan("""
    SELECT c_custkey AS custkey, c_name, c_acctbal FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
""", name="anti_join")
def customers_without_large_order(spark, folder):
    return anti_join(_customers(spark, folder), keep(_orders(spark, folder), "o_totalprice > 300000"), "custkey")


@plan("""
    SELECT c_custkey AS custkey, c_name, c_acctbal FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
""", name="semi_join")
def customers_with_large_order(spark, folder):
    return semi_join(_customers(spark, folder), keep(_orders(spark, folder), "o_totalprice > 300000"), "custkey")


@plan("""
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
""", name="union_all")
def union_of_contacts(spark, folder):
    customers = project(read(spark, folder, "customer"), "c_custkey AS id, c_name AS name, c_nationkey AS nationkey")
    suppliers = project(read(spark, folder, "supplier"), "s_nationkey AS nationkey, s_suppkey AS id, s_name AS name")
    return union_all(customers, suppliers)
