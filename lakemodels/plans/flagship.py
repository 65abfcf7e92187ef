"""The end-to-end query: stage, merge twice, join, aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemodels.operators.relational import join_using, keep, project
from lakemodels.plans.registry import plan, read
from lakemodels.sinks.materialize import write_incremental
from lakemodels.sources.workspace import scratch_schema

_STAGED = "o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice::decimal(12,2) AS amount"
_LOADED = "o_orderdate < TIMESTAMP '1999-01-01 00:00:00'"


@plan("""
    SELECT c_mktsegment AS segment, count(*) AS n_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12,2)) * CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 3 END) AS DOUBLE) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY c_mktsegment
""")
def revenue_per_segment(spark, folder):
    orders = read(spark, folder, "orders")
    name = f"{scratch_schema(spark, 'flagship')}.order_features"
    loaded = project(keep(orders, _LOADED), f"{_STAGED}, amount * 2 AS double_amount")
    write_incremental(loaded, name, "merge", "order_id")
    everything = project(
        orders, f"{_STAGED}, CAST(amount * IF(o_orderstatus = 'F', 2, 3) AS decimal(15,2)) AS double_amount"
    )
    write_incremental(everything, name, "merge", "order_id")
    customers = project(read(spark, folder, "customer"), "c_custkey AS customer_id, c_mktsegment AS segment")
    return (
        join_using(spark.table(name), customers, "customer_id")
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("double_amount").cast("double").alias("revenue"))
    )
