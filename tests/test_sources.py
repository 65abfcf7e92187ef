import pandas as pd
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakemodels.operators.batches import map_batches
from lakemodels.operators.context import ModelContext, run_model, run_sql_model
import synthetic
from lakemodels.sources.scan import jdbc_options, read_ref, read_seed, read_source, ref_key, stage_casts
from lakemodels.sources.volume import LOCAL_LIMITS, VolumeLimits, enforce_volume, relation_bytes, volume_check
from lakemodels.sources.workspace import fresh_dir, shared_dir
from lakemodels.sinks.materialize import write_table


def test_ref_keys():
    assert ref_key("orders") == "orders"
    assert ref_key("shop", "orders", version=2) == "shop.orders.v2"
    for bad in ((), ("a", "b", "c"), ("",), (None,)):
        with pytest.raises(ValueError):
            ref_key(*bad)


def test_refs_and_sources(spark, schema, data):
    write_table(spark.range(3), f"{schema}.ids")
    refs = {"ids": f"{schema}.ids", "shop.orders.v2": f"{data}/orders.parquet", "frame": spark.range(1)}
    assert read_ref(spark, refs, "ids").count() == 3
    assert read_ref(spark, refs, "shop", "orders", version=2).count() == 1500
    assert read_ref(spark, refs, "frame").count() == 1
    with pytest.raises(KeyError, match=r"frame.*ids.*shop\.orders\.v2"):
        read_ref(spark, refs, "nope")
    assert read_source(spark, schema, "ids").count() == 3
    with pytest.raises(KeyError):
        read_source(spark, "raw", "x", {})


def test_seed(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,amount\n1,10.50\n2,200\n")
    staged = stage_casts(read_seed(spark, str(path), "order_id string, amount string"), {"order_id": "bigint", "amount": "decimal(12,2)"})
    assert staged.schema.simpleString() == "struct<order_id:bigint,amount:decimal(12,2)>"
    assert [float(r.amount) for r in staged.orderBy("order_id").collect()] == [10.5, 200.0]


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "t")
    assert plain == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "100000"}
    split = jdbc_options("jdbc:x", "t", "id", ("1", "100"), 8, user="u", password="p")
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8" and split["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partitions=8)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", fetch_size=0)


def test_volume(spark, data):
    lines = spark.read.parquet(f"{data}/lineitem.parquet")
    size = relation_bytes(lines).first().n_bytes
    assert size > 0

    def status(for_batches=False, **limits):
        return volume_check(lines, VolumeLimits(**limits), for_batches).first().status

    n = lines.count()
    assert status() == "ok"
    assert status(max_rows=n, max_bytes=size, warn_rows=n, warn_bytes=size) == "ok"
    assert status(warn_rows=n - 1) == status(warn_bytes=size - 1) == "warn"
    assert status(max_rows=n - 1) == status(max_bytes=size - 1) == "fail"
    assert status(max_rows=n - 1, allow_large_tables=True) == "warn"
    assert status(max_rows=n - 1, chunked_mode=True) == "fail"
    assert status(True, max_rows=n - 1, chunked_mode=True) == "warn"
    with pytest.raises(RuntimeError, match="over its limits"):
        enforce_volume(lines, VolumeLimits(max_rows=1))
    with pytest.warns(UserWarning):
        assert enforce_volume(lines, VolumeLimits(warn_rows=1)) is lines
    assert LOCAL_LIMITS.max_rows == 1_000_000
    for bad in ({"max_rows": -1}, {"warn_bytes": "x"}, {"batch_size": True}):
        with pytest.raises(ValueError):
            VolumeLimits(**bad)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_batches_have_the_asked_size(spark):
    ids = spark.range(0, 10, 1, 1)
    sizes = map_batches(ids, lambda b: pd.DataFrame({"n": [len(b)]}), "n int", batch_size=4)
    assert sorted(r.n for r in sizes.collect()) == [2, 4, 4]
    sizes = map_batches(ids, lambda t: pa.table({"n": pa.array([t.num_rows], pa.int32())}), "n int", 20_000, "arrow")
    assert [r.n for r in sizes.collect()] == [10]


def test_large_batches_join_arrow_batches(spark):
    sizes = map_batches(spark.range(0, 25_000, 1, 1), lambda b: pd.DataFrame({"n": [len(b)]}), "n int", 20_000)
    assert sorted(r.n for r in sizes.collect()) == [5_000, 20_000]


def test_batch_results_are_lined_up_or_rejected(spark):
    two = spark.range(2).withColumn("name", F.lit("x"))
    swapped = map_batches(two, lambda b: b[["name", "id"]], "id bigint, name string")
    assert rows(swapped) == [(0, "x"), (1, "x")]
    for bad in (lambda b: b[["id"]], lambda b: b.assign(other=1)):
        with pytest.raises(Exception, match="differ from the declared schema"):
            map_batches(two, bad, "id bigint, name string").collect()


@pytest.mark.parametrize("size", [0, -1, None, 1.5, True])
def test_bad_batch_sizes(spark, size):
    with pytest.raises(ValueError):
        map_batches(spark.range(1), lambda b: b, "id bigint", size)


def test_unknown_backend(spark):
    with pytest.raises(ValueError):
        map_batches(spark.range(1), lambda b: b, "id bigint", backend="pands")


def test_model_run(spark, schema, data):
    def model(ctx):
        orders = ctx.ref("orders").selectExpr("o_orderkey AS id", "o_totalprice AS amount")
        return orders.where("amount > 400000") if ctx.is_incremental else orders

    context = ModelContext(
        spark, f"{schema}.big", {"orders": f"{data}/orders.parquet"},
        config={"materialized": "incremental", "unique_key": "id", "column_types": {"amount": "numeric(12,2)"}},
    )
    assert not context.is_incremental
    assert run_model(model, context).rows == 1500
    assert context.is_incremental
    assert 0 < run_model(model, context).rows < 1500
    assert spark.table(f"{schema}.big").count() == 1500
    assert spark.table(f"{schema}.big").schema["amount"].dataType.simpleString() == "decimal(12,2)"


def test_models_must_be_functions_that_return_frames(spark, schema):
    context = ModelContext(spark, f"{schema}.x")
    for bad in (None, "model", lambda ctx: None, lambda ctx: [1]):
        with pytest.raises(TypeError):
            run_model(bad, context)


def test_sql_model(spark, schema):
    context = ModelContext(spark, f"{schema}.v", config={"materialized": "view"})
    run_sql_model("SELECT id, id * 2 AS twice FROM {src} WHERE id > 0", context, src=spark.range(3))
    assert rows(spark.table(f"{schema}.v")) == [(1, 2), (2, 4)]


def test_synthetic_rows(spark):
    people = synthetic.customers(spark, 2000)
    low, n = people.agg(F.min("avg_order_value"), F.count("*")).first()
    assert low >= 0 and n == 2000
    busy = people.where("orders_last_90d > 30").count()
    assert 120 < busy < 280
    placed = synthetic.orders(spark, 500)
    assert placed.count() == 505 and placed.where("order_id < 0").count() == 5
    assert rows(placed) == rows(synthetic.orders(spark, 500))


def test_volume_of_derived_frames(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    joined = orders.join(spark.read.parquet(f"{data}/customer.parquet"), orders.o_custkey == F.col("c_custkey"))
    for frame in (joined, orders.groupBy("o_custkey").count(), spark.range(5)):
        check = volume_check(frame, VolumeLimits(max_rows=2, max_bytes=1)).first()
        assert check.n_bytes is None and check.status == "fail" and check.n_rows == frame.count()
        assert relation_bytes(frame).first().n_bytes is None
