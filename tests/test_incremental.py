import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakemodels.operators.merge import (
    align_columns,
    check_unique_columns,
    delete_insert_frames,
    merge_frames,
    normalize_key,
)
from lakemodels.sinks.materialize import (
    dependent_views,
    drop_relation,
    materialize,
    stored_rows,
    table_properties,
    write_incremental,
    write_table,
    write_view,
)
from lakemodels.sources.scan import relation_kind, target_columns

KVN = "k int, v string, n int"
TARGET = [(1, "a", 1), (1, "a2", 2), (2, "b", 3), (None, "n", 4)]
BATCH = [(1, None, 9), (3, "c", 5), (3, "c2", 6), (None, "m", 7)]
MERGED = [(None, "m", 7), (None, "n", 4), (1, None, 9), (1, None, 9), (2, "b", 3), (3, "c", 5), (3, "c2", 6)]
EXCHANGED = [(None, "m", 7), (None, "n", 4), (1, None, 9), (2, "b", 3), (3, "c", 5), (3, "c2", 6)]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(TARGET, KVN)


@pytest.fixture(scope="module")
def batch(spark):
    return spark.createDataFrame(BATCH, KVN)


def test_merge_frames(target, batch):
    assert rows(merge_frames(target, batch, ["k"])) == MERGED


def test_delete_insert_frames(target, batch):
    assert rows(delete_insert_frames(target, batch, ["k"])) == EXCHANGED


def test_twice_is_once_for_unique_keys(spark, target):
    once_batch = spark.createDataFrame([(1, "x", 0), (5, "y", 0)], KVN)
    once = merge_frames(target, once_batch, ["k"])
    assert rows(merge_frames(once, once_batch, ["k"])) == rows(once)
    exchanged = delete_insert_frames(target, once_batch, ["k"])
    assert rows(delete_insert_frames(exchanged, once_batch, ["k"])) == rows(exchanged)


def test_order_by_decides_between_duplicates(spark, target):
    twice = spark.createDataFrame([(2, "old", 1, 10), (2, "new", 2, 5)], KVN + ", version int")
    by_n = merge_frames(target, twice.drop("version"), ["k"], order_by=["n"])
    assert (2, "new", 2) in rows(by_n)
    by_version = merge_frames(target, twice, ["k"], order_by=["version"])
    assert (2, "old", 1) in rows(by_version)
    assert by_version.columns == ["k", "v", "n"]


def _merged_one_by_one(target, batches):
    """Row-by-row reference for batches applied in order: update matches, insert rows of absent keys."""
    state = list(target)
    for batch in batches:
        known = {k for k, _ in state if k is not None}
        best = {}
        for k, v in batch:
            if k is not None:
                best[k] = max(best.get(k, (False, -1)), (v is not None, -1 if v is None else v))
        state = [(k, (best[k][1] if best[k][0] else None) if k in best else v) for k, v in state]
        state += [(k, v) for k, v in batch if k not in known]
    return state


@pytest.mark.parametrize("seed", range(3))
def test_batches_in_one_step_equal_batches_in_a_row(spark, seed):
    draw = random.Random(seed)

    def some(n):
        return [(draw.choice([None, 1, 2, 3, 4, 5, 6]), draw.choice([None, *range(9)])) for _ in range(n)]

    start, batches = some(6), [some(7), some(7), some(7)]
    flat = [(k, v, i) for i, batch in enumerate(batches) for k, v in batch]
    got = merge_frames(
        spark.createDataFrame(start, "k int, v int"),
        spark.createDataFrame(flat, "k int, v int, batch int"),
        ["k"],
        batch_column="batch",
    )
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_merged_one_by_one(start, batches), key=key)


def test_a_third_of_both_sides_share_one_key(spark):
    """Hot and null keys on both sides, every join by shuffle."""
    draw = random.Random(11)
    key_of = lambda i: 1 if i % 3 == 0 else None if i % 7 == 0 else draw.randrange(2, 400)
    start = [(key_of(i), draw.randrange(100)) for i in range(600)]
    batch = [(key_of(i), draw.choice([None, *range(100)])) for i in range(600)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = spark.createDataFrame(start, "k int, v int"), spark.createDataFrame(batch, "k int, v int")
        got = list(map(tuple, merge_frames(*frames, ["k"]).collect()))
        exchanged = list(map(tuple, delete_insert_frames(*frames, ["k"]).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(_merged_one_by_one(start, [batch]), key=key)
    gone = {k for k, _ in batch if k is not None}
    assert sorted(exchanged, key=key) == sorted([r for r in start if r[0] not in gone] + batch, key=key)


def test_all_columns_in_the_key_only_insert(spark):
    have = spark.createDataFrame([(1, 1), (1, 1)], "a int, b int")
    new = spark.createDataFrame([(1, 1), (2, 2), (2, 2)], "a int, b int")
    assert rows(merge_frames(have, new, ["a", "b"])) == [(1, 1), (1, 1), (2, 2), (2, 2)]


def test_merge_plan_has_no_python_and_folds_the_batch_first(target, batch):
    plan = merge_frames(target, batch, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "partial_max(" in plan


def test_align_columns(spark):
    frame = spark.createDataFrame([(1, 2)], "b int, a int")
    assert align_columns(frame, ["a", "b"]).first() == (2, 1)
    with pytest.raises(ValueError, match="missing.*'c'.*new.*'b'"):
        align_columns(frame, ["a", "c"])


def test_columns_must_be_unique_and_present(spark):
    for names in ([], ["a", "a"], ["A", "a"]):
        with pytest.raises(ValueError):
            check_unique_columns(names)


@pytest.mark.parametrize("given, wanted", [(None, None), ("a", ["a"]), (["a"], ["a"]), (("a", "b"), ["a", "b"]), ([], None)])
def test_normalize_key(given, wanted):
    assert normalize_key(given) == wanted


def test_normalize_key_rejects_others():
    with pytest.raises(TypeError):
        normalize_key({"a": 1})


@pytest.mark.parametrize("partition_by", [[], ["k"]])
@pytest.mark.parametrize("strategy, wanted", [("merge", MERGED), ("delete+insert", EXCHANGED), ("append", TARGET + BATCH)])
def test_strategies_on_tables(spark, schema, target, batch, strategy, wanted, partition_by):
    name = f"{schema}.t"
    assert write_incremental(target, name, strategy, "k", partition_by=partition_by).rows == 4
    assert write_incremental(batch, name, strategy, "k").rows == 4
    got = rows(spark.table(name).select("k", "v", "n"))
    assert got == sorted(wanted, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_only_touched_partitions_are_rewritten(spark, schema, target):
    name = f"{schema}.t"
    write_table(target, name, partition_by=["k"])
    files = lambda: {r.f for r in spark.table(name).where("k = 2").select(F.col("_metadata.file_path").alias("f")).collect()}
    before = files()
    write_incremental(spark.createDataFrame([(1, "z", 0)], KVN), name, "merge", "k")
    spark.catalog.refreshTable(name)
    assert files() == before
    assert rows(spark.table(name).where("k = 1").select("v")) == [("z",), ("z",)]


@pytest.mark.parametrize("listed", [5_000, 1])
def test_two_partition_columns(spark, schema, monkeypatch, listed):
    """With values as literals, and past their bound with a semi join."""
    monkeypatch.setattr("lakemodels.sinks.materialize._LISTED_PARTITIONS", listed)
    ddl, name = "a int, b string, id int, v int", f"{schema}.t"
    have = [(1, "x", 1, 0), (1, "y", 2, 0), (2, "x", 3, 0), (2, "y", 4, 0), (None, "x", 5, 0), (1, None, 6, 0)]
    write_table(spark.createDataFrame(have, ddl), name, partition_by=["a", "b"])
    new = [(1, "y", 2, 9), (2, "x", 7, 9), (None, "x", 5, 9)]
    write_incremental(spark.createDataFrame(new, ddl), name, "merge", ["id", "a", "b"])
    wanted = [(1, "x", 1, 0), (1, "y", 2, 9), (2, "x", 3, 0), (2, "y", 4, 0), (None, "x", 5, 0), (1, None, 6, 0),
              (2, "x", 7, 9), (None, "x", 5, 9)]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(spark.table(name).select("a", "b", "id", "v")) == sorted(wanted, key=key)


def test_touched_partitions_are_pruned_at_the_scan(spark, schema, target, batch):
    from lakemodels.sinks.materialize import _touched

    write_table(target, f"{schema}.t", partition_by=["k"])
    plan = _touched(spark.table(f"{schema}.t"), batch, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "k#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_default_strategy(spark, schema, target, batch):
    write_incremental(target, f"{schema}.a")
    write_incremental(batch, f"{schema}.a")
    assert spark.table(f"{schema}.a").count() == 8
    write_incremental(target, f"{schema}.m", unique_key="k")
    write_incremental(batch, f"{schema}.m", unique_key="k")
    assert rows(spark.table(f"{schema}.m")) == MERGED


def test_arguments_are_checked_before_any_change(spark, schema, target, batch):
    name = f"{schema}.t"
    with pytest.raises(ValueError):
        write_incremental(target, name, "upsert")
    with pytest.raises(ValueError):
        write_incremental(target, name, on_schema_change="maybe")
    with pytest.raises(ValueError):
        materialize(target, name, "snapshot")
    assert relation_kind(spark, name) is None
    write_table(target, name)
    extra = batch.withColumn("x", F.lit(1))
    for key in (None, "nope"):
        with pytest.raises(ValueError):
            write_incremental(extra, name, "merge", key, "append_new_columns")
    assert [c for c, _ in target_columns(spark, name)] == ["k", "v", "n"]


def test_first_run_creates_the_table_from_an_empty_frame(spark, schema):
    empty = spark.createDataFrame([], "id bigint, name string")
    assert write_incremental(empty, f"{schema}.t", "merge").rows == 0
    assert target_columns(spark, f"{schema}.t") == [("id", "bigint"), ("name", "string")]


def test_empty_later_batch_changes_nothing(spark, schema, target):
    write_table(target, f"{schema}.t")
    empty = target.where("false").withColumn("x", F.lit(1))
    for mode in ("ignore", "fail", "append_new_columns", "sync_all_columns"):
        assert write_incremental(empty, f"{schema}.t", "merge", "k", mode).rows == 0
    assert spark.table(f"{schema}.t").columns == ["k", "v", "n"]


def test_drift_is_refused(spark, schema):
    have = spark.createDataFrame([(1, "a")], "id bigint, name string")
    new = spark.createDataFrame([(1, 3)], "id bigint, extra int")
    name = f"{schema}.t"
    write_table(have, name)
    with pytest.raises(ValueError, match="missing.*name.*new.*extra"):
        write_incremental(new, name, "append")
    with pytest.raises(ValueError, match="drift"):
        write_incremental(new, name, "append", on_schema_change="fail")
    with pytest.raises(ValueError, match="missing"):
        write_incremental(new, name, "append", on_schema_change="append_new_columns")
    assert rows(spark.table(name)) == [(1, "a")]


@pytest.mark.parametrize("strategy", ["append", "merge", "delete+insert"])
@pytest.mark.parametrize("partition_by", [[], ["id"]])
def test_append_new_columns(spark, schema, strategy, partition_by):
    name = f"{schema}.t"
    write_table(spark.createDataFrame([(0, "z")], "id bigint, name string"), name, partition_by=partition_by)
    new = spark.createDataFrame([(1, "a", 3.14)], "id bigint, name string, new_col double")
    write_incremental(new, name, strategy, "id", "append_new_columns")
    assert rows(spark.table(name).select("id", "name", "new_col")) == [(0, "z", None), (1, "a", 3.14)]


@pytest.mark.parametrize("strategy", ["append", "merge", "delete+insert"])
def test_sync_all_columns_and_a_stale_pin(spark, schema, strategy):
    name = f"{schema}.t"
    write_table(spark.createDataFrame([(0, "z")], "id bigint, old_col string"), name)
    new = spark.createDataFrame([(1, "x")], "id bigint, new_col string")
    write_incremental(new, name, strategy, "id", "sync_all_columns", column_types={"old_col": "text", "new_col": "text"})
    assert rows(spark.table(name)) == [(0, None), (1, "x")]
    assert spark.table(name).columns == ["id", "new_col"]


def test_dropping_columns_respects_dependent_views(spark, schema):
    name = f"{schema}.t"
    write_table(spark.createDataFrame([(0, "z")], "id bigint, name string"), name)
    spark.sql(f"CREATE VIEW {schema}.reader AS SELECT name FROM {schema}.t")
    assert dependent_views(spark, name) == [f"{schema}.reader"]
    slim = spark.createDataFrame([(1,)], "id bigint")
    with pytest.raises(ValueError, match="reader"):
        write_incremental(slim, name, "append", on_schema_change="sync_all_columns")
    assert spark.table(name).columns == ["id", "name"]
    write_incremental(slim, name, "append", on_schema_change="sync_all_columns", cascade=True)
    assert rows(spark.table(name)) == [(0,), (1,)]
    assert relation_kind(spark, f"{schema}.reader") is None


def test_full_refresh_rebuilds(spark, schema, target):
    write_table(target, f"{schema}.t")
    fresh = spark.createDataFrame([(7, 1.5)], "id int, x double")
    write_incremental(fresh, f"{schema}.t", "merge", "id", full_refresh=True)
    assert rows(spark.table(f"{schema}.t")) == [(7, 1.5)]


def test_a_table_can_be_rebuilt_from_itself(spark, schema, target):
    write_table(target, f"{schema}.t")
    write_table(spark.table(f"{schema}.t").where("k = 1"), f"{schema}.t")
    assert rows(spark.table(f"{schema}.t")) == [(1, "a", 1), (1, "a2", 2)]


def test_a_failing_write_keeps_the_old_table(spark, schema, target, batch):
    name = f"{schema}.t"
    write_table(target, name)
    bad = batch.withColumn("n", F.when(F.col("k") == 3, F.raise_error(F.lit("boom"))).otherwise(F.col("n")).cast("int"))
    for write in (lambda: write_table(bad, name), lambda: write_incremental(bad, name, "merge", "k")):
        with pytest.raises(Exception, match="boom"):
            write()
        assert rows(spark.table(name)) == sorted(TARGET, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert {t.name for t in spark.catalog.listTables(schema)} == {"t"}


def test_view_is_replaced_and_its_old_data_dropped(spark, schema):
    name = f"{schema}.v"
    write_view(spark.createDataFrame([(1,), (2,)], "id bigint"), name)
    assert relation_kind(spark, name) == "view"
    write_view(spark.table(name).where("id = 2"), name)
    assert rows(spark.table(name)) == [(2,)]
    assert len(spark.catalog.listTables(schema)) == 2
    drop_relation(spark, name)
    assert not spark.catalog.listTables(schema)


def test_another_kind_of_relation_is_replaced(spark, schema, target):
    name = f"{schema}.x"
    write_view(target, name)
    write_table(target, name)
    assert relation_kind(spark, name) == "table"
    write_view(target, name)
    assert relation_kind(spark, name) == "view"
    write_incremental(target, name, "append")
    assert relation_kind(spark, name) == "table"
    assert len(spark.catalog.listTables(schema)) == 1


def test_nan_is_stored_as_null_and_empty_text_stays(spark, schema):
    frame = spark.createDataFrame([(1, float("nan"), "")], "id int, x double, t string")
    write_table(frame.withColumn("nothing", F.lit(None)), f"{schema}.t")
    assert rows(spark.table(f"{schema}.t")) == [(1, None, "", None)]
    assert dict(target_columns(spark, f"{schema}.t"))["nothing"] == "string"


def test_ambiguous_join_output_fails_before_the_write(spark, schema, target, batch):
    with pytest.raises(ValueError, match="Ambiguous"):
        write_table(target.join(batch, "k"), f"{schema}.t")
    assert relation_kind(spark, f"{schema}.t") is None


def test_json_and_boolean_columns_keep_their_parsing(spark, schema):
    name = f"{schema}.t"
    first = spark.createDataFrame([(1, '{"a": 1}', "yes")], "id int, doc string, flag string")
    write_incremental(first, name, "merge", "id", column_types={"doc": "jsonb", "flag": "boolean"})
    write_incremental(spark.createDataFrame([(2, "plain", "off")], first.schema), name, "merge", "id")
    got = spark.table(name).select("id", F.to_json("doc"), "flag").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, '{"a":1}', True), (2, '"plain"', False)]


def test_foreign_files_are_left_alone(spark, schema, target, tmp_path):
    folder = str(tmp_path / "theirs")
    target.write.parquet(folder)
    spark.sql(f"CREATE TABLE {schema}.t USING parquet LOCATION '{folder}'")
    write_table(spark.range(2), f"{schema}.t")
    assert spark.read.parquet(folder).count() == len(TARGET)
    assert spark.table(f"{schema}.t").count() == 2


def test_dependents_are_resolved_not_guessed(spark, schema):
    name, other = f"{schema}.orders", f"{schema}_views"
    write_table(spark.createDataFrame([(0, "z")], "id bigint, name string"), name)
    spark.sql(f"CREATE SCHEMA {other}")
    spark.sql(f"CREATE VIEW {schema}.unrelated AS SELECT 1 AS orders")
    spark.sql(f"CREATE VIEW {other}.far AS SELECT name FROM {name}")
    spark.sql(f"CREATE VIEW {other}.farther AS SELECT * FROM {other}.far")
    assert sorted(dependent_views(spark, name)) == [f"{other}.far", f"{other}.farther"]
    slim = spark.createDataFrame([(1,)], "id bigint")
    bad = slim.withColumn("id", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception, match="boom"):
        write_incremental(bad, name, "append", on_schema_change="sync_all_columns", cascade=True)
    assert relation_kind(spark, f"{other}.far") == "view"
    write_incremental(slim, name, "append", on_schema_change="sync_all_columns", cascade=True)
    assert relation_kind(spark, f"{other}.far") is None and relation_kind(spark, f"{schema}.unrelated") == "view"
    spark.sql(f"DROP SCHEMA {other}")


def test_only_views_that_name_the_table_are_resolved(spark, schema, monkeypatch):
    from lakemodels.sinks import materialize as sink

    name, resolved, read = f"{schema}.orders", [], sink._relations_read
    monkeypatch.setattr(sink, "_relations_read", lambda session, view: resolved.append(view) or read(session, view))
    write_table(spark.range(3), name)
    for k in range(8):
        write_view(spark.table(name), f"{schema}.orders_view_{k}")
    spark.sql(f"CREATE VIEW {schema}.apart AS SELECT 1 AS one")
    spark.sql(f"CREATE VIEW {schema}.words AS SELECT 'orders' AS word")
    spark.sql(f"CREATE VIEW {schema}.`oddly` AS SELECT * FROM {schema}.`ORDERS`")
    spark.sql(f"CREATE VIEW {schema}.above AS SELECT * FROM {schema}.`oddly`")
    spark.sql(f"CREATE VIEW {schema}.on_own AS SELECT * FROM {schema}.orders_view_1")
    assert sorted(dependent_views(spark, name)) == [f"{schema}.above", f"{schema}.oddly"]
    assert not [v for v in resolved if "orders_view_" in v or v.endswith("apart")]
    backing = next(t.name for t in spark.catalog.listTables(schema) if t.name.startswith("orders_view_1__data_"))
    assert sorted(dependent_views(spark, f"{schema}.{backing}")) == [f"{schema}.on_own", f"{schema}.orders_view_1"]


@pytest.mark.parametrize("kind", ["table", "view"])
def test_a_failing_swap_gives_the_old_name_back(spark, schema, target, monkeypatch, kind):
    from lakemodels.sinks import materialize as sink

    name = f"{schema}.t"
    (write_table if kind == "table" else write_view)(target, name)
    rename = sink._rename

    def failing(session, old, new):
        if new == name and "__stage_" in old:
            raise RuntimeError("no rename")
        rename(session, old, new)

    monkeypatch.setattr(sink, "_rename", failing)
    with pytest.raises(RuntimeError, match="no rename"):
        write_table(spark.range(3), name)
    assert relation_kind(spark, name) == kind and spark.table(name).count() == len(TARGET)
    assert not [t.name for t in spark.catalog.listTables(schema) if "__stage_" in t.name or "__old_" in t.name]


def test_predicate_and_batches_exclude_each_other(spark, target, batch):
    with pytest.raises(ValueError, match="predicate"):
        merge_frames(target, batch, ["k"], predicate="n > 1", batch_column="n")
    with pytest.raises(ValueError, match="predicate"):
        delete_insert_frames(target, batch, ["k"], predicate="n > 1", batch_column="n")


def test_keys_are_found_in_any_case(target, batch):
    assert rows(merge_frames(target, batch, ["K"])) == MERGED


def _files(spark, name, condition="true"):
    spark.catalog.refreshTable(name)
    return {r.f for r in spark.table(name).where(condition).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}


def _sorted(expected):
    return sorted(expected, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("partition_by", [[], ["k"]])
@pytest.mark.parametrize("strategy, wanted", [("merge", MERGED), ("delete+insert", EXCHANGED), ("append", TARGET + BATCH)])
def test_strategies_on_bucketed_tables(spark, schema, target, batch, strategy, wanted, partition_by):
    name = f"{schema}.t"
    write_incremental(target, name, strategy, "k", partition_by=partition_by, buckets=3)
    write_incremental(batch, name, strategy, "K")
    got = stored_rows(spark, name)
    assert set(got.columns) == {"k", "v", "n"} and rows(got.select("k", "v", "n")) == _sorted(wanted)
    write_incremental(batch.limit(0), name, strategy, "k")
    assert spark.table(name).count() == len(wanted)


@pytest.mark.parametrize("strategy", ["merge", "delete+insert"])
def test_untouched_buckets_keep_their_files(spark, schema, strategy):
    name = f"{schema}.t"
    start = [(k, f"v{k}", k) for k in range(200)] + [(None, f"n{k}", k) for k in range(60)]
    write_incremental(spark.createDataFrame(start, KVN), name, strategy, "k", buckets=16)
    assert spark.table(name).where("k IS NULL").select("__lm_bucket").distinct().count() > 8  # null keys are spread
    bucket = spark.table(name).where("k = 5").first()["__lm_bucket"]
    before, touched = _files(spark, name), _files(spark, name, f"__lm_bucket = {bucket}")
    write_incremental(spark.createDataFrame([(5, "new", 0)], KVN), name, strategy, "k")
    after = _files(spark, name)
    assert before - after == touched and len(after - before) >= 1 and len(before & after) >= 14
    wanted = [(5, "new", 0) if r[0] == 5 else r for r in start]
    assert rows(stored_rows(spark, name)) == _sorted(wanted)


def test_bucketed_merges_equal_plain_ones(spark, schema):
    draw = random.Random(4)
    some = lambda n: [(draw.choice([None, *range(40)]), draw.choice("abc"), draw.randrange(9)) for _ in range(n)]
    steps = [some(60), some(10), some(3), some(30)]
    for kind, options in (("plain", {}), ("bucketed", {"buckets": 7})):
        for step in steps:
            write_incremental(spark.createDataFrame(step, KVN), f"{schema}.{kind}", "merge", "k", order_by=["n"], **options)
    assert rows(stored_rows(spark, f"{schema}.bucketed")) == rows(spark.table(f"{schema}.plain"))


def test_buckets_are_kept_added_and_changed(spark, schema, target, batch):
    name = f"{schema}.t"
    write_incremental(target, name, "merge", "k")
    write_incremental(batch, name, "merge", "k", buckets=4)  # an existing table gets them by a rebuild
    assert rows(stored_rows(spark, name)) == MERGED and "__lm_bucket" in spark.table(name).columns
    more = spark.createDataFrame([(1, "a", 1, 2.5)], KVN + ", x double")
    write_incremental(more, name, "merge", "k", on_schema_change="append_new_columns")
    assert rows(stored_rows(spark, name).where("k = 1").select("k", "v", "n", "x")) == [(1, "a", 1, 2.5)] * 2
    write_incremental(spark.createDataFrame([(2, "b", 2)], "k bigint, v string, n int").withColumn("x", F.lit(0.5)), name, "merge", "k", widen=True)
    assert dict(spark.table(name).dtypes)["k"] == "bigint"
    write_incremental(spark.createDataFrame([(2, "c", 2, 1.5)], "k bigint, v string, n int, x double"), name, "merge", "k")
    assert rows(stored_rows(spark, name).where("k = 2").select("k", "v", "n", "x")) == [(2, "c", 2, 1.5)]
    no_key = spark.createDataFrame([("z", 1, 1.0)], "v string, n int, x double")
    write_incremental(no_key, name, "append", on_schema_change="sync_all_columns")
    assert spark.table(name).columns == ["v", "n", "x"]
    with pytest.raises(ValueError, match="unique_key"):
        write_incremental(target, name, "append", buckets=2)


DATED = "day string, id int, v int"


@pytest.mark.parametrize("strategy", ["merge", "delete+insert"])
def test_a_predicate_spares_partitions(spark, schema, strategy):
    """Only partitions with a row that the predicate accepts, or that batch rows go to, are read and written."""
    name = f"{schema}.t"
    have = [(f"d{k % 5}", k, k) for k in range(50)] + [(None, 99, 1)]
    write_table(spark.createDataFrame(have, DATED), name, partition_by=["day"])
    before = {day: _files(spark, name, f"day = '{day}'") for day in ("d0", "d1", "d2", "d3", "d4")}
    new = [("d1", 1, -1), ("d1", 6, -6), ("d2", 2, -2), ("d3", 500, -5), (None, None, 7)]
    predicate = "day IN ('d1', 'd2') AND v < 20"
    write_incremental(spark.createDataFrame(new, DATED), name, strategy, "id", predicate=predicate)
    changed = {1: -1, 6: -6, 2: -2}
    wanted = [(d, i, changed.get(i, v)) for d, i, v in have] + [("d3", 500, -5), (None, None, 7)]
    assert rows(spark.table(name).select("day", "id", "v")) == _sorted(wanted)
    after = {day: _files(spark, name, f"day = '{day}'") for day in before}
    assert {day for day in before if before[day] == after[day]} == {"d0", "d4"}


@pytest.mark.parametrize("strategy", ["merge", "delete+insert"])
def test_a_row_that_moves_leaves_its_partition(spark, schema, strategy):
    name = f"{schema}.t"
    write_table(spark.createDataFrame([("d1", 1, 1), ("d2", 2, 2)], DATED), name, partition_by=["day"])
    write_incremental(spark.createDataFrame([("d9", 1, 5)], DATED), name, strategy, "id", predicate="day = 'd1'")
    assert rows(spark.table(name).select("day", "id", "v")) == [("d2", 2, 2), ("d9", 1, 5)]


def test_predicate_prunes_the_scan(spark, schema):
    from lakemodels.sinks.materialize import _touched

    name = f"{schema}.t"
    write_table(spark.createDataFrame([(f"d{k % 5}", k, k) for k in range(50)], DATED), name, partition_by=["day"])
    table = spark.table(name)
    places = table.where("day = 'd1' AND v < 20").select("day")
    assert "d1" in places._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    plan = _touched(table, places, ["day"])._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "d1" in filters and "d2" not in filters


def test_readers_never_miss_a_table_that_is_rebuilt(spark, schema):
    import threading

    name = f"{schema}.t"
    write_table(spark.range(10).withColumn("round", F.lit(0)), name)
    misses, seen, done = [], set(), threading.Event()

    def poll():
        while not done.is_set():
            try:
                found = spark.table(name).groupBy("round").count().collect()
                assert [r["count"] for r in found] == [10]
                seen.add(found[0]["round"])
            except Exception as error:  # noqa: BLE001
                misses.append(str(error)[:300])

    reader = threading.Thread(target=poll)
    reader.start()
    try:
        for k in range(1, 51):
            write_table(spark.range(10).withColumn("round", F.lit(k)), name)
    finally:
        done.set()
        reader.join()
    assert not misses and len(seen) > 5 and spark.table(name).first()["round"] == 50


def test_rebuilds_in_place_keep_one_former_version(spark, schema):
    import os

    name = f"{schema}.t"
    base = spark.catalog.getDatabase(schema).locationUri.removeprefix("file:")
    write_table(spark.range(3), name)
    for k in range(3):
        write_table(spark.range(3 + k).withColumn("more", F.lit(k)), name)  # a column is added, then kept
    assert spark.table(name).count() == 5 and spark.table(name).columns == ["id", "more"]
    assert len([f for f in os.listdir(base) if f.startswith("t__")]) == 2
    write_table(spark.range(3).select(F.col("id").cast("string")), name)  # another type: by renaming
    assert spark.table(name).dtypes == [("id", "string")]
    drop_relation(spark, name)
    assert not [f for f in os.listdir(base) if f.startswith("t")]


def test_properties_appear_with_the_new_folder(spark, schema, monkeypatch):
    from lakemodels.sinks import materialize as sink

    name = f"{schema}.t"
    write_table(spark.range(1), name)
    point = sink._point_at
    monkeypatch.setattr(sink, "_point_at", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        write_table(spark.range(2), name, properties={"lakemodels.x": "it's \\ 1"})
    assert "lakemodels.x" not in table_properties(spark, name) and spark.table(name).count() == 1

    def dies_after(session, table, folder):
        point(session, table, folder)
        raise KeyboardInterrupt

    monkeypatch.setattr(sink, "_point_at", dies_after)
    with pytest.raises(KeyboardInterrupt):
        write_table(spark.range(2), name, properties={"lakemodels.x": "it's \\ 1"})
    spark.catalog.refreshTable(name)
    assert table_properties(spark, name)["lakemodels.x"] == "it's \\ 1" and spark.table(name).count() == 2
