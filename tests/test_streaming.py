import pytest
from conftest import rows

from lakemodels.sinks.materialize import table_properties
from lakemodels.sources.workspace import fresh_dir
from lakemodels.streaming import incremental
from lakemodels.streaming.incremental import stream_incremental

SCHEMA = "k int, v string"


@pytest.fixture()
def landing(spark):
    folder = fresh_dir(spark, "landing")

    def land(*values):
        spark.createDataFrame(list(values), SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    land((1, "a"), (2, "b"))
    return folder, land


def _stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("strategy", ["merge", "delete+insert"])
def test_batches_are_merged(spark, schema, landing, strategy):
    folder, land = landing
    name, checkpoint = f"{schema}.t", fresh_dir(spark, "checkpoint")
    run = lambda: stream_incremental(_stream(spark, folder), name, checkpoint, strategy, "k").awaitTermination()
    run()
    land((2, "b2"), (3, "c"))
    run()
    run()
    assert rows(spark.table(name)) == [(1, "a"), (2, "b2"), (3, "c")]


def test_append_is_the_default_without_a_key(spark, schema, landing):
    folder, land = landing
    name, checkpoint = f"{schema}.t", fresh_dir(spark, "checkpoint")
    land((1, "a"))
    stream_incremental(_stream(spark, folder), name, checkpoint).awaitTermination()
    assert rows(spark.table(name).select("k", "v")) == [(1, "a"), (1, "a"), (2, "b")]
    assert spark.table(name).select("stream_batch").distinct().count() == 2


@pytest.mark.parametrize("strategy, key", [("append", None), ("merge", "k")])
@pytest.mark.parametrize("partition_by", [[], ["k"]])
def test_a_batch_delivered_twice_counts_once(spark, schema, strategy, key, partition_by, monkeypatch):
    """Null keys are inserted by every merge, so a repeated batch would show."""
    batch = spark.createDataFrame([(1, "a"), (None, "n")], SCHEMA)
    name = f"{schema}.t"
    calls = {}

    class Writer:
        def foreachBatch(self, fn):
            calls["fn"] = fn
            return self

        def option(self, *_):
            return self

        def trigger(self, **_):
            return self

        def start(self):
            return None

    class Stream:
        writeStream = Writer()

    options = {} if strategy == "append" else {"partition_by": partition_by}
    stream_incremental(Stream(), name, "/checkpoint", strategy, key, **options)
    for batch_id in (0, 0, 1, 1):
        calls["fn"](batch, batch_id)
    wanted = [(None, "n"), (None, "n"), (1, "a")] if key else [(None, "n"), (None, "n"), (1, "a"), (1, "a")]
    assert rows(spark.table(name).select("k", "v")) == wanted
    if key:
        assert "1" in table_properties(spark, name).values()
    assert incremental._applied(spark, f"{schema}.none", "x") == -1


def test_many_appended_batches_leave_few_files(spark, schema, monkeypatch):
    """50 batches at a fan-in of 4: put together by 4 and by 16, never lost or doubled, also if one is delivered again."""
    import glob

    monkeypatch.setattr(incremental, "FAN_IN", 4)
    name = f"{schema}.t"
    options = {"name": name, "batch_column": "stream_batch", "options": {}}
    deliver = lambda i: incremental._append_batch(
        spark.createDataFrame([(i, "a"), (None, "n")], SCHEMA).coalesce(1), span=incremental.Span("ab", 0, i, i), **options
    )
    for i in range(50):
        deliver(i)
        if i % 7 == 3:
            deliver(i)
    got = rows(incremental.streamed_rows(spark, name))
    assert got == rows(spark.createDataFrame([(i, "a") for i in range(50)] + [(None, "n")] * 50, SCHEMA))
    assert incremental.streamed_rows(spark, name).columns == ["k", "v"]
    folder = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    assert len(glob.glob(f"{folder}/*/*.parquet")) <= 3 * 4
    assert rows(spark.table(name).select("k", "v")) == got


def test_copied_partitions_that_stay_are_not_read_twice(spark, schema, monkeypatch):
    """A failure after the copy and before the drop: readers see every row once, the next batch cleans up."""
    monkeypatch.setattr(incremental, "FAN_IN", 2)
    name = f"{schema}.t"
    deliver = lambda i: incremental._append_batch(
        spark.createDataFrame([(i, "a")], SCHEMA), name, "stream_batch", incremental.Span("ab", 0, i, i), {}
    )
    deliver(0)
    with monkeypatch.context() as broken:
        def fail(spark, name, column, values):
            if values:
                raise OSError("gone")

        broken.setattr(incremental, "drop_partitions", fail)
        with pytest.raises(OSError):
            deliver(1)
    assert spark.table(name).count() == 4
    assert rows(incremental.streamed_rows(spark, name)) == [(0, "a"), (1, "a")]
    deliver(1)
    deliver(2)
    assert rows(incremental.streamed_rows(spark, name)) == [(0, "a"), (1, "a"), (2, "a")]
    assert spark.table(name).count() == 3
