import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemodels.operators.relational import anti_join, join_using, keep, project, semi_join, union_all
from lakemodels.operators.windows import running_sum, top_per_group


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [(1, 10, 100, 5.0), (2, 10, 101, 150.0), (3, 20, 102, None), (4, None, 103, 7.0)],
        "id bigint, customer_id bigint, order_id bigint, amount double",
    )


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([(10, "ann"), (30, "bob"), (None, "nobody")], "customer_id bigint, name string")


def test_project_takes_any_select_list(orders):
    assert project(orders, "id, amount::int AS whole").columns == ["id", "whole"]
    assert project(orders, "DISTINCT customer_id").count() == 3
    assert project(orders, "count(*) AS n, sum(amount) AS total").first() == (4, 162.0)
    assert project(orders, "'{x}' AS braces").first().braces == "{x}"


@pytest.mark.parametrize("text", ["", "   ", None, "id; drop table x"])
def test_empty_text_and_semicolons_are_rejected(orders, text):
    with pytest.raises(ValueError):
        project(orders, text)
    with pytest.raises(ValueError):
        keep(orders, text)


def test_keep_drops_false_and_unknown(orders):
    assert [r.id for r in keep(orders, "amount > 6").orderBy("id").collect()] == [2, 4]


def test_chaining_reaches_the_scan(spark, data):
    lines = spark.read.parquet(f"{data}/lineitem.parquet")
    chained = keep(project(lines, "l_orderkey, l_quantity AS q, l_tax"), "q > 49").select("l_orderkey")
    plan = chained._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,49.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_join_keeps_one_key_column_first(orders, customers):
    joined = join_using(orders, customers, "customer_id")
    assert joined.columns == ["customer_id", "id", "order_id", "amount", "name"]
    assert joined.count() == 2


@pytest.mark.parametrize(
    "how, n", [("left", 4), ("left outer", 4), ("RIGHT", 4), ("right outer", 4), ("full", 6), ("full outer", 6)]
)
def test_outer_joins(orders, customers, how, n):
    assert join_using(orders, customers, ["customer_id"], how).count() == n


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join_by_parts_equals_the_plain_one(orders, customers, how):
    plain = orders.join(customers, ["customer_id"], how)
    parts = join_using(orders, customers, "customer_id", how, split_outer=True)
    assert parts.columns == plain.columns
    assert rows(parts) == rows(plain)


def test_cross_join(orders, customers):
    assert join_using(orders, customers, how="cross").count() == 12
    with pytest.raises(ValueError):
        join_using(orders, customers, "customer_id", "cross")


@pytest.mark.parametrize("on", [None, "", [], [" "], 5, "nope", 'a"b', "a;b"])
def test_join_needs_known_keys(orders, customers, on):
    with pytest.raises(ValueError):
        join_using(orders, customers, on)


def test_join_rejects_unknown_types_and_other_objects(orders, customers):
    with pytest.raises(ValueError):
        join_using(orders, customers, "customer_id", "sideways")
    with pytest.raises(TypeError):
        join_using(orders, [1], "customer_id")


def test_semi_and_anti_split_the_left_side(orders, customers):
    assert rows(semi_join(orders, customers, "customer_id").select("id")) == [(1,), (2,)]
    assert rows(anti_join(orders, customers, "customer_id").select("id")) == [(3,), (4,)]


def test_union_is_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id int")
    assert rows(union_all(a, b)) == [(1, "x"), (2, "y")]


def test_running_sum_over_a_hot_group(spark):
    """One group holds most rows and spans many slices."""
    frame = spark.range(500).select(
        F.col("id"), F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 < 9, "b").alias("g")
    )
    got = {r.id: r.s for r in running_sum(frame, F.col("id"), ["id"], ["g"], "s", slices=16).collect()}
    totals, wanted = {}, {}
    for r in sorted(frame.collect(), key=lambda r: r.id):
        totals[r.g] = totals.get(r.g, 0) + r.id
        wanted[r.id] = totals[r.g]
    assert got == wanted


@pytest.mark.parametrize("slices", [1, 2, 7, 64])
def test_running_sum_by_several_keys_with_nulls_and_ties(spark, slices):
    import random

    draw = random.Random(slices)
    have = [(draw.choice([None, "a", "b"]), draw.choice([None, 1.5, float("nan"), -2.0]), i, draw.randrange(9)) for i in range(400)]
    frame = spark.createDataFrame(have, "g string, x double, id int, v int").repartition(5)
    got = running_sum(frame, F.col("v"), ["x", "id"], ["g"], "s", slices).collect()
    plain = frame.withColumn("s", F.sum("v").over(Window.partitionBy("g").orderBy("x", "id").rowsBetween(Window.unboundedPreceding, 0)))
    assert {r.id: r.s for r in got} == {r.id: r.s for r in plain.collect()} and len(got) == 400
    assert running_sum(frame.limit(0), F.col("v"), ["id"], slices=slices).count() == 0


def test_running_sum_shuffles_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(2000).selectExpr("id", "id % 7 AS v", "cast(id AS string) AS payload").write.parquet(path)
    summed = running_sum(spark.read.parquet(path), F.col("v"), ["id"], slices=4)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    shuffles = [i for i, line in enumerate(lines) if " Exchange " in line]
    whole = [i for i in shuffles if not any("HashAggregate" in line for line in lines[i + 1 : i + 4])]
    assert len(whole) == 1 and "ExistingRDD" not in plan and "rangepartitioning" not in plan
    # The second scan, for the totals, reads key and value only.
    schemas = [line.split("ReadSchema: ")[1] for line in lines if "ReadSchema" in line]
    assert sorted("payload" in s for s in schemas) == [False, True]


def test_running_sum_skips_nulls(spark):
    frame = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 2)], "id int, v int")
    got = running_sum(frame, F.col("v"), ["id"], slices=4).orderBy("id").collect()
    assert [r.running_sum for r in got] == [None, 5, 5, 7]


def test_top_per_group_limits_before_the_shuffle(spark):
    frame = spark.range(1000).withColumn("g", F.col("id") % 3)
    top = top_per_group(frame, ["g"], [F.desc("id")], 2)
    assert rows(top.select("id", "rank")) == [(994, 2), (995, 2), (996, 2), (997, 1), (998, 1), (999, 1)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
