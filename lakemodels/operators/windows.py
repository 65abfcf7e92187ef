"""Ranks and running sums whose groups may be arbitrarily large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemodels.operators.relational import col


# Spark's own bound on limits it pushes below the shuffle of a window; parts of a group beyond it.
GROUP_LIMIT = 1000
SHARES = 64


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group, numbered from 1.

    Up to ``GROUP_LIMIT`` Spark turns this filter into a group limit before the
    shuffle, so a hot group sends at most ``n`` rows per map task to the task
    that ranks it. For a larger ``n`` it has no such step: there every group is
    first ranked in ``SHARES`` parts, of which only the first ``n`` rows each
    go on. The choice hangs on the argument, not on the data.
    """
    window = Window.partitionBy(*map(col, group)).orderBy(*order)
    if n > GROUP_LIMIT:
        # Any even spread will do: the second rank puts the parts together again.
        parted = df.withColumn("__share", F.pmod(F.xxhash64(*map(col, df.columns)), F.lit(SHARES)))
        part = Window.partitionBy(*map(col, group), "__share").orderBy(*order)
        df = parted.withColumn(rank, F.row_number().over(part)).where(F.col(rank) <= n).drop("__share", rank)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


# Rows per slice of the sample that places the bounds between slices.
SAMPLE_PER_SLICE = 64
MOST_SLICES = 256


def running_sum(
    df: DataFrame,
    value: Column,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    name: str = "running_sum",
    slices: int | None = None,
) -> DataFrame:
    """Sum of ``value`` over all rows up to this one, by group or over the whole frame.

    ``order_by`` must order the rows of a group uniquely. No task holds a whole
    group: rows fall into slices by group and order, are summed
    inside their slice, and shifted by the total of the group's earlier
    slices. Only the first group of a slice can have earlier slices, so there
    are at most as many shifts as slices, and they are safe to broadcast.

    The bounds between slices are taken first, from a bounded sample of the keys, and stand as literals in the plan.
    So nothing has to be kept to make both uses of them agree: the rows are shuffled once, and
    the totals are a second scan of keys and values that adds up before its small shuffle. The frame is
    evaluated for each (freeze it first where it is dear, or not repeatable).

    Sum decimals or integers where exact results are needed.
    """
    slices = min(MOST_SLICES, slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    groups = [col(c) for c in partition_by]
    order = [col(c) for c in order_by]
    keys = [*partition_by, *order_by]

    valued = df.withColumn("__value", value)
    sliced = valued.withColumn("__slice", _slice_of(keys, _slice_bounds(df, keys, slices)))
    totals = sliced.groupBy("__slice", *groups).agg(F.sum("__value").alias("__total"))
    earlier = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        totals.withColumn("__shift", F.sum("__total").over(earlier))
        .where(F.col("__shift").isNotNull())
        .select(
            F.col("__slice").alias("__at"),
            "__shift",
            *[g.alias(f"__group{i}") for i, g in enumerate(groups)],
        )
    )
    here = F.col("__slice") == F.col("__at")
    for i, group in enumerate(groups):
        here = here & group.eqNullSafe(F.col(f"__group{i}"))
    within = Window.partitionBy("__slice", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("__within", F.sum("__value").over(within))
        .join(F.broadcast(shifts), here, "left")
        .withColumn(
            name,
            F.when(F.col("__shift").isNull(), F.col("__within")).otherwise(
                F.col("__shift") + F.coalesce(F.col("__within"), F.lit(0))
            ),
        )
        .select(*map(col, df.columns), name)
    )


def _slice_bounds(df: DataFrame, keys: Sequence[str], slices: int) -> list[tuple[Column, ...]]:
    """At most ``slices`` - 1 keys as literals, that cut a sample into equal parts.

    The sample holds the keys with the smallest hashes, ``SAMPLE_PER_SLICE`` for every slice, whatever the number of rows.
    Any bounds give right sums; these make slices alike in size.
    """
    if slices < 2:
        return []
    plain = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(keys)])
    names = plain.columns
    digest = F.xxhash64(*names)
    sample = plain.orderBy(digest, *names).limit(SAMPLE_PER_SLICE * slices).orderBy(*names).collect()
    step = max(1, len(sample) // slices)
    rows = list(dict.fromkeys(tuple(r) for r in sample[step::step]))[: slices - 1]
    kinds = [f.dataType for f in plain.schema.fields]
    return [tuple(F.lit(v).cast(kind) for v, kind in zip(row, kinds, strict=True)) for row in rows]


def _slice_of(keys: Sequence[str], bounds: list[tuple[Column, ...]]) -> Column:
    """How many bounds are not above a row's keys, by bisection; the order is that of a sort, nulls first."""

    def reaches(bound: tuple[Column, ...]) -> Column:
        own, out = [col(c) for c in keys], F.lit(True)
        for mine, given in reversed(list(zip(own, bound, strict=True))):
            above = F.coalesce(mine > given, mine.isNotNull() & given.isNull())
            out = above | (mine.eqNullSafe(given) & out)
        return out

    def between(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last) // 2
        return F.when(reaches(bounds[middle]), between(middle + 1, last)).otherwise(between(first, middle))

    return between(0, len(bounds))
