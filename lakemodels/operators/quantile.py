"""Exact quantiles of columns of any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A bracket of at most this many rows is sorted as a whole.
_BAND = 100_000
# Size of a sketch, some 200 KB; by its published bound a rank is then off by less than 0.0005 of the rows, nearly always.
_SKETCH = 8_192
_RANK_ERROR = 0.0005
_PARTS = 32


def exact_quantile(df: DataFrame, value: Column, q: float, band: int = _BAND) -> float | None:
    """The q-quantile with linear interpolation between neighbours, nulls and NaN left out.

    One scan folds all values into a mergeable sketch of fixed size, whose rank error brackets the wanted values. The next
    counts the rows below the bracket and inside, and folds a sketch of these, until so few are inside that a last
    scan sorts them: three scans up to some 10^8 rows, one more for every further factor of a thousand. A bracket that
    missed is widened, so the result never hangs on the sketch. Only counts and single values reach the driver.
    """
    if not 0 <= q <= 1:
        raise ValueError(f"q must lie in [0, 1], got {q}")
    values = df.select(value.cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    found = _look(values, q, -math.inf, math.inf, _RANK_ERROR, None)
    total = found["size"]
    if not total:
        return None
    position = q * (total - 1)
    rank = math.floor(position)
    pair = _values_at(values, q, rank, 1 if position == rank else 2, total, found, band)
    return pair[0] if len(pair) == 1 else pair[0] + (pair[1] - pair[0]) * (position - rank)


def flag_low(df: DataFrame, score: str, share: float, name: str = "is_anomaly") -> DataFrame:
    """Flag the lowest ``share`` of scores: those below the exact quantile."""
    threshold = exact_quantile(df, F.col(score), share)
    return df.withColumn(name, F.col(score) < F.lit(threshold))


def _look(values: DataFrame, q: float, low: float, high: float, slack: float, total: int | None) -> dict:
    """One scan: rows below [low, high], inside, at its ends; the next bracket by a sketch of the values inside.

    Sketches are merged in ``_PARTS`` groups of tasks first, so that no task meets those of all others.
    """
    v = F.col("v")
    inside = F.when(v.between(low, high), v)
    parts = values.groupBy(F.pmod(F.spark_partition_id(), F.lit(_PARTS)).alias("part")).agg(
        F.kll_sketch_agg_double(inside, F.lit(_SKETCH)).alias("sketch"),
        F.count_if(v < low).alias("before"),
        F.count(inside).alias("size"),
        F.min(inside).alias("low"),
        F.max(inside).alias("high"),
    )
    found = parts.agg(
        F.kll_merge_agg_double(F.when(F.col("size") > 0, F.col("sketch")), F.lit(_SKETCH)).alias("sketch"),
        F.coalesce(F.sum("before"), F.lit(0)).alias("before"), F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    ).first().asDict()
    sketch, size = found.pop("sketch"), found["size"]
    if size:
        rank = math.floor(q * ((total or size) - 1)) - found["before"]
        room = slack * size
        ranks = [F.lit(min(max(r / size, 0.0), 1.0)) for r in (rank - room - 1, rank + room + 3)]
        # The sketch has a fixed size; a query of one row reads it.
        one = values.sparkSession.range(1)
        found["next"] = one.select(F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), F.array(*ranks))).first()[0]
    return found


def _values_at(values: DataFrame, q: float, rank: int, many: int, total: int, found: dict, band: int) -> list[float]:
    """The values at ``many`` 0-based ranks from ``rank`` on, in sorted order."""
    v, slack = F.col("v"), _RANK_ERROR
    while True:
        low, high = found["low"], found["high"]
        first = rank - found["before"]
        if low == high:
            return [low] * many
        if found["size"] <= band:
            rows = values.where(v.between(low, high)).orderBy("v").offset(first).limit(many).collect()
            return [r.v for r in rows]
        left, right = found["next"]
        if (left, right) == (low, high):
            # Ties fill the bracket: its ends are counted, and what lies between them is looked at alone.
            at_low, at_high, above, below = values.agg(
                F.count_if(v == low), F.count_if(v == high), F.min(F.when(v > low, v)), F.max(F.when(v < high, v))
            ).first()
            if first + many <= at_low:
                return [low] * many
            if first < at_low:
                return [low, above]
            if first >= found["size"] - at_high:
                return [high] * many
            if first + many > found["size"] - at_high:
                return [below, high]
            left, right = above, below
        closer = _look(values, q, left, right, slack, total)
        start = rank - closer["before"]
        if closer["size"] and 0 <= start and start + many <= closer["size"]:
            found = closer
        else:
            # The sketch was off: the same bracket again, with four times the room.
            slack *= 4
            found = _look(values, q, low, high, slack, total)
