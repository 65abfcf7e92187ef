"""Small scalar expressions that models use again and again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coerce_number(value: Column) -> Column:
    """Number from text; null where the text is no number."""
    return value.try_cast("double")


def bucket(value: Column, threshold: float, high: str = "high", standard: str = "standard") -> Column:
    """``high`` at or above the threshold; everything else, nulls included, is ``standard``."""
    return F.when(value >= threshold, F.lit(high)).otherwise(F.lit(standard))


def load_timestamp() -> Column:
    """When the job ran."""
    return F.current_timestamp()


def joint_text(*parts: Column) -> Column:
    """Parts joined by a space, lower case; null when any part is null."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(" "), part]
    return F.lower(F.concat(*pieces))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("smallint")


def day_of_week(ts: Column) -> Column:
    """Monday is 0, Sunday is 6."""
    return F.weekday(ts).cast("smallint")


def clip_low(value: Column, floor: float = 0.0) -> Column:
    """Values below the floor become the floor; null stays null."""
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Ties go to the even digit, as numpy rounds."""
    return F.bround(value, digits)


def add_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)
