"""Projection, filter and key joins over DataFrames.

All helpers stay lazy, so column pruning, predicate pushdown and the choice of
the physical join remain Catalyst's.
"""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemodels.operators.names import Names, as_names

# Plain outer and the two-word forms mean the same as in SQL.
JOIN_KINDS = {kind: kind for kind in ("inner", "left", "right", "full", "cross")}
JOIN_KINDS |= {f"{side} outer": side for side in ("left", "right", "full")} | {"outer": "full"}


def quoted(name: str) -> str:
    """Backtick-quote one column or table name part."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str):
    return F.col(quoted(name))


def project(df: DataFrame, projection_sql: str) -> DataFrame:
    """``SELECT <projection_sql> FROM df``: columns, casts, DISTINCT, windows, aggregates."""
    with _only_one_clause(projection_sql):
        # Braces would be read as placeholders of the frame.
        select_list = projection_sql.replace("{", "{{").replace("}", "}}")
        return df.sparkSession.sql(f"SELECT {select_list} FROM {{frame}}", frame=df)


def keep(df: DataFrame, predicate_sql: str) -> DataFrame:
    """Rows for which the SQL predicate is true (not false, not null)."""
    with _only_one_clause(predicate_sql):
        return df.where(predicate_sql)


@contextmanager
def _only_one_clause(sql: str):
    """Let Spark's parser judge a piece of SQL; a statement behind it is none of its business."""
    if not isinstance(sql, str) or not sql.strip() or sql.rstrip().endswith(";"):
        raise ValueError(f"One SQL clause is expected, got {sql!r}")
    try:
        yield
    except ParseException as error:
        raise ValueError(f"Not one SQL clause: {sql!r}") from error


def join_using(
    left: DataFrame,
    right: DataFrame,
    on: str | Iterable[str] | None = None,
    how: str = "inner",
    split_outer: bool = False,
) -> DataFrame:
    """USING join: key columns once and first, then the rest of both sides.

    AQE splits a hot key on either side of an inner join and on the preserved
    side of a left or right join. It can split neither side of a full join, so
    that one runs as an inner join plus two anti joins against distinct keys;
    rows with a null key skip the joins. ``split_outer`` asks
    for the same plan for a left or right join whose *other* side has hot keys
    and is too large to be broadcast.
    """
    _check_side(left, right)
    kind = _join_kind(how)
    if kind == "cross":
        if on is not None:
            raise ValueError("A cross join has no key columns")
        return left.crossJoin(right)
    keys = shared_keys(on, left, right)
    if kind == "full" or (split_outer and kind in ("left", "right")):
        return _outer_by_parts(left, right, keys, kind)
    return left.join(right, on=keys, how=kind)


def _check_side(left: DataFrame, right: DataFrame) -> None:
    if not isinstance(right, DataFrame):
        raise TypeError(f"A frame can be joined with a frame only, not with {type(right).__name__}")
    if right.sparkSession.sparkContext is not left.sparkSession.sparkContext:
        raise ValueError("The two frames belong to different Spark applications")


def _join_kind(how: str) -> str:
    spelled = " ".join(how.lower().replace("_", " ").split())
    try:
        return JOIN_KINDS[spelled]
    except KeyError:
        raise ValueError(f"No join of kind {how!r}; there are {', '.join(JOIN_KINDS)}") from None


def shared_keys(on: str | Iterable[str] | None, *frames: DataFrame) -> list[str]:
    """Key columns in the spelling of the first frame, looked up in all of them; without a key Spark would join all pairs."""
    try:
        asked = as_names(on, "A join")
    except TypeError as error:
        raise ValueError(str(error)) from error
    if not asked:
        raise ValueError("A join needs a key column at least")
    spelled = [Names(frame.columns).resolve(asked, "Join key") for frame in frames]
    return spelled[0]


def anti_join(left: DataFrame, right: DataFrame, on: str | Iterable[str]) -> DataFrame:
    """Rows of ``left`` without a match. Right keys are made distinct before the shuffle."""
    keys = shared_keys(on, left, right)
    return left.join(right.select(*map(col, keys)).distinct(), on=keys, how="left_anti")


def semi_join(left: DataFrame, right: DataFrame, on: str | Iterable[str]) -> DataFrame:
    """Rows of ``left`` with a match. Right keys are made distinct before the shuffle."""
    keys = shared_keys(on, left, right)
    return left.join(right.select(*map(col, keys)).distinct(), on=keys, how="left_semi")


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Concatenate frames by column name."""
    result = first
    for frame in others:
        result = result.unionByName(frame)
    return result


def _outer_by_parts(left: DataFrame, right: DataFrame, keys: list[str], kind: str) -> DataFrame:
    left_rest = [c for c in left.columns if c not in keys]
    right_rest = [c for c in right.columns if c not in keys]
    if set(left_rest) & set(right_rest):
        # Ambiguous names cannot be lined up by name; the writer rejects them anyway.
        return left.join(right, on=keys, how=kind)
    # The not-null filter makes each side's exchange the same in both joins, so Spark shuffles it once.
    left_keyed, left_keyless = split_null_keys(left, keys)
    right_keyed, right_keyless = split_null_keys(right, keys)
    parts = [left_keyed.join(right_keyed, on=keys, how="inner")]
    if kind in ("left", "full"):
        parts += [anti_join(left_keyed, right_keyed, keys), left_keyless]
    if kind in ("right", "full"):
        parts += [anti_join(right_keyed, left_keyed, keys), right_keyless]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def split_null_keys(df: DataFrame, keys: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys present, and rows with a null among them (a filter the scan can prune by)."""
    missing = reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])
    return df.where(~missing), df.where(missing)
