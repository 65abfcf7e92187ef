"""Upserts as pure DataFrame plans: target + batch -> new target.

Keys compare with plain equality, so a null key never matches and its row is
inserted again. All target rows with a matching key are updated; a null in the
batch overwrites the target's value.

Scale notes
* The batch is reduced to one row per key by an aggregate, which combines
  before the shuffle, so many copies of one key cost one row per map task.
* Rows without a key skip every shuffle.
* The target is always the left side of its join, the side AQE may split when
  one key holds a large share of its rows.
* Inserted rows are found with the *matched* keys, a subset of the batch's
  keys, so the target's own key set is never shuffled for a small batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemodels.operators.names import Names, as_names, drift_between
from lakemodels.operators.relational import anti_join, col, quoted, split_null_keys, union_all

_NEW = "__lm_new"
_FIRST = "__lm_first"
_LAST = "__lm_last"


def merge_frames(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    predicate: str | None = None,
    batch_column: str | None = None,
) -> DataFrame:
    """Update matching target rows, then insert batch rows whose key is absent.

    ``order_by`` names batch columns that decide which of several batch rows
    with one key updates the target: the greatest wins, other columns break
    ties. These columns need not exist in the target. ``predicate`` (SQL over
    target columns) limits the target rows that may match. ``batch_column``
    numbers several batches that are applied in ascending order in one step.
    """
    if predicate and batch_column:
        raise ValueError("A predicate cannot be combined with batch_column: a batch may change what it says")
    keys = checked_keys(keys, target.columns)
    extra = [c for c in [*(order_by or []), batch_column] if c and c not in target.columns]
    rows = align_to(batch, target, extra)

    untouched = None
    if predicate:
        hit = F.coalesce(F.expr(predicate), F.lit(False))
        untouched, target = target.where(~hit), target.where(hit)

    # Rows with a null key never meet another row: they pass by the joins without a shuffle.
    keyed, keyless = split_null_keys(target, keys)
    rows, new_keyless = split_null_keys(rows, keys)

    payload = [c for c in target.columns if c not in keys]
    winners = _winners(rows, keys, payload, order_by or [], batch_column)
    matched = keyed.select(*map(col, keys)).join(winners.select(*map(col, keys)), on=list(keys), how="left_semi")
    inserts = anti_join(rows, matched, keys)
    if batch_column:
        inserts = _fold_inserts(inserts, winners, keys, payload, batch_column)

    updated = _update(keyed, winners, keys, payload) if payload else keyed
    stored = [col(c) for c in target.columns]
    result = union_all(updated, inserts.select(*stored), keyless, new_keyless.select(*stored))
    return result if untouched is None else untouched.unionByName(result)


def delete_insert_frames(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    predicate: str | None = None,
    batch_column: str | None = None,
) -> DataFrame:
    """Remove target rows whose key is in the batch, then add the whole batch.

    With ``batch_column``, batches replace each other in ascending order: of
    the rows with one key only those of the last batch stay.
    """
    if predicate and batch_column:
        raise ValueError("A predicate cannot be combined with batch_column: a batch may change what it says")
    keys = checked_keys(keys, target.columns)
    rows = align_to(batch, target, [batch_column] if batch_column and batch_column not in target.columns else [])
    rows, new_keyless = split_null_keys(rows, keys)
    if batch_column:
        last = rows.groupBy(*map(col, keys)).agg(F.max(col(batch_column)).alias(_LAST))
        rows = rows.join(last, on=list(keys)).where(col(batch_column) == F.col(_LAST)).drop(_LAST)

    kept = []
    if predicate:
        hit = F.coalesce(F.expr(predicate), F.lit(False))
        kept, target = [target.where(~hit)], target.where(hit)
    keyed, keyless = split_null_keys(target, keys)
    stored = [col(c) for c in target.columns]
    return union_all(
        anti_join(keyed, rows, keys), keyless, rows.select(*stored), new_keyless.select(*stored), *kept
    )


def append_frames(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, columns lined up by name."""
    return target.unionByName(align_to(batch, target))


def align_columns(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Put columns into the target's order and spelling; both must have the same columns."""
    check_unique_columns(df.columns)
    drift = drift_between(df.columns, target_columns)
    if drift:
        raise drift.error("append_new_columns or a full refresh can add columns")
    return df.select(*[col(c).alias(c) for c in target_columns])


def align_to(batch: DataFrame, target: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Line up with ``target`` and cast to its column types; keep ``extra`` columns at the end."""
    extra = list(dict.fromkeys(extra))
    carried = Names(batch.columns).resolve(extra, "Helper columns of the batch")
    align_columns(batch.drop(*carried), target.columns)
    return batch.select(
        *[col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields],
        *[col(c) for c in carried],
    )


def widen_pair(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cast columns both frames share to their common wider type (int to bigint and so on)."""
    shared = [c for c in target.columns if c in batch.columns]
    common = target.select(*map(col, shared)).unionByName(batch.select(*map(col, shared))).schema
    wide = {f.name: f.dataType for f in common.fields}

    def cast_to_wide(df: DataFrame) -> DataFrame:
        return df.select(*[col(c).cast(wide[c]).alias(c) if c in wide else col(c) for c in df.columns])

    return cast_to_wide(target), cast_to_wide(batch)


def check_unique_columns(columns: Sequence[str]) -> None:
    """Reject frames without columns, and names that only case tells apart."""
    if not columns:
        raise ValueError("The model returned a frame without columns")
    repeated = Names(columns).repeated()
    if repeated:
        raise ValueError(f"Ambiguous column names: {repeated}")


def normalize_key(unique_key) -> list[str] | None:
    """The key columns as a list; None if there are none."""
    return as_names(unique_key, "unique_key") or None


def checked_keys(unique_key, columns: Sequence[str]) -> list[str]:
    """Key columns in the spelling of ``columns``; merge and delete+insert cannot do without."""
    keys = as_names(unique_key, "unique_key")
    if not keys:
        raise ValueError("Rows can be matched by a unique_key only; append needs none")
    return Names(columns).resolve(keys, "unique_key")


def _winners(rows, keys, payload, order_by, batch_column) -> DataFrame:
    """One row per key: the packed values of the row that updates the target."""
    ranked = list(dict.fromkeys([c for c in [batch_column, *order_by] if c] + payload))
    sortable = [f.name for f in rows.schema.fields if f.name in ranked and _orderable(f.dataType)]
    rank = F.struct(*[col(c) for c in ranked if c in sortable])
    if not payload:
        winner = F.first(F.struct(F.lit(True).alias("hit")))
    elif len(sortable) == len(ranked):
        winner = F.max(rank)
    elif sortable:
        winner = F.max_by(F.struct(*[col(c) for c in payload]), rank)
    else:
        raise ValueError("These columns have no order; name one in order_by that decides between batch rows")
    aggregates = [winner.alias(_NEW)]
    if batch_column:
        aggregates += [F.min(col(batch_column)).alias(_FIRST), F.max(col(batch_column)).alias(_LAST)]
    return rows.groupBy(*map(col, keys)).agg(*aggregates)


def _update(target: DataFrame, winners: DataFrame, keys, payload) -> DataFrame:
    joined = target.join(winners.select(*map(col, keys), F.col(_NEW)), on=list(keys), how="left")
    matched = F.col(_NEW).isNotNull()

    def value(name: str) -> Column:
        if name in keys:
            return col(name)
        return F.when(matched, F.col(f"{_NEW}.{quoted(name)}")).otherwise(col(name)).alias(name)

    return joined.select(*[value(c) for c in target.columns])


def _fold_inserts(inserts, winners, keys, payload, batch_column) -> DataFrame:
    """New keys under several batches: the first batch inserts, later ones update those rows."""
    joined = inserts.join(winners, on=list(keys)).where(col(batch_column) == F.col(_FIRST))
    later = F.col(_LAST) > F.col(_FIRST)
    return joined.select(
        *map(col, keys),
        *[F.when(later, F.col(f"{_NEW}.{quoted(c)}")).otherwise(col(c)).alias(c) for c in payload],
    )


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return True
