"""Publishing model results as tables, views and incrementally maintained tables.

Storage is plain Parquet, so a rebuilt table is written beside the old one and
published last, by catalog calls that move no data:

* every version of a table lies in a folder of its own. Where columns only grow and the table has no
  partitions, one catalog call points it at the new folder: readers always find a complete version. The former
  folder stays until the next publish, so that readers that have begun can end. Else the final
  renames only touch the catalog, on object stores too;
* a failing write leaves the old version in place;
* a partitioned incremental table is not rebuilt where the partitions that a batch can change are known: those of its
  key's values, of its key's hash (``buckets``), or those that the predicate allows. Only they are read and rewritten.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemodels.functions.encode import normalize_nulls
from lakemodels.functions.types import pin_types
from lakemodels.operators.merge import (
    align_to,
    append_frames,
    check_unique_columns,
    checked_keys,
    delete_insert_frames,
    merge_frames,
    normalize_key,
    widen_pair,
)
from lakemodels.operators.names import Drift, drift_between
from lakemodels.operators.relational import col
from lakemodels.sinks.buckets import BUCKET, Buckets, without_bucket
from lakemodels.sources.scan import relation_kind, table_name
from lakemodels.sources.workspace import fresh_dir, remove_dir

STRATEGIES = ("append", "merge", "delete+insert")
SCHEMA_MODES = ("ignore", "fail", "append_new_columns", "sync_all_columns")
_BACKING = "lakemodels.backing"
# Set on every table this library writes: only the folders of such tables are deleted with them.
_OWNED = "lakemodels.owned"
# The folder of the version before, and properties that hold once the table lies in a certain folder.
_FORMER, _NEXT = "lakemodels.former", "lakemodels.next"
_LISTED_PARTITIONS = 5_000
_BUCKET_PROPERTIES = tuple(Buckets(1, ()).properties())

# Text for columns of these types is parsed by the encoders' rules, not by a plain cast.
_PARSED_ON_LOAD = {"variant": "jsonb", "boolean": "boolean"}


@dataclass(frozen=True)
class Written:
    """What a write did: the published name and the number of rows the model handed over."""

    name: str
    rows: int


def materialize(df: DataFrame, name: str, materialized: str = "table", **options) -> Written:
    """Publish as ``table``, ``view`` or ``incremental``; options go to the writer."""
    writers = {"table": write_table, "view": write_view, "incremental": write_incremental}
    if materialized not in writers:
        raise ValueError(f"Unknown materialization {materialized!r}; expected one of {sorted(writers)}")
    return writers[materialized](df, name, **options)


def write_table(
    df: DataFrame,
    name: str,
    column_types: Mapping[str, str] | None = None,
    category_types: Mapping[str, Sequence[str]] | None = None,
    partition_by: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
    buckets: Buckets | None = None,
) -> Written:
    """Create or replace a table. A view under that name is dropped, as is the old table.

    With ``buckets`` the rows are also partitioned by a hash of a key, in a last column named ``__lm_bucket``
    that :func:`stored_rows` hides.
    """
    result = prepared(df, column_types, category_types)
    spark = df.sparkSession
    create_schema(spark, name)
    rows = _publish(result, name, partition_by, properties or {}, buckets=buckets)
    return Written(name, rows)


def stored_rows(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table as the model returned them, without the writer's own column."""
    return without_bucket(spark.table(name))


def write_view(
    df: DataFrame,
    name: str,
    column_types: Mapping[str, str] | None = None,
    category_types: Mapping[str, Sequence[str]] | None = None,
) -> Written:
    """A view over a backing table with a name of its own.

    The new backing is complete before one catalog call points the view at it;
    the former backing goes afterwards. Readers always find the view.
    """
    result = prepared(df, column_types, category_types)
    spark = df.sparkSession
    create_schema(spark, name)
    kind = relation_kind(spark, name)
    former = _properties(spark, name).get(_BACKING) if kind == "view" else None
    nonce = uuid.uuid4().hex[:8]
    backing, old = f"{name}__data_{nonce}", f"{name}__old_{nonce}"
    rows = _save(result, backing, (), {})
    try:
        if kind == "table":
            _rename(spark, name, old)
        try:
            spark.sql(
                f"CREATE OR REPLACE VIEW {_sql(name)} TBLPROPERTIES ('{_BACKING}' = '{backing}') "
                f"AS SELECT * FROM {_sql(backing)}"
            )
        except Exception:
            if kind == "table":
                _rename(spark, old, name)
            raise
    except Exception:
        drop_relation(spark, backing)
        raise
    if kind == "table":
        drop_relation(spark, old)
    if former:
        drop_relation(spark, former)
    return Written(name, rows)


def write_incremental(
    df: DataFrame,
    name: str,
    strategy: str = "default",
    unique_key: str | Sequence[str] | None = None,
    on_schema_change: str = "ignore",
    column_types: Mapping[str, str] | None = None,
    category_types: Mapping[str, Sequence[str]] | None = None,
    full_refresh: bool = False,
    cascade: bool = False,
    order_by: Sequence[str] | None = None,
    predicate: str | None = None,
    batch_column: str | None = None,
    partition_by: Sequence[str] = (),
    widen: bool = False,
    properties: Mapping[str, str] | None = None,
    buckets: int | None = None,
) -> Written:
    """Add a batch to a table by append, merge or delete+insert.

    * ``default`` is merge with a key, else append.
    * The first run, or a full refresh, creates the table, also from an empty
      frame; a later empty batch changes nothing.
    * ``on_schema_change``: ``ignore`` (the default) and ``fail`` refuse drift,
      ``append_new_columns`` adds columns, ``sync_all_columns`` also drops
      those the model no longer returns. ``cascade`` drops views that read the
      table instead of refusing to drop a column.
    * ``order_by``, ``predicate``, ``batch_column``: see ``merge_frames``. Such
      helper columns are not stored unless the target has them.
    * ``widen`` lets a batch with a wider type widen the target's column.
    * ``buckets`` keeps the table partitioned by a hash of the key into so many parts. A batch then rewrites only
      the buckets its keys fall into. Without it a table keeps the buckets it has.
    * A ``predicate`` spares every partition without a row that it accepts, unless the batch moves rows
      from one partition to another.

    All arguments are checked before the first job or catalog change.
    """
    keys = normalize_key(unique_key)
    if strategy == "default":
        strategy = "merge" if keys else "append"
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown strategy {strategy!r}; expected default or one of {STRATEGIES}")
    if on_schema_change not in SCHEMA_MODES:
        raise ValueError(f"Unknown on_schema_change {on_schema_change!r}; expected one of {SCHEMA_MODES}")
    check_unique_columns(df.columns)
    if predicate and batch_column:
        raise ValueError("A predicate cannot be combined with batch_column: a batch may change what it says")

    if buckets is not None and not keys:
        raise ValueError("buckets need a unique_key")

    spark = df.sparkSession
    exists = relation_kind(spark, name) == "table"
    stored = Buckets.of(_properties(spark, name)) if exists else None
    if full_refresh or not exists:
        first = df
        if batch_column or order_by:
            first = _first_load(df, strategy, keys, order_by, batch_column)
        if buckets:
            stored = Buckets(buckets, tuple(checked_keys(keys, first.columns)))
        elif stored and drift_between(stored.keys, first.columns).new:
            stored = None
        return write_table(first, name, column_types, category_types, partition_by, properties, stored)

    target = stored_rows(spark, name)
    helpers = [c for c in dict.fromkeys([batch_column, *(order_by or [])]) if c and c not in target.columns]
    model_columns = [c for c in df.columns if c not in helpers]
    missing, new = drift_between(model_columns, target.columns)
    if strategy != "append":
        keys = checked_keys(keys, model_columns)
    readers: list[str] = []
    drift = Drift(missing, new)
    if drift and not _drift_allowed(drift, on_schema_change):
        if df.isEmpty():
            return Written(name, 0)
        raise drift.error(f"on_schema_change is {on_schema_change}")
    if missing:
        readers = _droppable_readers(spark, name, missing, cascade)

    wanted = Buckets(buckets, tuple(checked_keys(keys, target.columns))) if buckets else stored
    if wanted and {k.lower() for k in wanted.keys} & {c.lower() for c in missing}:
        wanted = None  # the column it is made of goes
    pins = {c: t for c, t in (column_types or {}).items() if c in new}
    pins |= {f.name: t for f in target.schema.fields if f.name in model_columns
             for t in [_PARSED_ON_LOAD.get(f.dataType.simpleString())] if t}
    categories = {c: d for c, d in (category_types or {}).items() if c in new}
    batch = normalize_nulls(pin_types(df, pins, categories))
    if strategy == "append" and not (missing or new or widen or wanted != stored):
        return Written(name, _append(batch.drop(*helpers), name))

    # The batch feeds several branches of the plan: fix its rows once.
    staged = fresh_dir(spark, "batch")
    try:
        rows = _observed(batch, lambda frame: frame.write.parquet(staged))
        if rows:
            settings = _Change(
                name, strategy, keys, missing, new, helpers, order_by, predicate, batch_column, widen, properties or {},
                readers, stored, wanted,
            )
            _apply_batch(spark.read.parquet(staged), target, settings)
    finally:
        remove_dir(spark, staged)
    return Written(name, rows)


@dataclass(frozen=True)
class _Change:
    """One checked batch application."""

    name: str
    strategy: str
    keys: list[str] | None
    missing: list[str]
    new: list[str]
    helpers: list[str]
    order_by: Sequence[str] | None
    predicate: str | None
    batch_column: str | None
    widen: bool
    properties: Mapping[str, str]
    readers: list[str]
    stored: Buckets | None
    wanted: Buckets | None


def _apply_batch(batch: DataFrame, target: DataFrame, change: _Change) -> None:
    """Publish target + staged batch, in place where only some partitions change."""
    spark, name, keys = batch.sparkSession, change.name, change.keys
    stored_by = _partitions(spark, name)
    own_by = [c for c in stored_by if c != BUCKET]
    stored_types, kinds = _types(target), {f.name: f.dataType for f in batch.schema.fields}
    if change.widen:
        target, batch = widen_pair(target, batch)

    rebuild = bool(change.missing) or _types(target) != stored_types or change.wanted != change.stored
    by_key = by_predicate = False
    if change.strategy != "append" and stored_by and not rebuild:
        by_key = {c.lower() for c in own_by} <= {k.lower() for k in keys} and (not change.stored or change.stored.within(keys))
        by_predicate = not by_key and bool(change.predicate) and not _moves(target, batch, change, own_by)
        # A batch number is stored after the partitions: only null keys would be inserted twice by a repeat.
        if change.properties and (by_key or by_predicate) and _has_null_keys(batch, keys):
            by_key = by_predicate = False
    rebuild = rebuild or not (change.strategy == "append" or by_key or by_predicate)
    if rebuild:
        target = target.drop(*change.missing).withColumns({c: F.lit(None).cast(kinds[c]) for c in change.new})
    elif change.new:
        added = ", ".join(f"{table_name(c)} {kinds[c].simpleString()}" for c in change.new)
        spark.sql(f"ALTER TABLE {_sql(name)} ADD COLUMNS ({added})")
        target = stored_rows(spark, name)

    def applied(existing: DataFrame) -> DataFrame:
        if change.strategy == "append":
            return append_frames(existing, batch.drop(*change.helpers))
        if change.strategy == "merge":
            return merge_frames(existing, batch, keys, change.order_by, change.predicate, change.batch_column)
        unneeded = [c for c in change.helpers if c != change.batch_column]
        return delete_insert_frames(existing, batch.drop(*unneeded), keys, change.predicate, change.batch_column)

    if rebuild:
        properties = {**_own_properties(spark, name), **change.properties}
        _publish(applied(target), name, own_by, properties, change.readers, change.wanted)
    elif change.strategy == "append":
        _append(batch.drop(*change.helpers), name)
    else:
        rows = align_to(batch.drop(*change.helpers), target)
        places = change.stored.added_to(rows) if change.stored else rows
        everything = spark.table(name)
        if by_predicate:
            places = places.select(*map(col, stored_by)).unionByName(
                everything.where(F.expr(change.predicate)).select(*map(col, stored_by))
            )
        result = applied(without_bucket(_touched(everything, places, stored_by)))
        rewrite_partitions(change.stored.added_to(result) if change.stored else result, name)
        _set_properties(spark, name, change.properties)


def _moves(target: DataFrame, batch: DataFrame, change: _Change, partition_by: Sequence[str]) -> bool:
    """Whether a row of the batch would take a target row that the predicate accepts to another partition.

    Of the target only keys and partition columns are read, and only where the predicate allows. A partition could lose
    all its rows by such a move, and an overwrite of the partitions that have rows would not empty it.
    """
    rows = align_to(batch.drop(*change.helpers), target.drop(*change.missing).withColumns({c: F.lit(None) for c in change.new}))
    new = rows.select(*map(col, change.keys), *[col(c).alias(f"__to_{c}") for c in partition_by if c not in change.keys])
    held = target.where(F.expr(change.predicate)).select(*map(col, dict.fromkeys([*change.keys, *partition_by])))
    differs = [~col(c).eqNullSafe(col(f"__to_{c}")) for c in partition_by if c not in change.keys]
    return not held.join(new, on=list(change.keys)).where(reduce(lambda a, b: a | b, differs)).isEmpty()


def prepared(df: DataFrame, column_types=None, category_types=None) -> DataFrame:
    """Pinned types, NaN as null: the frame a writer stores."""
    return normalize_nulls(pin_types(df, column_types, category_types))


def create_schema(spark: SparkSession, name: str) -> None:
    parts = name.split(".")
    if len(parts) > 1:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table_name(*parts[:-1])}")


def drop_relation(spark: SparkSession, name: str) -> None:
    """Drop a table, or a view with its backing table. The folder goes too if this library wrote the table."""
    kind = relation_kind(spark, name)
    if kind == "view":
        backing = _properties(spark, name).get(_BACKING)
        spark.sql(f"DROP VIEW IF EXISTS {_sql(name)}")
        if backing:
            drop_relation(spark, backing)
    elif kind == "table":
        properties = _properties(spark, name)
        location = _location(spark, name)
        spark.sql(f"DROP TABLE IF EXISTS {_sql(name)}")
        if properties.get(_OWNED) == "true":
            remove_dir(spark, location)
            if _FORMER in properties:
                remove_dir(spark, properties[_FORMER])


def dependent_views(spark: SparkSession, name: str) -> list[str]:
    """Views of any schema that read the table, itself or through another view.

    One catalog call per hundred views tells what each says. A view of this library reads its backing table and nothing else.
    Another can only read the table if its text has the table's name in it, or that of a view that can; these
    alone are resolved by Spark, and the tables they then read stand in the plan with their full names.
    """
    wanted = _full_name(spark, name)
    found, others = [], {}
    for schema in spark.sql("SHOW SCHEMAS").collect():
        listed = spark.sql(f"SHOW VIEWS IN {table_name(schema.namespace)}").collect()
        views = [row.viewName for row in listed if not row.isTemporary]
        for at in range(0, len(views), 100):
            pattern = "|".join(views[at : at + 100]).replace("'", "\\'")
            for row in spark.sql(f"SHOW TABLE EXTENDED IN {table_name(schema.namespace)} LIKE '{pattern}'").collect():
                view = f"{schema.namespace}.{row.tableName}"
                backing = re.search(rf"{re.escape(_BACKING)}=([^,\]\n]+)", row.information)
                if not backing:
                    others[view] = row.information.lower()
                elif _full_name(spark, backing[1]) == wanted:
                    found.append(view)
    names, able = {wanted.split(".")[-1], *(view.split(".")[-1].lower() for view in found)}, set()
    while new := [v for v, text in others.items() if v not in able and any(n in _view_text(text) for n in names)]:
        able.update(new)
        names.update(v.split(".")[-1].lower() for v in new)
    return found + [view for view in others if view in able and wanted in _relations_read(spark, view)]


def _view_text(information: str) -> str:
    """What the catalog says of a view, from its text on: the lines before hold its own name."""
    return information.split("view text:", 1)[-1]


def _full_name(spark: SparkSession, name: str) -> str:
    parts = name.split(".")
    if len(parts) == 1:
        parts = [spark.catalog.currentDatabase(), *parts]
    if len(parts) == 2:
        parts = [spark.catalog.currentCatalog(), *parts]
    return ".".join(parts).lower()


def _relations_read(spark: SparkSession, view: str) -> set[str]:
    """Full names of all relations that a view resolves to; none if it no longer resolves."""
    plan = spark.sql(f"EXPLAIN EXTENDED SELECT * FROM {_sql(view)}").first()[0]
    names = re.findall(r"SubqueryAlias (\S+), ?|SubqueryAlias (\S+)", plan)
    return {(a or b).replace("`", "").lower() for a, b in names if (a or b).count(".") == 2}


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return _properties(spark, name)


def _publish(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str],
    properties: Mapping[str, str],
    readers: Sequence[str] = (),
    buckets: Buckets | None = None,
) -> int:
    """Write beside the old version, then swap folders, or else names, in the catalog.

    If a step of the swap fails, the old version stays or gets its name back, and the new one is dropped.
    ``readers`` are views that cannot live with the new version; they go when it is complete.
    """
    spark = df.sparkSession
    properties = {k: v for k, v in properties.items() if k not in (_FORMER, *_BUCKET_PROPERTIES)}
    if buckets:
        df, partition_by = buckets.added_to(df), [*partition_by, BUCKET]
        properties |= buckets.properties()
    if not (partition_by or readers) and _can_swap_folder(df, name):
        return _swap_folder(df, name, properties)
    nonce = uuid.uuid4().hex[:8]
    stage, old = f"{name}__stage_{nonce}", f"{name}__old_{nonce}"
    rows = _save(df, stage, partition_by, properties)
    kind, moved = relation_kind(spark, name), False
    try:
        if kind == "table":
            _rename(spark, name, old)
            moved = True
        elif kind == "view":
            # A view cannot be renamed across kinds; its definition is kept to restore it.
            definition = spark.sql(f"SHOW CREATE TABLE {_sql(name)}").first()[0]
            spark.sql(f"DROP VIEW {_sql(name)}")
        try:
            _rename(spark, stage, name)
        except Exception:
            if kind == "view":
                spark.sql(definition)
            raise
    except Exception:
        if moved:
            _rename(spark, old, name)
        drop_relation(spark, stage)
        raise
    if kind == "table":
        drop_relation(spark, old)
    elif kind == "view" and (backing := re.search(rf"'{re.escape(_BACKING)}' = '([^']+)'", definition)):
        drop_relation(spark, backing[1])
    for view in readers:
        drop_relation(spark, view)
    return rows


def _can_swap_folder(df: DataFrame, name: str) -> bool:
    """Whether the table is this library's, has no partitions, and its columns are the first of the new version."""
    spark = df.sparkSession
    if relation_kind(spark, name) != "table" or _properties(spark, name).get(_OWNED) != "true" or _partitions(spark, name):
        return False
    old, new = spark.table(name).schema.fields, df.schema.fields
    return len(new) >= len(old) and all(a.name == b.name and a.dataType == b.dataType for a, b in zip(old, new, strict=False))


def _swap_folder(df: DataFrame, name: str, properties: Mapping[str, str]) -> int:
    """Write a new folder, then point the table at it by one catalog call.

    The properties are stored before, bound to the new folder: they hold from the same call on, so that a
    batch number and its rows appear together.
    """
    spark = df.sparkSession
    folder = f"{_schema_location(spark, name)}/{name.split('.')[-1]}__v_{uuid.uuid4().hex[:12]}"
    before = _properties(spark, name)
    former = _location(spark, name)
    try:
        rows = _observed(df, lambda frame: frame.write.parquet(folder))
        new = df.schema.fields[len(spark.table(name).columns) :]
        if new:
            added = ", ".join(f"{table_name(f.name)} {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {_sql(name)} ADD COLUMNS ({added})")
        changed = {k: v for k, v in properties.items() if before.get(k) != v}
        if changed:
            _set_properties(spark, name, {_NEXT: json.dumps({"folder": folder, "properties": changed})})
        _point_at(spark, name, folder)
    except Exception:
        remove_dir(spark, folder)
        raise
    spark.catalog.refreshTable(_sql(name))
    _set_properties(spark, name, {**changed, _FORMER: former})
    if changed:
        spark.sql(f"ALTER TABLE {_sql(name)} UNSET TBLPROPERTIES IF EXISTS ('{_NEXT}')")
    if _FORMER in before:
        remove_dir(spark, before[_FORMER])
    return rows


def _point_at(spark: SparkSession, name: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {_sql(name)} SET LOCATION '{folder}'")


def _rename(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {_sql(name)} RENAME TO {_sql(to)}")


def _save(df: DataFrame, name: str, partition_by: Sequence[str], properties: Mapping[str, str]) -> int:
    spark = df.sparkSession
    path = f"{_schema_location(spark, name)}/{name.split('.')[-1]}"
    df = _gathered(df, partition_by)

    def save(frame: DataFrame) -> None:
        writer = frame.write.format("parquet").option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(_sql(name))

    try:
        rows = _observed(df, save)
    except Exception:
        remove_dir(spark, path)
        raise
    _set_properties(spark, name, {**properties, _OWNED: "true"})
    return rows


def _types(df: DataFrame) -> list:
    return [f.dataType for f in df.schema.fields]


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, else every task writes a file into each; AQE splits large ones."""
    return df.hint("rebalance", *map(col, partition_by)) if partition_by else df


def _append(df: DataFrame, name: str) -> int:
    spark = df.sparkSession
    rows, buckets = align_to(df, stored_rows(spark, name)), Buckets.of(_properties(spark, name))
    rows = _gathered(buckets.added_to(rows) if buckets else rows, _partitions(spark, name))
    return _observed(rows, lambda frame: frame.write.insertInto(_sql(name)))


def _observed(df: DataFrame, write) -> int:
    """Run the write and count its rows in the same job."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _first_load(df, strategy, keys, order_by, batch_column) -> DataFrame:
    """First run with helper columns: the batches meet an empty target; helpers are not stored."""
    helpers = [c for c in dict.fromkeys([batch_column, *(order_by or [])]) if c]
    stored = df.drop(*helpers)
    if not batch_column or not keys or strategy == "append":
        return stored
    empty = stored.limit(0)
    if strategy == "merge":
        return merge_frames(empty, df, keys, order_by, batch_column=batch_column)
    return delete_insert_frames(empty, df.drop(*(order_by or [])), keys, batch_column=batch_column)


def _drift_allowed(drift: Drift, mode: str) -> bool:
    """Whether the mode lets the target's columns follow the model's."""
    return mode == "sync_all_columns" or (mode == "append_new_columns" and not drift.missing)


def _droppable_readers(spark, name, dropped: Sequence[str], cascade: bool) -> list[str]:
    """Views that read the table and go with its dropped columns; without ``cascade`` they forbid the drop."""
    views = dependent_views(spark, name)
    if views and not cascade:
        raise ValueError(
            f"Cannot drop columns {list(dropped)} of {name}: views {views} read it. "
            "Drop them, run a full refresh, or set cascade."
        )
    return views


def _has_null_keys(batch: DataFrame, keys: Sequence[str]) -> bool:
    return not batch.where(_any_null(keys)).isEmpty()


def _any_null(columns: Sequence[str]):
    return reduce(lambda a, b: a | b, [col(c).isNull() for c in columns])


def _touched(target: DataFrame, places: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Target rows in the partitions that ``places`` holds.

    The partition values become literals, so the scan reads no other partition. Past a bound on their number a
    semi join stands in for them. If any place has a null, all partitions with a null are taken.
    """
    values = places.select(*[col(c).cast(target.schema[c].dataType).alias(c) for c in partition_by]).distinct()
    listed = values.limit(_LISTED_PARTITIONS + 1).collect()
    few = len(listed) <= _LISTED_PARTITIONS
    with_null = any(None in tuple(row) for row in listed) if few else _has_null_keys(values, partition_by)
    hit = target
    if few:
        for c in partition_by:
            hit = hit.where(col(c).isin(sorted({row[c] for row in listed if None not in tuple(row)})))
    if not few or len(partition_by) > 1:
        hit = hit.join(values.where(~_any_null(partition_by)), on=list(partition_by), how="left_semi")
    if with_null:
        hit = hit.unionByName(target.where(_any_null(partition_by)))
    return hit


def rewrite_partitions(df: DataFrame, name: str) -> None:
    """Replace exactly the partitions the frame has rows for; the job's commit swaps them in."""
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows = df.select(*map(col, spark.table(name).columns))
        _gathered(rows, _partitions(spark, name)).write.insertInto(_sql(name), overwrite=True)
    finally:
        spark.conf.set(setting, before)


def partition_values(spark: SparkSession, name: str, column: str) -> list[str]:
    """The values of a table's only partition column; none if it is partitioned otherwise."""
    if _partitions(spark, name) != [column]:
        return []
    return [row.partition.split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {_sql(name)}").collect()]


def drop_partitions(spark: SparkSession, name: str, column: str, values: Sequence[str]) -> None:
    """Take partitions with plain values out of the catalog, then delete their folders if this library wrote them."""
    if not values:
        return
    places = ", ".join(f"PARTITION ({table_name(column)} = '{value}')" for value in values)
    spark.sql(f"ALTER TABLE {_sql(name)} DROP IF EXISTS {places}")
    if _properties(spark, name).get(_OWNED) == "true":
        for value in values:
            remove_dir(spark, f"{_location(spark, name)}/{column}={value}")


def _set_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    if properties:
        quoted = lambda text: text.replace("\\", "\\\\").replace("'", "\\'")
        pairs = ", ".join(f"'{quoted(k)}' = '{quoted(v)}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {_sql(name)} SET TBLPROPERTIES ({pairs})")


def _partitions(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    """Properties of a table; those bound to a folder hold if the table lies there."""
    held = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {_sql(name)}").collect()}
    if _NEXT in held:
        coming = json.loads(held.pop(_NEXT))
        if _location(spark, name).rstrip("/").endswith(coming["folder"].rstrip("/").split("/")[-1]):
            held |= coming["properties"]
    return held


def _own_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {k: v for k, v in _properties(spark, name).items() if k.startswith("lakemodels.")}


def _location(spark: SparkSession, name: str) -> str:
    row = spark.sql(f"DESCRIBE EXTENDED {_sql(name)}").where("col_name = 'Location'").first()
    return row.data_type


def _schema_location(spark: SparkSession, name: str) -> str:
    parts = name.split(".")
    schema = parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(schema).locationUri.rstrip("/")


def _sql(name: str) -> str:
    return table_name(*name.split("."))
