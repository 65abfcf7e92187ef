"""Hard negatives by Fagin's threshold algorithm, over blocks of vectors with sorted lists per dimension.

*Vectors.* Rows without id, label or vector, or with a null or non-finite component, take no part. Components
become floor(``scale`` * x); a score is the integer inner product with the anchor (in doubles while
these are exact, in Python integers beyond; a score that a long
cannot hold is +-(2^63 - 1) from the start). Vectors of unequal length are filled with
zeros. Rows that share an id count once: the one with the smallest label, then the smallest vector.

*Windows.* A window is a range of scores of which the first k rows are wanted: higher scores first, ties by
smaller id. Positives are one window over the rows of the anchor's label; the negatives of a positive
are the window [``share`` * its score, its score] over the rows of other labels.

*Threshold algorithm.* A block keeps one list per dimension, sorted by that component. An anchor reads each list from
the top where its own component is positive, from the bottom where it is negative, and not at all where it is 0
(sorted access, in steps that double). Each row met is scored at once, whole (random access). The sum of the
anchor's components times the next value of each list bounds all rows not met yet; reading stops once
this threshold lies strictly below the kth score of every window, or below its lower end while it is not full.
The windows carry over from block to block of a task, so later blocks often stop before their first row.

*Spark.* The vectors are dealt once by (label, id) ranges, so that a hot label is spread over many tasks
and blocks are mostly of one label; each task streams its rows in blocks of ``block_rows``. Anchors are
taken in slices of ``slice_anchors`` (the bound of everything that is sent to tasks or to the driver), so the work is
that of all anchors against all rows in blocks, with memory that does not grow. Each task returns at
most k rows per window, and a row number per window merges them. Slices are written to the shared folder.

Empty tables give no rows; an anchor without rows of its label has no positives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakemodels.llm.common import freeze
from lakemodels.llm.plans import PLANS, SQL, read
from lakemodels.sources.workspace import fresh_dir, ship_package

# Whole numbers up to this are exact in a double.
EXACT = 2**53
LONG = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    """How many rows, which window, and the sizes that bound memory."""

    positives: int = 5
    negatives: int = 5
    least_percent: int = 80
    scale: int = 256
    first_step: int = 16
    block_rows: int = 8_192
    slice_anchors: int = 4_096
    task_rows: int = 500_000


def vectors(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(id, label, x) with whole components, one row per id, from (id, label, vector)."""
    whole = F.transform("vector", lambda x: F.floor(F.lit(settings.scale) * x.cast("double")))
    odd = F.exists("vector", lambda x: F.coalesce(F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")), F.lit(True)))
    fit = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(~odd)
    named = fit.select(F.col("id").cast("long"), F.struct(F.col("label").cast("long").alias("label"), whole.alias("x")).alias("row"))
    return named.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.x")


class Block:
    """Vectors with their lists: per dimension the rows in ascending order of the component, and those components."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.rows, self.size = np.argsort(x, axis=0, kind="stable"), len(ids)
        self.values = np.take_along_axis(x, self.rows, axis=0)
        self.label_set = set(labels.tolist())

    def threshold(self, anchor: np.ndarray, up: np.ndarray, down: np.ndarray, depth: int):
        """The most that a row can score which no list holds before ``depth``."""
        most = anchor[up] @ self.values[self.size - 1 - depth, up] + anchor[down] @ self.values[depth, down]
        return max(-LONG, min(LONG, most))


class Range:
    """The first ``k`` rows met with scores in [low, high]; None stands for no lower end."""

    def __init__(self, k: int, low: int | None, high: int | None):
        self.k, self.low, self.high = k, low, high
        self.held: list[tuple[int, int]] = []

    def done(self, threshold) -> bool:
        """Whether no row that scores at most ``threshold`` can enter."""
        if not self.k or (self.low is not None and threshold < self.low):
            return True
        return len(self.held) == self.k and threshold < -self.held[-1][0]

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        at = np.ones(len(scores), bool)
        least = -self.held[-1][0] if len(self.held) == self.k else self.low
        if least is not None:
            at &= scores >= least
        if self.high is not None:
            at &= scores <= self.high
        at = np.flatnonzero(at)
        if len(at) > 4 * self.k and scores.dtype != object:
            at = at[np.lexsort((ids[at], -scores[at]))[: self.k]]
        if len(at):
            new = [(-int(s), int(i)) for s, i in zip(scores[at], ids[at], strict=True)]
            self.held = sorted(self.held + new)[: self.k]


def search(block: Block, anchor: np.ndarray, wanted: np.ndarray, windows: list[Range], first_step: int) -> int:
    """Fill the windows from the wanted rows of a block; returns how many rows were scored."""
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    met, depth, step, scored = ~wanted, 0, first_step, 0
    while depth < block.size:
        threshold = block.threshold(anchor, up, down, depth)
        if all(w.done(threshold) for w in windows):
            break
        upto = min(block.size, depth + step)
        if len(up) or len(down):
            near = np.zeros(block.size, bool)
            near[block.rows[block.size - upto : block.size - depth, up]] = True
            near[block.rows[depth:upto, down]] = True
        else:  # every row scores 0
            near, upto = np.ones(block.size, bool), block.size
        new = np.flatnonzero(near & ~met)
        met[new] = True
        if len(new):
            scores = block.x[new] @ anchor
            if scores.dtype == object:
                scores = np.clip(scores, -LONG, LONG)
            scored += len(new)
            for w in windows:
                if not w.done(threshold):
                    w.take(scores, block.ids[new])
        depth, step = upto, step * 2
    return scored


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of whole numbers as rows of at least ``dims`` columns, filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(dims, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _exact(x: np.ndarray, anchors: np.ndarray) -> bool:
    """Whether all inner products are exact in doubles."""
    most = lambda m: max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    return most(x) * most(anchors) * max(1, x.shape[1]) < EXACT


def _blocks(batches: Iterator[pa.RecordBatch], rows: int, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of at most ``rows`` rows at a time."""
    held: list[pa.RecordBatch] = []
    many = 0

    def packed():
        table = pa.Table.from_batches(held).combine_chunks()
        columns = [table.column(i).chunk(0) if table.column(i).num_chunks else pa.array([], table.schema[i].type) for i in range(3)]
        return columns[0].to_numpy(), columns[1].to_numpy(), _matrix(columns[2], dims)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, rows - many)
            held.append(piece)
            many, at = many + piece.num_rows, at + piece.num_rows
            if many == rows:
                yield packed()
                held, many = [], 0
    if held:
        yield packed()


def _searched(table: DataFrame, anchors: list[tuple], same: bool, settings: Settings) -> DataFrame:
    """(anchor_id, number of the window, score, id): what each task finds; anchors are (id, label, x, [(k, low, high)])."""
    ship_package(table.sparkSession)
    struct = StructType.fromDDL("anchor_id long, number int, score long, id long")
    arrow = to_arrow_schema(struct)
    dims = max((len(a[2]) for a in anchors), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros((len(anchors), dims), np.int64)
        for row, a in zip(known, anchors, strict=True):
            row[: len(a[2])] = a[2]
        windows = [[Range(*w) for w in a[3]] for a in anchors]
        for ids, labels, x in _blocks(batches, settings.block_rows, dims):
            kind = np.float64 if _exact(x, known) else object
            block, wide = Block(ids, labels, x.astype(kind)), np.zeros((len(anchors), x.shape[1]), kind)
            wide[:, :dims] = known
            for k, (number, label, *_) in enumerate(anchors):
                if not windows[k] or (label not in block.label_set if same else block.label_set == {label}):
                    continue
                wanted = (labels == label) & (ids != number) if same else labels != label
                search(block, wide[k], wanted, windows[k], settings.first_step)
        out = [
            (a[0], number, -score, found)
            for a, own in zip(anchors, windows, strict=True)
            for number, w in enumerate(own)
            for score, found in w.held
        ]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return table.mapInArrow(run, struct)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k rows of every group with their rank, by score and then id."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, is_anchor: str = "id % 100 = 0", settings: Settings = Settings()) -> DataFrame:
    """The first negatives of every anchor and positive, from rows (id, label, vector)."""
    spark = rows.sparkSession
    clean = freeze(vectors(rows, settings))
    tasks = max(spark.sparkContext.defaultParallelism, 1 + clean.count() // settings.task_rows)
    table = freeze(clean.repartitionByRange(tasks, "label", "id").sortWithinPartitions("label", "id"))
    path, last = fresh_dir(spark, "negatives"), None
    spark.createDataFrame([], RESULT).write.parquet(path)
    waiting = table.where(is_anchor)
    while True:
        # At most slice_anchors rows.
        part = waiting if last is None else waiting.where(F.col("id") > last)
        anchors = part.orderBy("id").limit(settings.slice_anchors).collect()
        if not anchors:
            break
        _slice(table, anchors, settings).write.mode("append").parquet(path)
        last = anchors[-1]["id"]
    return spark.read.schema(RESULT).parquet(path)


def _slice(table: DataFrame, anchors: list, settings: Settings) -> DataFrame:
    """The result for some anchors: their positives first, then one window per positive."""
    spark = table.sparkSession
    asked = [(a["id"], a["label"], a["x"], [(settings.positives, None, None)]) for a in anchors]
    # At most slice_anchors x positives rows.
    found = _first(_searched(table, asked, True, settings), ["anchor_id"], settings.positives).collect()
    own: dict[int, list[tuple[int, int, int]]] = {}
    for r in found:
        own.setdefault(r["anchor_id"], []).append((r["rank"], r["id"], r["score"]))
    asked, names = [], []
    for a in anchors:
        windows = []
        for number, (_, positive, score) in enumerate(sorted(own.get(a["id"], []))):
            low = -(-settings.least_percent * score // 100)
            windows.append((settings.negatives, low, score) if low <= score else (0, 0, -1))
            names.append((a["id"], number, positive, score))
        asked.append((a["id"], a["label"], a["x"], windows))
    named = spark.createDataFrame(names, "anchor_id long, number int, positive_id long, positive_score long")
    ranked = _first(_searched(table, asked, False, settings), ["anchor_id", "number"], settings.negatives)
    return ranked.join(F.broadcast(named), ["anchor_id", "number"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five hard negatives of every anchor (vec_id divisible by 100) and each of its five positives."""
    moved = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    table = read(spark, sf_dir, "embeddings")
    return hard_negatives(table.select(F.col("vec_id").alias("id"), moved.alias("label"), F.col("embedding").alias("vector")))


PLANS["op11_negatives"] = op11_negatives
SQL["op11_negatives"] = """
WITH fit AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM fit a JOIN fit b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
"""
