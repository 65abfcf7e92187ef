"""Periodic runs: stretches of words that repeat themselves, found by branching tandem repeats in an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and
length >= max(``least_length``, ``least_power`` * q) that no neighbouring word extends.

*Which texts.* In a run at least ``window`` consecutive words (16 for 24 words and three periods) stand again
q words later. A text without a repeated window of that length has no run; only the others get a suffix array.

*Suffix array.* Suffixes are sorted by prefix doubling; every text has word numbers of its own, so
suffixes of several texts share one array and never a prefix. The ranks of all rounds give the
LCP of neighbours.

*Branching tandem test.* Every LCP boundary cuts its interval into two parts, whose suffixes
share just ``depth`` words with those of the other part. For the suffixes i of the smaller part, one
look at ISA[i + depth] and ISA[i - depth] tells whether the other part holds them: then two equal
neighbouring blocks of that length begin there, which no further word continues. That is the last square of a run.
A third equal block must stand before it (again one ISA look). Small parts alone are walked, so the work is
n log n; no tree is built.

*Runs.* The square is rotated to the left while words agree. Squares of two, three ... periods that
end at the same place belong to the run of the shorter period and are merged into it.

Null and empty texts have no words and no runs. Rows are searched one by one, so repeated rows get equal
results; null ids stay. Memory and time grow with the longest text (n log n), never with a group of rows.
Columns of the input pass through; those with the names of result columns are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemodels.llm.common import HashedWords, map_rows, mixed, window_hashes
from lakemodels.llm.plans import PLANS, read

# Suffixes of smaller parts that are looked at together.
LOOKS = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Least length of a run in words and in periods."""

    least_length: int = 24
    least_power: int = 3

    def __post_init__(self):
        if self.least_power < 3 or self.least_length < 1:
            raise ValueError("a run has at least three periods and one word")

    @property
    def window(self) -> int:
        """So many words at least stand again one period later, whatever the period."""
        turn = self.least_length // self.least_power
        return max(1, min(self.least_length - turn, (self.least_power - 1) * (turn + 1)))


Run = tuple[int, int, int]


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, as they stand."""
    return text.encode().split() if text else []


def repeating(texts: list[list[bytes]], known: HashedWords, settings: Settings) -> list[int]:
    """The texts in which a window of ``settings.window`` words occurs twice (and perhaps others, by chance)."""
    size = settings.window
    sizes = np.array([len(words) for words in texts])
    if not len(sizes) or sizes.max() < settings.least_length:
        return []
    ends = np.cumsum(sizes)
    hashes = window_hashes(known.hashes([word for words in texts for word in words]), size)
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = np.arange(len(hashes)) + size <= ends[owner[: len(hashes)]]
    owner = owner[: len(hashes)][inside]
    keys = hashes[inside] + mixed(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    twice = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
    return np.unique(owner[1:][twice]).tolist()


def suffix_array(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(SA, ISA, LCP) of word numbers; ``ends`` holds for every place the end of its text.

    LCP[j] is the number of words that the suffixes SA[j - 1] and SA[j] share. Texts must not share numbers.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    begins = np.ones(n, bool)
    begins[1:] = codes[order][1:] != codes[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    levels, length = [rank.astype(np.int32)], 1
    while True:
        # Only suffixes that still share their rank are sorted again, each group in its own places.
        shared = ~begins
        shared[:-1] |= ~begins[1:]
        places = np.flatnonzero(shared)
        if not len(places):
            break
        some = order[places]
        beyond = some + length
        second = np.where(beyond < ends[some], rank[np.minimum(beyond, n - 1)] + 1, 0)
        first = rank[some]
        by = np.lexsort((second, first))
        some, first, second = some[by], first[by], second[by]
        order[places] = some
        new = np.ones(len(some), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        begins[places] = new
        rank[some] = np.maximum.accumulate(np.where(new, places, 0))
        levels.append(rank.astype(np.int32))
        length *= 2
    lcp = np.zeros(n, np.int64)
    left, right, at = order[:-1], order[1:], np.zeros(max(0, n - 1), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + at, right + at
        there = (a < ends[left]) & (b < ends[right])
        same = there & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        at = np.where(same, at + (1 << k), at)
    lcp[1:] = at
    return order, rank, lcp


def _parts(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each LCP boundary j: its interval is [left, right), its parts are [left, j) and [j, right)."""
    values = lcp.tolist()
    left, right = [0] * len(values), [len(values)] * len(values)
    stack: list[int] = []
    for j, value in enumerate(values):
        while stack and values[stack[-1]] > value:
            right[stack.pop()] = j
        left[j] = stack[-1] if stack else 0
        stack.append(j)
    return np.array(left, np.int64), np.array(right, np.int64)


def tandems(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, depth) of every branching square that a third equal block precedes."""
    left, right = _parts(lcp)
    bounds = np.flatnonzero(lcp > 0)
    n, starts, depths = len(sa), [], []
    small_left = bounds - left[bounds] <= right[bounds] - bounds
    small = np.where(small_left, bounds - left[bounds], right[bounds] - bounds)
    upto = np.cumsum(small)
    at = 0
    while at < len(bounds):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LOOKS, "right")))
        j, many, is_left = bounds[at:stop], small[at:stop], small_left[at:stop]
        first = np.repeat(np.where(is_left, left[j], j) - (np.cumsum(many) - many), many)
        suffix = sa[first + np.arange(len(first))]
        depth = np.repeat(lcp[j], many)
        low, high = np.repeat(np.where(is_left, j, left[j]), many), np.repeat(np.where(is_left, right[j], j), many)
        whole = np.repeat(left[j], many), np.repeat(right[j], many)
        for sign in (1, -1):
            other = suffix + sign * depth
            there = (other >= 0) & (other < n)
            rank = isa[np.where(there, other, 0)]
            square = there & (rank >= low) & (rank < high)
            start, length = np.minimum(suffix, other)[square], depth[square]
            before = start - length
            rank = isa[np.maximum(before, 0)]
            third = (before >= 0) & (rank >= whole[0][square]) & (rank < whole[1][square])
            starts.append(start[third])
            depths.append(length[third])
        at = stop
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *starts]), np.concatenate([empty, *depths])


def rotated(codes: np.ndarray, first: int, start: int, period: int) -> int:
    """The smallest start to which a square can be rotated left, not before ``first``."""
    step = 64
    while start > first:
        at = max(first, start - step)
        same = codes[at:start] == codes[at + period : start + period]
        if not same.all():
            return start - int(same[::-1].argmin())
        start, step = at, step * 2
    return start


def runs_of(texts: list[list[bytes]], known: HashedWords | None = None, settings: Settings = Settings()) -> list[list[Run]]:
    """(start, length, period) of the runs of every text, by start, then period."""
    found: list[list[Run]] = [[] for _ in texts]
    chosen = repeating(texts, HashedWords() if known is None else known, settings)
    if not chosen:
        return found
    numbers: list[np.ndarray] = []
    used = 0
    for k in chosen:
        own: dict[bytes, int] = {}
        numbers.append(np.fromiter((own.setdefault(word, len(own)) for word in texts[k]), np.int64, len(texts[k])) + used)
        used += len(own)
    sizes = np.array([len(x) for x in numbers])
    ends = np.cumsum(sizes)
    codes, firsts = np.concatenate(numbers), ends - sizes
    starts, depths = tandems(*suffix_array(codes, np.repeat(ends, sizes)))
    by = np.lexsort((starts, depths))
    at_end: dict[int, list[tuple[int, int]]] = {}
    for start, period in zip(starts[by].tolist(), depths[by].tolist(), strict=True):
        end = start + 2 * period
        if any(s <= start and period % q == 0 for s, q in at_end.get(end, ())):
            continue
        text = int(np.searchsorted(ends, start, "right"))
        begin = rotated(codes, int(firsts[text]), start - period, period)
        at_end.setdefault(end, []).append((begin, period))
        if end - begin >= max(settings.least_length, settings.least_power * period):
            found[chosen[text]].append((begin - int(firsts[text]), end - begin, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[Run]) -> str:
    """The words without those that any run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words).decode()
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept)]).decode()


ADDED = "runs array<struct<start:int,length:int,period:int>>, collapsed string"


def periodic_runs(documents: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Add ``runs`` (by start, then period) and ``collapsed``, the text with one period left of each run."""
    kept = documents.drop(*[c for c in documents.columns if c.lower() in ("runs", "collapsed")])
    names = kept.columns

    def start():
        known = HashedWords()

        def work(part):
            texts = [words_of(value) for value in part[text]]
            found = runs_of(texts, known, settings)
            out = {name: part[name] for name in names}
            out["runs"] = [[dict(zip(("start", "length", "period"), run, strict=True)) for run in runs] for runs in found]
            out["collapsed"] = [collapsed(words, runs) for words, runs in zip(texts, found, strict=True)]
            return out

        return work

    return map_rows(kept, StructType(kept.schema.fields + StructType.fromDDL(ADDED).fields), start)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, text): in one of ten texts, chosen by a checksum of the id, the words from some place on repeat."""
    numbered = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = numbered.withColumn("w", F.expr(r"CASE WHEN h % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END"))
    sized = words.select("*", F.expr("nullif(size(w), 0)").alias("n"), F.expr("h div 10").alias("g"))
    placed = sized.withColumn("a", F.expr("CAST(g % n AS int)")).withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS int)"))
    repeated = F.expr(
        "array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), CAST(1 + (n - a) div p AS int))), 1, n - a)), ' ')"
    )
    return placed.select("doc_id", F.when(F.coalesce(F.col("n") > 0, F.lit(False)), repeated).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, the run of greatest exponent, digests of all runs and of the collapsed text, for every document."""
    found = periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    # Runs come by start, then period, so only a greater exponent replaces the run held; lengths and periods are multiplied as longs.
    best = F.expr(
        "aggregate(runs, CAST(null AS struct<start:int,length:int,period:int>), (held, run) -> "
        "CASE WHEN held IS NULL OR CAST(run.length AS long) * held.period > CAST(held.length AS long) * run.period THEN run ELSE held END)"
    )
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.select("doc_id", "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").cast("long").alias(name) for name in ("start", "length", "period")],
        F.expr("1000L * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


PLANS["op12_runs"] = op12_runs
