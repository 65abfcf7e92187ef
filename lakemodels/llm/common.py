"""What several operators share: Arrow passes over texts, hashed words, connected components."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakemodels.sources.workspace import freeze, ship_package

# Rows turned into Python objects at a time, so that a worker holds few texts at once.
SLICE_ROWS = 128


def map_rows(df: DataFrame, schema: str | T.StructType, start: Callable[[], Callable[[dict[str, list]], dict[str, list]]]) -> DataFrame:
    """Run Python over slices of a frame inside tasks.

    ``start`` is called once per task and gives a function from the columns of a
    slice (lists by name) to the columns of its output rows (lists or arrays by name).
    """
    ship_package(df.sparkSession)
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                out = work({name: part.column(i).to_pylist() for i, name in enumerate(names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


class HashedWords(dict):
    """Remembers the 64-bit hash of every word met, by number; forgets all when it holds too many."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit
        self._hashes = array("Q")

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self._hashes)
        self._hashes.append(xxhash.xxh3_64_intdigest(word))
        return number

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """The hash of each word."""
        if len(self) > self.limit:
            self.clear()
            self._hashes = array("Q")
        if not words:
            return np.zeros(0, np.uint64)
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(self._hashes, np.uint64)[numbers]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (an invertible mix of shifts and odd factors)."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def _odd_factors(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words; empty if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(_odd_factors(size)):
        total += hashes[i : i + n] * factor
    return mixed(total)


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text after A-Z are lower-cased: runs without ASCII white space."""
    return text.encode().lower().split() if text else []


def compact(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Write a frame to the shared folder and read it with about ``rows`` rows per partition.

    Work on few rows then makes few shuffle files, however many partitions the step before it had.
    """
    df = freeze(df)
    wanted = 1 + df.count() // rows
    return df.coalesce(wanted) if wanted < df.rdd.getNumPartitions() else df


def bloom_of(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A Bloom filter of the values of a long column, folded in Spark.

    ``bits`` fixes its size whatever the column holds: at most bits / 64 rows reach the driver, and the
    array may be sent to every task. A full filter lets more through, it never loses a value.
    """
    value = F.col(column)
    places = F.array(*[F.pmod(F.shiftright(value, by), F.lit(bits)) for by in _BLOOM_SHIFTS])
    rows = (
        df.select(F.explode(places).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits"))
    )
    out = np.zeros(bits // 64, np.int64)
    for at, word in rows.collect():
        out[at] = word
    return out


# Two numbers are taken from a value: itself and its upper part.
_BLOOM_SHIFTS = (0, 30)


def in_bloom(bloom: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values the filter may hold."""
    found = np.ones(len(values), bool)
    for by in _BLOOM_SHIFTS:
        bit = (values >> by) % (64 * len(bloom))
        found &= (bloom[bit >> 6] >> (bit & 63)) & 1 == 1
    return found


def connected(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components: (node, component), component being the smallest node of it.

    Alternates two steps until nothing changes: every node hands the smallest of its
    neighbours to the larger ones, then to the smaller ones. Both only take a minimum
    per node, so a hub is folded before the shuffle; each round is written to the shared
    folder. The number of rounds grows with the logarithm of the longest path.
    """
    pairs = edges.select(
        F.least(left, right).cast("long").alias("lo"), F.greatest(left, right).cast("long").alias("hi")
    ).where("lo < hi")
    pairs = compact(pairs.distinct())
    parts = max(1, pairs.rdd.getNumPartitions())
    while True:
        both = pairs.select(F.col("lo").alias("node"), F.col("hi").alias("other")).unionByName(
            pairs.select(F.col("hi").alias("node"), F.col("lo").alias("other"))
        )
        least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        large = (
            both.where("other > node").join(least, "node").select(F.col("other").alias("node"), "least").distinct()
        )
        large = freeze(large.where("least < node").coalesce(parts))
        low = large.groupBy("node").agg(F.min("least").alias("least"))
        small = large.withColumnRenamed("least", "other").join(low, "node")
        new = freeze(
            small.select(F.when(F.col("other") > F.col("least"), F.col("other")).otherwise(F.col("node")).alias("hi"), F.col("least").alias("lo"))
            .where("lo < hi")
            .distinct()
            .coalesce(parts)
        )
        settled = new.count() == pairs.count() and new.exceptAll(pairs.select("hi", "lo")).isEmpty()
        if settled:
            break
        pairs = new.select("lo", "hi")
    members = new.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("node"), "component").distinct())


__all__ = [
    "HashedWords",
    "ascii_words",
    "bloom_of",
    "compact",
    "connected",
    "freeze",
    "in_bloom",
    "map_rows",
    "mixed",
    "window_hashes",
]
