"""SimHash fingerprints, the likeness of neighbours, and all fingerprints within a Hamming radius.

*Fingerprint.* The terms of a text are its runs of three lower-cased words (all words, if there are
fewer). Each term has a 256-bit hash and a weight, sixteen times 1 + ln(count) rounded down; it votes
with its weight for or against every bit. Two texts that share half of their terms agree in two
thirds of the bits, unrelated ones in half. Likeness is the share of equal bits. Equal texts have
equal fingerprints; a text without words has no votes, so all its bits are zero.

*Neighbours.* Rows are dealt by ranges of doc_id and sorted inside the ranges, so that a row's next
document follows it in its task. Only the first and last row of each range meet again, by range number.

*Search.* A fingerprint is cut into radius + 1 blocks. Two within the radius agree in one block at
least, so one table per block, that block in front as key, finds every pair; full distances decide.
Equal fingerprints are one entry, and only the asked fingerprints probe the tables. Of the tables only the
entries go to the join whose block a Bloom filter of the asked blocks holds; it has a fixed size and loses none.

Null texts are empty. In the order of documents null ids come last; rows with one doc_id follow
each other by a hash of their text. A document without a next one is its own next. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakemodels.llm.common import SLICE_ROWS, HashedWords, ascii_words, bloom_of, freeze, in_bloom, map_rows, mixed, window_hashes
from lakemodels.llm.plans import PLANS, read
from lakemodels.sources.workspace import ship_package

TERM_WORDS = 3
BITS = 256
RADIUS = 8
_ROUNDS = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
_CHUNK = 4096
# Bits of the filter of asked blocks (2 MB).
ASKED_BITS = 1 << 24


class Fingerprints:
    """Makes fingerprints; remembers the hashes of words."""

    def __init__(self, size: int = TERM_WORDS):
        self.size = size
        self.numbered = HashedWords()

    def of(self, text: str | None) -> bytes:
        words = ascii_words(text)
        if not words:
            return bytes(BITS // 8)
        terms = window_hashes(self.numbered.hashes(words), min(self.size, len(words)))
        terms, counts = np.unique(terms, return_counts=True)
        weights = np.floor(16 * (1 + np.log(counts))).astype(np.float32)
        votes = np.zeros(BITS, np.int64)
        for at in range(0, len(terms), _CHUNK):
            # Whole numbers below 2^24, so the sums of a chunk are exact.
            hashes = mixed(terms[at : at + _CHUNK, None] + _ROUNDS)
            bits = np.unpackbits(np.ascontiguousarray(hashes.astype("<u8")).view(np.uint8), axis=1)
            votes += (weights[at : at + _CHUNK] @ bits.astype(np.float32)).astype(np.int64)
        return np.packbits(2 * votes > int(weights.sum(dtype=np.float64))).tobytes()


def likeness(left: bytes, right: bytes) -> float:
    return 1 - (int.from_bytes(left) ^ int.from_bytes(right)).bit_count() / BITS


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many code points of the next one, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
RESULT_NAMES = [part.split()[0] for part in RESULT.split(", ")]
# kind 0: finished row; 1: last row of a range, still without its next one; 2: first row of a range.
_PASSED = f"{RESULT}, kind int, part int, text string"


def _finished(prints: Fingerprints, doc_id, text: str, own: bytes, following: str, next_print: bytes) -> dict:
    changed = edited(text, following)
    other = prints.of(changed)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": own.hex(),
        "edited_fingerprint": other.hex(),
        "near_edited": likeness(own, other),
        "near_next": likeness(own, next_print),
    }


def with_next(documents: DataFrame) -> DataFrame:
    """The result columns for every row of (doc_id, text), the next document being the next smaller doc_id."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(F.desc_nulls_last("doc_id")).sortWithinPartitions(
        F.desc_nulls_last("doc_id"), F.xxhash64("text")
    )
    struct = T.StructType.fromDDL(_PASSED)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, part, last = Fingerprints(), TaskContext.get().partitionId(), None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                out = []
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    own = prints.of(text)
                    if last is None:
                        out.append({"kind": 2, "part": part, "text": text, "fingerprint": own.hex()})
                    else:
                        out.append(_finished(prints, *last, text, own) | {"kind": 0})
                    last = (doc_id, text, own)
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if last is not None:
            end = {"kind": 1, "part": part, "doc_id": last[0], "text": last[1], "fingerprint": last[2].hex()}
            yield pa.RecordBatch.from_pylist([end], schema=arrow)

    passed = freeze(dealt.mapInArrow(run, struct))
    heads = passed.where("kind = 2").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    # One number per range, not rows: this fits one task.
    parts = heads.select("part")
    order = Window.orderBy("part")
    following = parts.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next"))
    ends = (
        passed.where("kind = 1").select("part", "doc_id", "text", "fingerprint")
        .join(following, "part")
        .join(heads.withColumnRenamed("part", "next"), "next")
        .select("doc_id", "text", "fingerprint", "next_text", "next_print")
    )
    # One row per range: the finished rows are fixed already, so nothing has to be kept twice.
    return passed.where("kind = 0").select(*RESULT_NAMES).unionByName(freeze(map_rows(ends, RESULT, _ends)))


def _ends():
    prints = Fingerprints()

    def work(part):
        made = [
            _finished(prints, doc_id, text, bytes.fromhex(own), following, bytes.fromhex(next_print))
            for doc_id, text, own, following, next_print in zip(*part.values(), strict=True)
        ]
        return {name: [m[name] for m in made] for name in RESULT_NAMES}

    return work


def _kept_keys(tables: DataFrame, bloom: np.ndarray) -> DataFrame:
    """(fingerprint, keys) with only those keys that the filter may hold."""
    ship_package(tables.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("keys")
            inside = in_bloom(bloom, lists.flatten().to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())[inside]
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            kept = pa.ListArray.from_arrays(pa.array(ends), lists.flatten().filter(pa.array(inside)))
            some = np.diff(ends) > 0
            yield pa.RecordBatch.from_arrays([batch.column("fingerprint"), kept], ["fingerprint", "keys"]).filter(pa.array(some))

    return tables.mapInArrow(run, "fingerprint string, keys array<long>")


def within(asked: DataFrame, fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (asked, found, distance) of fingerprints (hexadecimal) at most ``radius`` bits apart.

    Both inputs have a column ``fingerprint``; equal entries count once.
    """
    width = BITS // 4 // (radius + 1)
    if width < 1:
        raise ValueError(f"A radius of {radius} leaves no block of whole digits")
    blocks = F.transform(
        F.sequence(F.lit(0), F.lit(radius)), lambda i: F.xxhash64(i, F.substr("fingerprint", i * width + 1, F.lit(width)))
    )

    def tables(df: DataFrame) -> DataFrame:
        return df.select("fingerprint").where("fingerprint is not null").distinct().select("fingerprint", blocks.alias("keys"))

    def entries(df: DataFrame, name: str) -> DataFrame:
        words = [F.conv(F.substr("fingerprint", F.lit(i * 16 + 1), F.lit(16)), 16, -10).cast("long") for i in range(BITS // 64)]
        return df.select(F.explode("keys").alias("key"), F.array(*words).alias(name))

    probes = tables(asked)
    bloom = bloom_of(probes.select(F.explode("keys").alias("key")), "key", ASKED_BITS)
    held = _kept_keys(tables(fingerprints), bloom)
    distance = F.aggregate(
        F.zip_with("asked", "found", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, d: s + d
    )
    digits = lambda name: F.lower(F.array_join(F.transform(name, lambda w: F.lpad(F.hex(w), 16, "0")), ""))
    return (
        entries(held, "found")
        .join(entries(probes, "asked"), "key")
        .withColumn("distance", distance)
        .where(F.col("distance") <= radius)
        .select("asked", "found", "distance")
        .distinct()
        .select(digits("asked").alias("asked"), digits("found").alias("found"), "distance")
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result columns for every document, and ``n_within`` for those with an id divisible by 50.

    ``n_within`` counts the documents, itself included, whose fingerprint is within the radius.
    """
    rows = with_next(read(spark, sf_dir, "documents"))
    is_asked = F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))
    asked = rows.where(is_asked)
    counts = rows.groupBy("fingerprint").agg(F.count("*").alias("n"))
    near = within(asked, rows).join(counts.withColumnRenamed("fingerprint", "found"), "found")
    near = near.groupBy(F.col("asked").alias("fingerprint")).agg(F.sum("n").alias("n_within"))
    # Only the asked rows meet their numbers; the others go by.
    others = rows.where(~is_asked).select(*RESULT_NAMES, F.lit(None).cast("long").alias("n_within"))
    return asked.join(near, "fingerprint", "left").select(*RESULT_NAMES, "n_within").unionByName(others)


PLANS["op9_simhash"] = op9_simhash
