"""Benchmark decontamination by templates: also finds questions whose numbers, names or units were changed.

*Templates.* A text becomes words without edge punctuation, in lower case, in which numbers,
numbers with a unit, and names (capitalised words inside a sentence) are typed placeholders; the
values they stand for are its slots. Since a copy may have lost its capitals, a second template
keeps names as words.

*Join.* Every run of template words of a benchmark item that is as long as the share of it which decides
(``words`` at most, ``least_words`` at least) is a window, and so is every run of ``least_words`` words: several of them at one distance
find an item with some words changed. One with more values than plain words (arithmetic, sequences, tables) is hashed
with its numbers as they stand, so that it meets exact copies only. Document windows join item windows by hash.
Before that shuffle a Bloom filter of fixed size drops windows that no item has; it can let
windows through but loses none, and being a fixed number of bits it may be broadcast. A second one holds the
runs of ``least_words`` words of all items: a document hashes its runs once, and larger windows only where
all runs inside pass.

*Slots.* Windows of a document and an item at one distance belong together. They count if their
slots fit: each value of the item stands for one value of the document and the other way round.

*Verdict.* The words of the item that counted windows cover are at least ``least_share`` of it, or
``enough_words``. An item of fewer than ``least_words`` words is not searched for.

Null and empty texts have no windows. Null ids are left out of the result. Rows that share a
doc_id are one document with several texts; repeated items are found as often as they are listed
under different ids. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from array import array
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemodels.llm.common import bloom_of, freeze, in_bloom, map_rows, mixed
from lakemodels.llm.plans import PLANS, read

WORDS = 12
LEAST_WORDS = 5
LEAST_SHARE = 0.5
ENOUGH_WORDS = 20
BLOOM_BITS = 1 << 23

# Words and signs that are a unit behind a number.
UNITS = set(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml cl l liter liters litre "
    "litres gallon gallons cup cups s sec min h hr hrs second seconds minute minutes hour hours day days week weeks month "
    "months year years dollar dollars cent cents euro euros usd eur percent degree degrees km/h mph kmh hz khz mhz ghz w kw "
    "v kb mb gb tb % ° °c °f € $ £".split()
)

_EDGE = " \t\r\n\f\v.,;:!?\"'()[]{}<>«»“”„‘’…*#&|~`^_=-–—/\\"
_NUMBER = re.compile(r"[-+]?[€$£]?\d+(?:[.,:/]\d+)*")
_QUANTITY = re.compile(r"([-+]?[€$£]?\d+(?:[.,]\d+)*)([^\W\d_]+|[%°€$£]|°[cfCF])")
_SKIP, _WORD, _NUM, _QTY, _UNIT = range(5)
_KIND, _CAPITAL, _END = 7, 8, 16
# What may stand behind the end of a sentence, and the ends.
_BEHIND, _ENDS = "\"')]»”’*#&%$|", (".", "!", "?", ":")


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode())


_NUM_HASH, _QTY_HASH, _NAME_HASH = (np.uint64(_hash(f"\0{kind}")) for kind in ("number", "quantity", "name"))


class TemplateWords(dict):
    """Remembers kind, case and hash of every word met, by number; forgets all when it holds too many."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit
        self._flags = array("B")
        self._hashes = array("Q")

    def __missing__(self, word: str) -> int:
        core = word.strip(_EDGE)
        lowered = core.lower()
        if core.isalpha():
            flags = _UNIT if lowered in UNITS else _WORD
            if core is not word and word.rstrip(_BEHIND).endswith(_ENDS):
                flags |= _END
            if core.istitle():
                flags |= _CAPITAL
        else:
            core = core_of(word)
            lowered = core.lower()
            flags = kind_of(core) | (_END if word.rstrip(_BEHIND).endswith(_ENDS) else 0)
        number = self[word] = len(self._flags)
        self._flags.append(flags)
        self._hashes.append(_hash(lowered))
        return number

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flags, hashes) of words: kind in the lower bits, then whether it is capitalised and whether a sentence ends."""
        if len(self) > self.limit:
            self.clear()
            self._flags, self._hashes = array("B"), array("Q")
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if not len(numbers):
            return np.zeros(0, np.uint8), np.zeros(0, np.uint64)
        return np.frombuffer(self._flags, np.uint8)[numbers], np.frombuffer(self._hashes, np.uint64)[numbers]


def core_of(word: str) -> str:
    core = word.strip(_EDGE)
    return core or (word if word in UNITS else "")


def kind_of(core: str) -> int:
    if not core:
        return _SKIP
    if _NUMBER.fullmatch(core):
        return _NUM
    found = _QUANTITY.fullmatch(core)
    if found and found[2].lower() in UNITS:
        return _QTY
    return _UNIT if core.lower() in UNITS else _WORD


@cache
def _factors(size: int) -> np.ndarray:
    return mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Template:
    """The two templates of a text: hashes of its words with and without typed names, and its slots."""

    def __init__(self, known: TemplateWords, text: str | None):
        self.raw = text.split() if text else []
        flags, hashes = known.of(self.raw)
        kinds = flags & _KIND
        before = np.concatenate([[_SKIP], kinds[:-1]]) if len(kinds) else kinds
        unit = (kinds == _UNIT) & (before == _NUM)
        if unit.any():
            kinds[np.flatnonzero(unit) - 1] = _QTY
        ends = flags & _END > 0
        opened = np.concatenate([[True], ends[:-1]]) if len(kinds) else ends
        name = (flags & _CAPITAL > 0) & ~opened & ((kinds == _WORD) | (kinds == _UNIT))
        kept = np.flatnonzero((kinds != _SKIP) & ~unit)
        self.at = kept
        literal = hashes.copy()
        measured = np.flatnonzero(unit) - 1
        literal[measured] = hashes[measured] * np.uint64(3) + hashes[measured + 1]
        kinds, name, plain = kinds[kept], name[kept], hashes[kept]
        self.literal = literal[kept]
        plain = np.where(kinds == _NUM, _NUM_HASH, np.where(kinds == _QTY, _QTY_HASH, plain))
        self.value = (kinds == _NUM) | (kinds == _QTY)
        self.name = name
        self.plain = plain
        self.typed = np.where(name, _NAME_HASH, plain)
        self._values, self._names = (np.concatenate([[0], np.cumsum(m)]) for m in (self.value, name & ~self.value))

    def __len__(self) -> int:
        return len(self.plain)

    def windows(self, size: int):
        """(63-bit hashes, positions, typed?) of the windows of a size.

        Windows with more values than plain words say too little as a template: their words are taken literally.
        """
        n = len(self) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        values, names = (total[size:] - total[:-size] for total in (self._values, self._names))
        typed = 2 * (values + names) <= size
        dense = 2 * values > size
        plain = ~dense & ((names > 0) | ~typed)
        hashes, positions, kinds = [], [], []
        for words, chosen in ((self.typed, typed), (self.plain, plain), (self.literal, dense)):
            at = np.flatnonzero(chosen)
            if len(at):
                hashes.append(_run_hashes(words, size, at))
                positions.append(at)
                kinds.append(np.full(len(at), chosen is typed))
        return np.concatenate(hashes), np.concatenate(positions), np.concatenate(kinds)

    def runs(self, size: int) -> np.ndarray:
        """63-bit hashes of all runs of a size in the three readings of the words."""
        return np.concatenate([_run_hashes(words, size, None) for words in (self.typed, self.plain, self.literal)])

    def found(self, sizes: list[int], size: int, runs: np.ndarray, windows: np.ndarray) -> list[tuple[int, int, int, bool]]:
        """(size, hash, position, typed?) of the windows that the filters let through.

        ``size`` is that of the filter ``runs``. Readings differ only where a run holds a name or a value, so the
        second and third are looked at there alone.
        """
        out: list[tuple[int, int, int, bool]] = []
        values, names = (total[size:] - total[:-size] for total in (self._values, self._names))
        passed = np.zeros(len(values), bool)
        for reading, words, differs in ((0, self.typed, None), (1, self.plain, names > 0), (2, self.literal, values > 0)):
            at = None if differs is None else np.flatnonzero(differs)
            if at is None or len(at):
                hit = _let_through(runs, _run_hashes(words, size, at))
                passed = passed.copy()
                if at is not None:
                    passed[at] = False
                passed[hit if at is None else at[hit]] = True
            elif reading:
                continue
            begins = np.flatnonzero(passed)
            if not len(begins):
                continue
            fails = np.append(np.flatnonzero(~passed), len(passed))
            streak = fails[np.searchsorted(fails, begins)] - begins
            for wanted in sizes:
                place = begins[streak > wanted - size]
                if not len(place):
                    continue
                value, name = (total[place + wanted] - total[place] for total in (self._values, self._names))
                typed, dense = 2 * (value + name) <= wanted, 2 * value > wanted
                place = place[(typed, ~dense & ((name > 0) | ~typed), dense)[reading]]
                if len(place):
                    hashes = _run_hashes(words, wanted, place)
                    kept = _let_through(windows, hashes)
                    out += [(wanted, h, p, reading == 0) for h, p in zip(hashes[kept].tolist(), place[kept].tolist(), strict=True)]
        return out

    def slots(self, position: int, size: int, typed: bool) -> list[str]:
        """The values behind the placeholders of a window, with their kind."""
        out = []
        for i in range(position, position + size):
            at = int(self.at[i])
            if self.value[i]:
                end = int(self.at[i + 1]) if i + 1 < len(self.at) else len(self.raw)
                out.append("n:" + "".join(core_of(w).lower() for w in self.raw[at:end]))
            elif typed and self.name[i]:
                out.append("a:" + core_of(self.raw[at]).lower())
        return out


def _run_hashes(words: np.ndarray, size: int, at: np.ndarray | None) -> np.ndarray:
    """63-bit hashes of the runs of a size, at some places or at all."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    total = np.zeros(n if at is None else len(at), np.uint64)
    for i, factor in enumerate(_factors(size)):
        total += (words[i : i + n] if at is None else words[at + i]) * factor
    return (mixed(total) >> np.uint64(1)).astype(np.int64)


def window_size(n_words: int, words: int, least_words: int, least_share: float) -> int:
    """Words of the windows of an item: whatever single word is changed, a run of so many is left."""
    return min(words, max(least_words, math.ceil((n_words - 1) * least_share)))


def _let_through(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the values that the filter may hold; most drop out by their first bit."""
    bit = hashes & np.int64(64 * len(bloom) - 1)
    at = np.flatnonzero((bloom[bit >> 6] >> (bit & 63)) & 1)
    return at[in_bloom(bloom, hashes[at])]


_WINDOW = "id long, n_words int, size int, hash long, position int, slots array<string>"


def _mapped(texts: DataFrame, least: int, windows_of) -> DataFrame:
    """Rows of _WINDOW for every text (id, text) of at least ``least`` words; ``windows_of`` gives (size, hash, position, typed?)."""

    def start():
        known = TemplateWords()

        def work(part):
            out: dict[str, list] = {k: [] for k in ("id", "n_words", "size", "hash", "position", "slots")}
            for number, text in zip(part["id"], part["text"], strict=True):
                template = Template(known, text)
                if number is None or len(template) < least:
                    continue
                for size, h, p, t in windows_of(template):
                    out["id"].append(number)
                    out["n_words"].append(len(template))
                    out["size"].append(size)
                    out["hash"].append(h)
                    out["position"].append(p)
                    out["slots"].append(template.slots(p, size, t))
            return out

        return work

    return map_rows(texts, _WINDOW, start)


def _item_windows(items: DataFrame, words: int, least_words: int, least_share: float) -> DataFrame:
    """Windows of the size that an item's length asks for, and of the least size."""

    def windows_of(template: Template):
        for size in sorted({least_words, window_size(len(template), words, least_words, least_share)}):
            yield from ((size, *w) for w in zip(*(column.tolist() for column in template.windows(size)), strict=True))

    return _mapped(items, least_words, windows_of)


def _item_runs(items: DataFrame, size: int) -> DataFrame:
    """(hash) of every run of a size."""

    def start():
        known = TemplateWords()

        def work(part):
            made = [Template(known, text).runs(size) for number, text in zip(part["id"], part["text"], strict=True) if number is not None]
            return {"hash": np.concatenate([np.zeros(0, np.int64), *made])}

        return work

    return map_rows(items, "hash long", start)


def _document_windows(texts: DataFrame, sizes: list[int], size: int, runs: np.ndarray, windows: np.ndarray) -> DataFrame:
    return _mapped(texts, size, lambda template: template.found(sizes, size, runs, windows))


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    words: int = WORDS,
    least_words: int = LEAST_WORDS,
    least_share: float = LEAST_SHARE,
    enough_words: int = ENOUGH_WORDS,
) -> DataFrame:
    """(doc_id, item_id, item_words, matched_words, n_windows, exact, position) of every document and item found in it.

    ``exact``: the matched slots have the item's own values. ``position``: template word where the first match begins.
    """
    wanted = benchmark.select(F.col("item_id").cast("long").alias("id"), "text")
    items = freeze(_item_windows(wanted, words, least_words, least_share))
    # At most words - least_words + 1 sizes.
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    filters = bloom_of(_item_runs(wanted, least_words), "hash", BLOOM_BITS), bloom_of(items, "hash", BLOOM_BITS)
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text")
    found = _document_windows(texts, sizes, least_words, *filters)
    found = found.select(F.col("id").alias("doc_id"), "size", "hash", "position", F.col("slots").alias("there"))
    wanted = items.select(
        F.col("id").alias("item_id"), F.col("n_words").alias("item_words"), "size", "hash", F.col("position").alias("at"), "slots"
    )
    met = found.join(wanted, ["hash", "size"]).where(F.size("there") == F.size("slots"))
    # A document that holds an item has one row per window here, so a group is as long as the item at most.
    # Sizes are judged apart: short windows that do not fit say nothing against a long one that does.
    diagonal = met.groupBy("doc_id", "item_id", "item_words", "size", (F.col("position") - F.col("at")).alias("distance")).agg(
        F.collect_set(F.struct("at", "size")).alias("windows"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("slots", "there")))).alias("pairs"),
        F.min("position").alias("position"),
    )
    one_to_one = (F.size(F.array_distinct("pairs.slots")) == F.size("pairs")) & (
        F.size(F.array_distinct("pairs.there")) == F.size("pairs")
    )
    whole = (
        diagonal.where(one_to_one)
        .groupBy("doc_id", "item_id", "item_words")
        .agg(
            F.array_distinct(F.flatten(F.collect_set("windows"))).alias("windows"),
            F.min(F.forall("pairs", lambda p: p["slots"] == p["there"])).alias("exact"),
            F.min("position").alias("position"),
        )
    )
    covered = F.size(
        F.array_distinct(
            F.flatten(F.transform("windows", lambda w: F.sequence(w["at"], w["at"] + w["size"] - 1)))
        )
    )
    enough = F.least(F.ceil(F.col("item_words") * least_share), F.lit(enough_words))
    return (
        whole.withColumn("matched_words", covered)
        .where(F.col("matched_words") >= enough)
        .select(
            "doc_id", "item_id", "item_words", "matched_words", F.size("windows").alias("n_windows"), "exact", "position"
        )
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


PLANS["op6_decontamination"] = op6_decontamination
