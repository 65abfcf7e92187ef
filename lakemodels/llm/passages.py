"""Substring deduplication: passages that repeat across documents, found by collinear chaining.

1. *Seeds.* Of every run of ``window`` consecutive k-mers of words (``kmer`` words each) the one with the
   least hash is a seed, so an exact repeat longer than both together has a seed in every window.
2. *Matches.* Seeds are grouped by hash. The occurrences of a seed that occurs ``plain`` times at most are all
   paired. The occurrences of a more frequent one are matched with those in the smallest and in the largest
   doc_id, so a passage that a million documents share makes two million matches. As these two may hold only a
   part of what others share, frequent seeds are taken again with so many words after them as any passage has
   after its first seed (``window_matches``): rare ones are all paired, frequent ones are matched by whole windows
   of ``least_words`` words: documents with the same windows there are linked to the smallest of them, and this
   one to the smallest document that has the window. What this leaves out is matched in all pairs (5).
3. *Chains.* The matches of two documents are merged to segments (same distance, small step) and chained: a
   chain adds up the words of segments that follow each other in both documents, less a cost per word of the
   gaps between them. The best predecessor of a segment is a prefix maximum in a Fenwick tree.
4. *Alignment.* Chains that may be long enough get the words of both documents around them. Gaps count their
   longest common subsequence, both ends are extended word by word. A passage is kept if it has at least
   ``least_words`` words in both documents and that share of them is matched (``least_share``).
5. *The rest.* Two seeds of a text, ``least_words`` apart at most, that no found passage holds and of which one is frequent
   are a key. All documents that have both in this order are matched with those in which they are left; these matches go through 3 and 4
   too (``left_matches``).

The result has a row per passage: (doc_id, start, end, other_id, other_start, other_end, matched, share), places
counted in words (runs without ASCII white space, A-Z taken as a-z), ends exclusive.

Null and empty texts have no seeds; a null doc_id is left out. Rows that share a doc_id are not matched with each
other. Repeats within one document are no link between documents and are not reported; each copy of a passage that
another document has is. Other columns are ignored. So whatever pairing all occurrences of all seeds would find,
its words are in a reported passage of their document: with that other document, or, if all its seeds are in passages found before, with documents
that have those.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemodels.llm.common import HashedWords, ascii_words, bloom_of, compact, freeze, in_bloom, map_rows, mixed, window_hashes
from lakemodels.llm.plans import PLANS, read
from lakemodels.sources.workspace import written

KMER = 6
WINDOW = 12
LEAST_WORDS = 50
LEAST_SHARE = 0.8
GAP_COST = 0.12
# Words are sent to the alignment in blocks of so many, with a margin around the chain.
BLOCK = 64
MARGIN = 24
# All occurrences of a seed are paired up to so many.
PLAIN = 8
# Bits of the filter of documents with frequent seeds (2 MB).
CROWDED_BITS = 1 << 24


def winnowed(hashes: np.ndarray, kmer: int = KMER, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the seeds of a text: the least k-mer of every window, the rightmost of equal ones."""
    grams = window_hashes(hashes, kmer) >> np.uint64(1)
    n = len(grams)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n <= window:
        at = np.array([n - 1 - int(np.argmin(grams[::-1]))])
    else:
        views = sliding_window_view(grams[::-1], window)[::-1]
        at = np.unique(np.arange(n - window + 1) + window - 1 - np.argmin(views, axis=1))
    return grams[at].astype(np.int64), at


def seeds(documents: DataFrame, kmer: int, window: int) -> DataFrame:
    """(doc, hash, pos, at, again) of the seeds of every text: number in the text, and whether an equal one came before."""

    def start():
        numbered = HashedWords()

        def work(part):
            out: dict[str, list] = {"doc": [], "hashes": [], "places": []}
            for doc, text in zip(part["doc_id"], part["text"], strict=True):
                if doc is None:
                    continue
                hashes, places = winnowed(numbered.hashes(ascii_words(text)), kmer, window)
                again = np.ones(len(hashes), np.int64)
                again[np.unique(hashes, return_index=True)[1]] = 0
                out["doc"].append(doc)
                out["hashes"].append(hashes)
                # One number for all three: it is shuffled with every seed.
                out["places"].append(places.astype(np.int64) << 32 | np.arange(len(hashes)) << 1 | again)
            return out

        return work

    found = map_rows(documents.select("doc_id", "text"), "doc long, hashes array<long>, places array<long>", start)
    return found.select("doc", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select(
        "doc", F.col("s.hashes").alias("hash"), F.col("s.places").alias("place")
    )


def shared_seeds(found: DataFrame) -> DataFrame:
    """The seeds (doc, hash, place) of several documents, with the smallest and the largest of these and the number of places."""
    # Dealt once for both uses; the count names ``place`` so that both read the same columns.
    found = found.repartition("hash")
    ends = found.groupBy("hash").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("place").alias("n"))
    return written(found.join(ends.where("lo < hi"), "hash"), "passages-seeds").select(
        "doc", "hash", F.shiftright("place", 32).cast("int").alias("pos"),
        F.shiftright(F.col("place").bitwiseAND(2**32 - 1), 1).cast("int").alias("at"),
        (F.col("place").bitwiseAND(1) == 1).alias("again"), "lo", "hi", "n",
    )


def matches(documents: DataFrame, found: DataFrame, kmer: int, window: int, least_words: int, plain: int = PLAIN) -> DataFrame:
    """Equal words (doc, pos, other, other_pos, words, down, again) of two documents, of which the greater comes first.

    ``down``: the other one is the smallest document of all that have these words. ``again``: they are at a further place of
    one of the documents; such matches have chains of their own. Frequent seeds meet two documents here and
    whole windows; :func:`left_matches` pairs what of them is not in a passage then.
    """
    return _matches(documents, shared_seeds(found), kmer, window, least_words, plain)


def _matches(documents: DataFrame, shared: DataFrame, kmer: int, window: int, least_words: int, plain: int) -> DataFrame:
    pairs = _all_pairs(shared.where(F.col("n") <= plain), kmer)
    many = shared.where(F.col("n") > plain)
    place = lambda end: many.where((F.col("doc") == F.col(end)) & ~F.col("again")).groupBy("hash").agg(F.min("pos").alias("other_pos"))
    down = many.where("doc > lo").join(place("lo"), "hash").select(
        "doc", "pos", F.col("lo").alias("other"), "other_pos", F.lit(kmer).alias("words"), F.lit(True).alias("down"), "again"
    )
    # The two ends meet each other in the first part, but for further places of the smallest document.
    up = many.where("(doc > lo or again) and doc < hi").join(place("hi"), "hash").select(
        F.col("hi").alias("doc"), F.col("other_pos").alias("pos"), F.col("doc").alias("other"), F.col("pos").alias("other_pos"),
        F.lit(kmer).alias("words"), (F.col("doc") == F.col("lo")).alias("down"), "again",
    )
    whole = window_matches(documents, shared, kmer, window, least_words, plain)
    return pairs.unionByName(down).unionByName(up).unionByName(whole)


def _all_pairs(rows: DataFrame, words: int) -> DataFrame:
    """The matches of all occurrences (doc, hash, pos, lo) with one hash; there are few of each."""
    few = rows.groupBy("hash", "lo").agg(F.collect_list(F.struct("doc", "pos")).alias("l"))
    met = few.select("lo", "l", F.explode("l").alias("x")).select("lo", "x", F.explode("l").alias("y"))
    return met.where("x.doc > y.doc").select(
        F.col("x.doc").alias("doc"), F.col("x.pos").alias("pos"), F.col("y.doc").alias("other"), F.col("y.pos").alias("other_pos"),
        F.lit(words).alias("words"), (F.col("y.doc") == F.col("lo")).alias("down"), F.lit(False).alias("again"),
    )


def window_matches(documents: DataFrame, shared: DataFrame, kmer: int, window: int, least_words: int, plain: int) -> DataFrame:
    """Matches of windows of ``least_words`` words that hold a frequent seed.

    All seeds of a window that two documents share are seeds of both, and the first of them (its anchor) lies
    within ``window`` words of its start. So the ``core``, as many words from the anchor on as the window has at least,
    is in both. A core that occurs ``plain`` times at most is matched in all pairs. Of any other core, the documents
    with equal words around it, so with the same windows, are a class: they are matched with the smallest of them. Each window
    of that one is matched with the smallest document that has the window.
    """
    shift = window - 1
    core = least_words - shift
    by_doc = Window.partitionBy("doc").orderBy("at")
    by_run = Window.partitionBy("doc", "run")
    ahead = by_run.orderBy("pos").rowsBetween(0, Window.unboundedFollowing)
    anchors = (
        shared.select("doc", "at", "pos", F.when(F.col("n") > plain, F.col("pos")).alias("frequent"))
        # Shared seeds that follow each other in their text; of a window that others have too, all seeds are shared.
        .withColumn("run", F.col("at") - F.dense_rank().over(by_doc))
        .withColumn("last", F.max("pos").over(by_run))
        .withColumn("frequent", F.min("frequent").over(ahead))
        .where((F.col("last") - F.col("pos") >= core - kmer - shift) & (F.col("frequent") - F.col("pos") <= least_words - kmer))
    )
    asked = written(anchors.groupBy("doc").agg(F.collect_set("pos").alias("anchors")), "passages-anchors")
    texts = texts_of(documents, asked)

    def start():
        numbered = HashedWords()

        def work(part):
            out: dict[str, list] = {"doc": [], "hashes": [], "places": [], "around": [], "again": []}
            for doc, text, anchors in zip(part["doc"], part["text"], part["anchors"], strict=True):
                words = numbered.hashes(ascii_words(text))
                cores = window_hashes(words, core)
                # The windows that hold the core, by their distance from it; 0 where the text has no such window.
                wide = np.concatenate([np.zeros(shift, np.uint64), window_hashes(words, least_words) | np.uint64(1), np.zeros(shift, np.uint64)])
                at = np.sort(np.array(anchors, np.int64))
                at = at[at < len(cores)]
                rows = np.empty((len(at), 1 + window), np.int64)
                rows[:, 0] = cores[at].astype(np.int64)
                for i in range(window):
                    there = at + shift - i
                    rows[:, 1 + i] = np.where(there < len(wide), wide[np.minimum(there, len(wide) - 1)], np.uint64(0)).astype(np.int64)
                _, start_of, kinds = np.unique(rows, axis=0, return_index=True, return_inverse=True)
                first = _apart(kinds.ravel(), at, core)
                out["doc"].append(doc)
                out["hashes"].append(rows[first, 0])
                out["places"].append(at[first].astype(np.int32))
                # Beside the core, 32 bits tell its windows apart.
                out["again"].append(~np.isin(first, start_of))
                out["around"].append([(row >> 32).astype("<i4").tobytes() for row in rows[first, 1:]])
            return out

        return work

    schema = "doc long, hashes array<long>, places array<int>, around array<binary>, again array<boolean>"
    made = map_rows(texts.join(asked, "doc").select("doc", "text", "anchors"), schema, start)
    cores = made.select("doc", F.explode(F.arrays_zip("hashes", "places", "around", "again")).alias("s")).select(
        "doc", F.col("s.hashes").alias("hash"), F.col("s.places").alias("pos"), F.col("s.around").alias("around"), F.col("s.again").alias("again")
    ).repartition("hash")
    both_ends = [F.min(F.struct("doc", "pos")).alias("least"), F.max(F.struct("doc", "pos")).alias("most")]
    group = cores.groupBy("hash").agg(
        *both_ends, F.count(F.when(~F.col("again"), F.col("pos"))).alias("n"), (F.min("around") == F.max("around")).alias("alike"),
    )
    held = written(cores.join(group.where("least.doc < most.doc"), "hash").withColumn("lo", F.col("least.doc")), "passages-cores")
    few = F.col("n") <= plain
    many = held.where(~few).select("doc", "pos", "again", "hash", "around", "alike")
    same = many.groupBy("hash", "around", "alike").agg(*both_ends)
    members = many.join(same.drop("alike"), ["hash", "around"])
    places = F.sequence(F.lit(0), F.lit(shift))
    wide = (
        members.where(~F.col("alike") & (F.col("doc") == F.col("least.doc")))
        .select("hash", "around", "doc", "pos", "again", F.explode(places).alias("i"))
        .select("doc", (F.col("pos") - F.col("i")).alias("pos"), "again", "hash", "i", F.expr("substring(around, 4 * i + 1, 4)").alias("window"))
        .where("window <> x'00000000'")
    )
    key = ["hash", "i", "window"]
    ends = wide.groupBy(*key).agg(*both_ends).where("least.doc < most.doc")
    return (
        _all_pairs(held.where(few & ~F.col("again")), core)
        .unionByName(_with_ends(held.where(few & F.col("again")), core))
        .unionByName(_with_ends(members, core))
        .unionByName(_with_ends(wide.join(ends, key), least_words))
    )


def texts_of(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc, text) of the documents in ``asked`` (doc) and few others, so that the other texts are not shuffled to meet it."""
    own = F.xxhash64("doc")
    bloom = bloom_of(asked.select("doc").distinct().select(own.alias("key")), "key", CROWDED_BITS)
    texts = documents.where("text is not null and doc_id is not null").select(F.col("doc_id").alias("doc"), "text")

    def pick():
        def work(part):
            inside = in_bloom(bloom, np.array(part["key"], np.int64))
            return {c: [v for v, yes in zip(part[c], inside, strict=True) if yes] for c in ("doc", "text")}

        return work

    return map_rows(texts.select("doc", "text", own.alias("key")), "doc long, text string", pick)


def _with_ends(rows: DataFrame, words: int) -> DataFrame:
    """Matches of rows with the least of their group; further places in the document of that one, with the greatest."""
    first = rows.where("doc > least.doc").select(
        "doc", "pos", F.col("least.doc").alias("other"), F.col("least.pos").alias("other_pos"), F.lit(words).alias("words"), F.lit(True).alias("down"),
        "again",
    )
    again = rows.where("doc = least.doc and pos > least.pos and doc < most.doc").select(
        F.col("most.doc").alias("doc"), F.col("most.pos").alias("pos"), F.col("doc").alias("other"), F.col("pos").alias("other_pos"),
        F.lit(words).alias("words"), F.lit(True).alias("down"), F.lit(True).alias("again"),
    )
    return first.unionByName(again)


def _apart(kinds: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """Of ascending places of some kinds, per kind the first, each that lies ``words`` behind the one kept before, and the last.

    Places of one kind that overlap repeat the words between them, so those left out lie within the words of the others.
    """
    kept: list[int] = []
    last: dict[int, tuple[int, int]] = {}
    for k, (kind, place) in enumerate(zip(kinds.tolist(), at.tolist(), strict=True)):
        if kind not in last or place - last[kind][0] >= words:
            kept.append(k)
            last[kind] = place, k
        else:
            last[kind] = last[kind][0], k
    return np.array(sorted({*kept, *(k for _, k in last.values())}), np.int64)


def seed_pairs(
    places: np.ndarray, hashes: np.ndarray, frequent: np.ndarray, spans: list[tuple[int, int]], kmer: int, near: int, far: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, place of the first, of the second, whether none of the spans holds both) of two seeds of a text, one of them frequent.

    They are ``near`` to ``far`` words apart. A seed that follows itself is passed over: a repeated word, whose runs are exact.
    """
    order = np.lexsort((hashes, places))
    places, hashes, frequent = places[order], hashes[order], frequent[order]
    other = np.r_[True, hashes[1:] != hashes[:-1]] if len(hashes) else np.zeros(0, bool)
    places, hashes, frequent = places[other], hashes[other], frequent[other]
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, len(places)):
        gap = places[step:] - places[:-step]
        if gap.min() > far:
            break
        a = np.flatnonzero((gap >= near) & (gap <= far) & (frequent[step:] | frequent[:-step]) & (hashes[step:] != hashes[:-step]))
        first.append(a)
        second.append(a + step)
    a, b = np.concatenate(first), np.concatenate(second)
    numbers = hashes.astype(np.uint64)
    key = mixed(mixed(numbers[a]) ^ numbers[b]).astype(np.int64)
    begins, ends = np.array(sorted(spans) or [(1 << 40, 0)], np.int64).T
    reach, at = np.maximum.accumulate(ends), np.searchsorted(begins, places[a], "right") - 1
    left = (at < 0) | (reach[at] < places[b] + kmer)
    return key, places[a], places[b], left


def left_matches(shared: DataFrame, found: DataFrame, kmer: int, window: int, least_words: int, plain: int = PLAIN) -> DataFrame:
    """Matches, as of :func:`matches`, of the documents that share two seeds which no passage in ``found`` holds in one of them.

    The seeds of a chain that may be long enough are as far apart as ``near`` at least, and its gaps cost more than most of its words beyond ``far``.
    """
    near, far = max(1, least_words - 2 * (window + kmer) - kmer), least_words
    held = found.select(F.col("doc_id").alias("doc"), "start", "end").unionByName(
        found.select(F.col("other_id").alias("doc"), F.col("other_start").alias("start"), F.col("other_end").alias("end"))
    )
    # One span a place at most, however many documents a document is linked to.
    spans = held.groupBy("doc", "start").agg(F.max("end").alias("end")).groupBy("doc").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")
    )
    mark = (2 * F.col("pos") + (F.col("n") > plain).cast("int")).alias("mark")
    texts = shared.select("doc", "hash", mark).groupBy("doc").agg(
        F.collect_list("hash").alias("hashes"), F.collect_list("mark").alias("marks"), F.max(F.col("mark") % 2).alias("any")
    )
    # A text without a frequent seed has no such pair.
    texts = written(texts.where("any = 1").drop("any").join(spans, "doc", "left"), "passages-texts")

    def rows_of(bloom: np.ndarray | None) -> DataFrame:
        """The seed pairs that are left, or those of all documents with a key that the filter may hold."""

        def start():
            def work(part):
                out: dict[str, list] = {"doc": [], "keys": [], "firsts": [], "seconds": []}
                for doc, hashes, marks, starts, ends in zip(*(part[c] for c in ("doc", "hashes", "marks", "starts", "ends")), strict=True):
                    marks = np.array(marks, np.int64)
                    spans = list(zip(starts or (), ends or (), strict=True))
                    key, a, b, left = seed_pairs(marks >> 1, np.array(hashes, np.int64), marks & 1 == 1, spans, kmer, near, far)
                    chosen = np.flatnonzero(left if bloom is None else in_bloom(bloom, key))
                    if len(chosen):
                        for name, value in zip(out, (doc, key[chosen], a[chosen].astype(np.int32), b[chosen].astype(np.int32)), strict=True):
                            out[name].append(value)
                return out

            return work

        made = map_rows(texts, "doc long, keys array<long>, firsts array<int>, seconds array<int>", start)
        return made.select("doc", F.explode(F.arrays_zip("keys", "firsts", "seconds")).alias("s")).select(
            "doc", F.col("s.keys").alias("key"), F.col("s.firsts").alias("pos"), F.col("s.seconds").alias("next")
        )

    left = written(rows_of(None), "passages-left")
    bloom = bloom_of(left.select("key"), "key", CROWDED_BITS)
    # Every place that is left meets the first place of another document. Of a chain with such a pair, all seeds within ``far`` words
    # of it are in another one that no passage holds, so that enough of the chain is here.
    first = rows_of(bloom).groupBy("key", F.col("doc").alias("other")).agg(F.min(F.struct("pos", "next")).alias("there"))
    met = left.join(first, "key").where("doc <> other")
    two = F.array(
        F.struct("pos", F.col("there.pos").alias("other_pos")), F.struct(F.col("next").alias("pos"), F.col("there.next").alias("other_pos"))
    )
    met = met.select("doc", "other", F.explode(two).alias("p")).select("doc", "other", "p.pos", "p.other_pos")
    greater = F.col("doc") > F.col("other")
    each = lambda a, b: F.when(greater, F.col(a)).otherwise(F.col(b))
    return met.select(
        each("doc", "other").alias("doc"), each("pos", "other_pos").alias("pos"), each("other", "doc").alias("other"),
        each("other_pos", "pos").alias("other_pos"), F.lit(kmer).alias("words"), F.lit(True).alias("down"), F.lit(False).alias("again"),
    ).distinct()


class Fenwick:
    """Greatest (value, item) over the first places; values are only raised."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)

    def raise_to(self, place: int, value: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place]:
                self.best[place] = value
            place += place & -place

    def first(self, places: int) -> tuple[float, int]:
        """The greatest of the places before ``places``."""
        top = (-1e18, -1)
        while places:
            if self.best[places] > top:
                top = self.best[places]
            places &= places - 1
        return top


def segments(places: list[int], others: list[int], words: list[int], gap: int) -> list[tuple[int, int, int]]:
    """(start, other start, words): matches at one distance with at most ``gap`` words between them, as one segment."""
    points = np.array([others, places, words], np.int64)
    points = points[:, np.lexsort((points[1], points[1] - points[0]))]
    distance, at = points[1] - points[0], points[1]
    other = np.concatenate([[True], np.diff(distance) != 0])
    # Ends so far within one distance: a number per distance keeps those of others below.
    lift = np.cumsum(other) * np.int64(1 << 32)
    reach = np.maximum.accumulate(at + points[2] + lift) - lift
    first = other | np.concatenate([[True], at[1:] > reach[:-1] + gap])
    begin = np.flatnonzero(first)
    end = np.concatenate([begin[1:], [len(at)]]) - 1
    return sorted(zip(at[begin].tolist(), points[0][begin].tolist(), (reach[end] - at[begin]).tolist(), strict=True))


def chains(parts: list[tuple[int, int, int]], gap_cost: float = GAP_COST) -> list[list[tuple[int, int, int]]]:
    """Chains of segments, best first: each segment in one chain, starts and ends rising in both texts."""
    n = len(parts)
    ends = sorted({y + words for _, y, words in parts})
    rank = {y: i for i, y in enumerate(ends)}
    tree = Fenwick(len(ends))
    score, before = [0.0] * n, [-1] * n
    waiting = sorted(range(n), key=lambda i: parts[i][0] + parts[i][2])
    done = 0
    for i in range(n):
        x, y, words = parts[i]
        # Segments that end before this one begins may come before it.
        while done < n and parts[waiting[done]][0] + parts[waiting[done]][2] <= x:
            j = waiting[done]
            end_x, end_y = parts[j][0] + parts[j][2], parts[j][1] + parts[j][2]
            tree.raise_to(rank[end_y], (score[j] + gap_cost * (end_x + end_y), j))
            done += 1
        lo, hi = 0, len(ends)
        while lo < hi:
            middle = (lo + hi) // 2
            lo, hi = (middle + 1, hi) if ends[middle] <= y else (lo, middle)
        value, j = tree.first(lo)
        gain = value - gap_cost * (x + y)
        score[i], before[i] = (words + gain, j) if j >= 0 and gain > 0 else (float(words), -1)
    out, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(parts[i])
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def chained(met: DataFrame, kmer: int, window: int, least_words: int) -> DataFrame:
    """(doc, other, chain) of the chains that can belong to a passage of ``least_words`` words."""

    def start():
        def work(part):
            out: dict[str, list] = {"doc": [], "other": [], "chain": []}
            for doc, other, down, points in zip(part["doc"], part["other"], part["down"], part["points"], strict=True):
                places, others, words = ([p[c] for p in points] for c in ("pos", "other_pos", "words"))
                for chain in chains(segments(places, others, words, window - kmer)):
                    (x, y, _), (end_x, end_y, size) = chain[0], chain[-1]
                    # Each end of a passage may lack the seeds of almost a window.
                    if min(end_x + size - x, end_y + size - y) + 2 * (window + kmer) >= least_words:
                        # The smallest document is the other one; else the smaller of the two is linked to the greater.
                        out["doc"].append(doc if down else other)
                        out["other"].append(other if down else doc)
                        turned = chain if down else [(y, x, n) for x, y, n in chain]
                        out["chain"].append([number for segment in turned for number in segment])
            return out

        return work

    # At most ``plain`` matches for each seed of a document, so a group is about as long as its text.
    point = F.struct("pos", "other_pos", "words")
    grouped = met.groupBy("doc", "other", "again").agg(F.collect_list(point).alias("points"), F.max("down").alias("down"))
    grouped = grouped.where((F.size("points") > 1) | (F.element_at("points", 1)["words"] >= least_words))
    return map_rows(grouped, "doc long, other long, chain array<int>", start)


def pieces(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc, lo, hi, words): hashed words of the blocks lo to hi of the documents in ``asked`` (doc, lo, hi)."""

    def start():
        numbered = HashedWords()
        last: list = [None, None, None]

        def work(part):
            out: dict[str, list] = {"doc": [], "lo": [], "hi": [], "words": []}
            for doc, text, lo, hi in zip(part["doc"], part["text"], part["lo"], part["hi"], strict=True):
                if last[0] != doc or last[1] != text:
                    last[:] = doc, text, numbered.hashes(ascii_words(text))
                out["doc"].append(doc)
                out["lo"].append(lo)
                out["hi"].append(hi)
                # 32 bits of a hash tell the words of two passages apart well enough to count matches.
                out["words"].append((last[2][lo * BLOCK : (hi + 1) * BLOCK] >> np.uint64(32)).astype("<u4").tobytes())
            return out

        return work

    texts = asked.join(texts_of(documents, asked), "doc")
    made = map_rows(texts.select("doc", "text", "lo", "hi"), "doc long, lo int, hi int, words binary", start)
    # Rows that share a doc_id: the one with the smallest text hash is used on both sides.
    return made.groupBy("doc", "lo", "hi").agg(F.min("words").alias("words"))


def common_subsequence(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit per word of ``left``."""
    if not len(left) or not len(right):
        return 0
    at: dict[int, int] = defaultdict(int)
    for i, word in enumerate(left.tolist()):
        at[word] |= 1 << i
    full = (1 << len(left)) - 1
    row = full
    for word in right.tolist():
        hit = row & at.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(left) - row.bit_count()


def _extended(left: np.ndarray, right: np.ndarray) -> tuple[int, int]:
    """(words, matches) by which two texts agree from their start; single other words are passed if four follow that agree."""
    n = min(len(left), len(right))
    same = left[:n] == right[:n]
    reach = matched = at = 0
    while at < n:
        if same[at]:
            at += 1
            matched += 1
            reach = at
        elif at + 5 <= n and same[at + 1 : at + 5].all():
            at += 1
        else:
            break
    return reach, matched


def aligned(chain: list[int], left: np.ndarray, left_from: int, right: np.ndarray, right_from: int):
    """(start, end, other start, other end, matched words) of a chain in its texts, of which parts are given."""
    parts = np.array(chain).reshape(-1, 3)
    xs, ys, sizes = parts[:, 0] - left_from, parts[:, 1] - right_from, parts[:, 2]
    matched = 0
    for i, (x, y, words) in enumerate(zip(xs.tolist(), ys.tolist(), sizes.tolist(), strict=True)):
        a, b = left[x : x + words], right[y : y + words]
        # A segment can hold words between its seeds that differ.
        matched += int((a == b).sum()) if len(a) == len(b) else 0
        if i:
            px, py = int(xs[i - 1] + sizes[i - 1]), int(ys[i - 1] + sizes[i - 1])
            matched += common_subsequence(left[px:x], right[py:y])
    x, y = int(xs[0]), int(ys[0])
    end_x, end_y = int(xs[-1] + sizes[-1]), int(ys[-1] + sizes[-1])
    back, more = _extended(left[:x][::-1], right[:y][::-1])
    ahead, still = _extended(left[end_x:], right[end_y:])
    matched += more + still
    return left_from + x - back, left_from + end_x + ahead, right_from + y - back, right_from + end_y + ahead, matched


def cut(chain: list[int]) -> list[list[int]]:
    """The two parts of a chain beside its widest gap; none if it is a single segment."""
    parts = np.array(chain).reshape(-1, 3)
    if len(parts) < 2:
        return []
    gaps = (parts[1:, :2] - parts[:-1, :2] - parts[:-1, 2:]).max(axis=1)
    at = 3 * (int(np.argmax(gaps)) + 1)
    return [chain[:at], chain[at:]]


def passages(
    documents: DataFrame,
    kmer: int = KMER,
    window: int = WINDOW,
    least_words: int = LEAST_WORDS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """The passages of (doc_id, text) that repeat in another document, each with its place there."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = shared_seeds(seeds(documents, kmer, window))
    met = _matches(documents, shared, kmer, window, least_words, PLAIN)
    found = written(_aligned(documents, met, kmer, window, least_words, least_share), "passages-found")
    more = _aligned(documents, left_matches(shared, found, kmer, window, least_words), kmer, window, least_words, least_share)
    # A passage may be found again, from either side.
    turned = found.select(
        F.col("other_id").alias("doc_id"), F.col("other_start").alias("start"), F.col("other_end").alias("end"),
        F.col("doc_id").alias("other_id"), F.col("start").alias("other_start"), F.col("end").alias("other_end"),
    )
    known = found.select(turned.columns).unionByName(turned)
    return found.unionByName(more.join(known, turned.columns, "left_anti").select(found.columns))


def _aligned(documents: DataFrame, met: DataFrame, kmer: int, window: int, least_words: int, least_share: float) -> DataFrame:
    """The passages among the matches of documents."""
    found = compact(chained(met, kmer, window, least_words), 50_000)
    first, last = F.col("chain")[0], F.element_at("chain", -3) + F.element_at("chain", -1)
    other_first, other_last = F.col("chain")[1], F.element_at("chain", -2) + F.element_at("chain", -1)
    block = lambda place: F.floor(F.greatest(place, F.lit(0)) / BLOCK).cast("int")
    found = found.select(
        "doc", "other", "chain",
        block(first - MARGIN).alias("lo"), block(last + MARGIN).alias("hi"),
        block(other_first - MARGIN).alias("other_lo"), block(other_last + MARGIN).alias("other_hi"),
    )
    asked = found.select("doc", "lo", "hi").unionByName(
        found.select(F.col("other").alias("doc"), F.col("other_lo").alias("lo"), F.col("other_hi").alias("hi"))
    )
    words = freeze(pieces(documents, asked.distinct()))
    others = words.select(
        F.col("doc").alias("other"), F.col("lo").alias("other_lo"), F.col("hi").alias("other_hi"), F.col("words").alias("other_words")
    )
    ready = found.join(words, ["doc", "lo", "hi"]).join(others, ["other", "other_lo", "other_hi"])

    def start():
        def work(part):
            names = ["doc_id", "start", "end", "other_id", "other_start", "other_end", "matched", "share"]
            out: dict[str, list] = {name: [] for name in names}
            columns = ["doc", "other", "chain", "lo", "other_lo", "words", "other_words"]
            for doc, other, chain, lo, other_lo, left, right in zip(*(part[c] for c in columns), strict=True):
                left, right = np.frombuffer(left, "<u4"), np.frombuffer(right, "<u4")
                waiting = [chain]
                while waiting:
                    chain = waiting.pop()
                    a, b, c, d, matched = aligned(chain, left, lo * BLOCK, right, other_lo * BLOCK)
                    longest = max(b - a, d - c)
                    if min(b - a, d - c) < least_words:
                        continue
                    if matched < least_share * longest:
                        waiting += cut(chain)
                        continue
                    for name, value in zip(names, (doc, a, b, other, c, d, matched, matched / longest), strict=True):
                        out[name].append(value)
            return out

        return work

    schema = "doc_id long, start int, end int, other_id long, other_start int, other_end int, matched int, share double"
    return map_rows(ready, schema, start)


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of at least 50 words of a document that another document has too."""
    return passages(read(spark, sf_dir, "documents"))


PLANS["op1_passages"] = op1_passages
