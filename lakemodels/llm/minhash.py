"""Near-duplicate documents by bottom-k sketches of one hash function.

A document is its set of distinct word shingles, each a 63-bit hash; its sketch is the
``k`` smallest of them. Two documents are linked if the Jaccard index of their full sets
reaches the threshold; classes are the connected components of the links.

1. Documents with equal sets become one row, so a group of copies costs as much as one text.
2. Sketch values become inverted lists. A pair at the threshold shares at least ``need`` of
   its sketch values (the chance to miss one is below 1e-9 per link), so each document enters
   only the lists of its rarest values, all but ``need - 1`` of them: two such documents
   still meet in a list, while values that half the corpus shares make no list.
3. In every list each member is compared with one centre only, the member with the fewest
   values of its own. The union sketch of both estimates their likeness and drops the clear
   misses, full sets decide. Lists that one component covers by then are done.
4. The members of the other lists are joined exactly: the rarest shingles of the full sets are
   matched by value and size class, as far as their rank still allows the needed overlap, and
   only between documents that are not connected yet. The same two checks follow.

No step emits all pairs of a group: the work of step 3 is a row per list member, and step 4
leaves out what step 3 has connected and whatever rank and size exclude.

Null and empty texts, and texts without a word, have an empty set and link with nothing. A text
with fewer words than a shingle is one shingle. A row without doc_id is a class of its own with
a null class id and is kept. Rows that share a doc_id are separate documents under one id: each text keeps
its own links, and their classes carry the smallest doc_id of any member.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemodels.llm.common import (
    HashedWords,
    ascii_words,
    bloom_of,
    compact,
    connected,
    freeze,
    in_bloom,
    map_rows,
    window_hashes,
)
from lakemodels.llm.plans import PLANS, SQL, read

SHINGLE_WORDS = 5
SKETCH = 48
# Of the 48 least values of a union, a pair with an index of 0.85 shares 23 but for a chance of 3e-10.
NEED = 23
PERCENT = 85
BLOOM_BITS = 1 << 24
# Sizes are compared by classes of this ratio.
SIZE_CLASS = math.log(1.03)


def shingle_set(words: list[bytes], numbered: HashedWords, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes (63 bits); all words as one shingle if there are fewer."""
    if not words:
        return np.zeros(0, np.int64)
    hashes = window_hashes(numbered.hashes(words), min(size, len(words)))
    return np.unique(hashes >> np.uint64(1)).astype(np.int64)


def signatures(
    documents: DataFrame, size: int = SHINGLE_WORDS, k: int = SKETCH, carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, sketch) of every row of (doc_id, text), and the columns ``carry``."""
    carried = documents.select(*carry).schema
    schema = T.StructType.fromDDL("doc_id long, n_shingles long, digest binary, sketch array<long>")

    def start():
        numbered = HashedWords()

        def work(part):
            sets = [shingle_set(ascii_words(t), numbered, size) for t in part["text"]]
            return {
                "doc_id": part["doc_id"],
                "n_shingles": [len(s) for s in sets],
                "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                "sketch": [s[:k] for s in sets],
                **{name: part[name] for name in carry},
            }

        return work

    return map_rows(documents.select("doc_id", "text", *carry), T.StructType(schema.fields + carried.fields), start)


def full_sets(documents: DataFrame, wanted: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc, n, shingles) of the classes in ``wanted`` (doc, id, digest); the digest picks the right row of an id.

    A Bloom filter of fixed size on the hashed ids keeps most other texts from being read into sets; the
    join then leaves exactly the wanted ones, and no text is shuffled.
    """
    bloom = bloom_of(wanted.select(F.xxhash64("id").alias("hash")), "hash", BLOOM_BITS)

    def start():
        numbered = HashedWords()

        def work(part):
            out: dict[str, list] = {"id": [], "digest": [], "shingles": []}
            passed = in_bloom(bloom, np.array(part["hash"], np.int64))
            for doc_id, text, chosen in zip(part["id"], part["text"], passed, strict=True):
                if chosen:
                    shingles = shingle_set(ascii_words(text), numbered, size)
                    out["id"].append(doc_id)
                    out["digest"].append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    out["shingles"].append(shingles)
            return out

        return work

    texts = documents.where("doc_id is not null").select(
        F.col("doc_id").alias("id"), F.xxhash64("doc_id").alias("hash"), "text"
    )
    made = map_rows(texts, "id long, digest binary, shingles array<long>", start)
    exact = made.join(wanted.select("doc", "id", "digest"), ["id", "digest"])
    return exact.dropDuplicates(["doc"]).select("doc", F.size("shingles").cast("long").alias("n"), "shingles")


def least_overlap(n_left: Column, n_right: Column, percent: int) -> Column:
    """The smallest overlap of two sets of these sizes that reaches the threshold."""
    return F.ceil(percent * (n_left + n_right) / (100 + percent))


def verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, k: int, need: int, percent: int) -> DataFrame:
    """Of the candidate pairs (a, b) those that the union sketch does not exclude and the full sets confirm."""
    left = sketches.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = sketches.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    union = F.slice(F.sort_array(F.array_union("s_a", "s_b")), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), union))
    likely = (
        pairs.join(left, "a")
        .join(right, "b")
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
        .where(shared * k >= F.size(union) * need)
        .select("a", "b")
    )
    full_left = sets.select(F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("f_a"))
    full_right = sets.select(F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("f_b"))
    common = F.size(F.array_intersect("f_a", "f_b"))
    return (
        likely.join(full_left, "a")
        .join(full_right, "b")
        .where(common >= least_overlap(F.col("n_a"), F.col("n_b"), percent))
        .select("a", "b")
    )


def near_duplicates(
    documents: DataFrame,
    size: int = SHINGLE_WORDS,
    k: int = SKETCH,
    need: int = NEED,
    percent: int = PERCENT,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text), and its columns ``carry``."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    signed = freeze(signatures(documents, size, k, carry))
    whole = signed.where("n_shingles > 0 and doc_id is not null")
    classes, shared_ids = _named_classes(
        freeze(
            whole.groupBy("digest", F.col("n_shingles").alias("n")).agg(
                F.min("doc_id").alias("id"), F.any_value("sketch").alias("sketch")
            )
        )
    )

    lists = compact(_lists(classes, k, need))
    centres = lists.groupBy("value").agg(
        F.min(F.struct(-F.col("n_shared"), "doc")).alias("centre"), F.count("*").alias("n_members")
    )
    met = compact(lists.join(centres.where("n_members > 1"), "value"))
    wanted = compact(classes.join(met.select("doc").distinct(), "doc"), 20_000)
    sketches = wanted.select("doc", "n", "sketch")
    sets = compact(full_sets(documents, wanted, size), 4_000)
    star = met.select(F.col("doc").alias("a"), F.col("centre.doc").alias("b")).where("a <> b").distinct()
    first = connected(verified(star, sketches, sets, k, need, percent), "a", "b")

    rest = compact(_unconnected(met, first))
    second = verified(_by_prefix(sets, rest, percent), sketches, sets, k, need, percent)
    side = lambda name: rest.select(F.col("doc").alias(name), F.col("component").alias(f"c_{name}"))
    second = connected(second.join(side("a"), "a").join(side("b"), "b"), "c_a", "c_b")

    # The links of the second step join the components of the first.
    named = (
        classes.select("digest", "id", "doc")
        .join(first.select(F.col("node").alias("doc"), F.col("component").alias("c1")), "doc", "left")
        .withColumn("c1", F.coalesce("c1", "doc"))
        .join(second.select(F.col("node").alias("c1"), F.col("component").alias("c2")), "c1", "left")
        .select("digest", "id", "doc", F.coalesce("c2", "c1").alias("node"))
    )
    least = F.col("node")
    if shared_ids:
        # A component with a class that has no id of its own is named by the smallest id among its members.
        unnamed = named.where("doc <> id").select("node").distinct()
        ids = named.join(unnamed, "node", "left_semi").groupBy("node").agg(F.min("id").alias("least_id"))
        named, least = named.join(compact(ids), "node", "left"), F.coalesce("least_id", "node")
    named = named.select("digest", least.alias("found"))
    # Every class has one row here; the hot key is on the left side, which Spark may split.
    joined = signed.select("doc_id", "n_shingles", "digest", *carry).join(named, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("found")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        *carry,
    )


def _named_classes(classes: DataFrame) -> tuple[DataFrame, bool]:
    """The classes (digest, n, id, sketch) with ``doc``, the number each goes by in links, and if any is not its id.

    Classes of different texts under one id go by a hash of id and digest.
    """
    several = freeze(classes.groupBy("id").agg(F.count("*").alias("texts")).where("texts > 1"))
    if several.isEmpty():
        return classes.withColumn("doc", F.col("id")), False
    doc = F.when(F.col("texts").isNull(), F.col("id")).otherwise(F.xxhash64("id", "digest"))
    joined = classes.join(several, "id", "left").select("digest", "n", "id", "sketch", doc.alias("doc"))
    return freeze(joined), True


def _lists(classes: DataFrame, k: int, need: int) -> DataFrame:
    """(value, doc, n_shared): the lists that a document enters. A value of one document alone makes no list."""
    postings = classes.select("doc", "n", F.explode("sketch").alias("value"))
    frequent = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = postings.join(frequent, "value").groupBy("doc", "n").agg(F.collect_list(F.struct("df", "value")).alias("v"))
    # A shorter sketch holds the whole set; the needed share of it is the same, rounded down.
    needed = F.greatest(F.lit(1), F.floor(F.least(F.col("n"), F.lit(k)) * need / k)).cast("int")
    rare = F.slice(F.sort_array("v"), 1, F.greatest(F.lit(0), F.size("v") - needed + 1))
    return shared.select("doc", F.size("v").alias("n_shared"), F.explode(rare).alias("x")).select(
        F.col("x.value").alias("value"), "doc", "n_shared"
    )


def _unconnected(met: DataFrame, components: DataFrame) -> DataFrame:
    """(doc, component) of the members of lists that more than one component shares."""
    placed = met.select("value", "doc").join(components.withColumnRenamed("node", "doc"), "doc", "left")
    placed = placed.select("value", "doc", F.coalesce("component", "doc").alias("component"))
    spread = placed.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return placed.join(spread.where("lo < hi"), "value").select("doc", "component").distinct()


def _by_prefix(sets: DataFrame, rest: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) among ``rest`` from the rarest shingles of the full sets, a not smaller than b.

    With the shingles of a set ranked from rare to frequent, a match at rank p (from 0) leaves an
    overlap of n - p at most. For the smaller set the overlap of an equally large one must be in
    reach; for the larger one this bounds the size of the other, written as a range of classes.
    """
    postings = sets.join(rest.select("doc"), "doc", "left_semi").select("doc", F.explode("shingles").alias("value"))
    frequent = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = postings.join(frequent, "value").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))
    shared = shared.join(sets.select("doc", "n"), "doc").join(rest, "doc")
    # Shingles of this document alone are the rarest and take the first ranks.
    prefix = F.slice("v", 1, F.greatest(F.lit(0), (F.size("v") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")))
    ranked = shared.select("doc", "n", "component", (F.col("n") - F.size("v")).alias("own"), F.posexplode(prefix))
    ranked = ranked.select("doc", "n", "component", F.col("col.value").alias("value"), (F.col("own") + F.col("pos")).alias("rank"))
    ranked = compact(ranked, 200_000)
    left_over = F.col("n") - F.col("rank")
    size_class = lambda n: F.floor(F.log(n) / SIZE_CLASS)
    smaller = ranked.where(left_over >= least_overlap(F.col("n"), F.col("n"), percent)).select(
        "value", size_class(F.col("n")).alias("size_class"), F.col("doc").alias("b"), F.col("n").alias("n_b"),
        F.col("component").alias("c_b"), left_over.alias("left_b"),
    )
    most = F.least(F.col("n"), F.floor(left_over * (100 + percent) / percent) - F.col("n"))
    least = F.ceil(F.col("n") * percent / 100)
    larger = ranked.where(most >= least).select(
        "value", F.explode(F.sequence(size_class(least), size_class(most))).alias("size_class"),
        F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"), left_over.alias("left_a"),
    )
    # Members of the component that fills most of a list need not meet each other: they are put on a
    # side of their own, which only the larger documents of other components also visit.
    keys = ["value", "size_class"]
    held = smaller.select(*keys, F.col("c_b").alias("c")).unionByName(larger.select(*keys, F.col("c_a").alias("c")))
    held = held.groupBy(*keys, "c").agg(F.count("*").alias("n"))
    main = held.groupBy(*keys).agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.count("*").alias("n"))
    main = main.where("n > 1").select(*keys, "main")
    sides = F.when(F.col("c_a") == F.col("main"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    larger = larger.join(main, keys).withColumn("side", F.explode(sides))
    smaller = smaller.join(main, keys).withColumn("side", F.when(F.col("c_b") == F.col("main"), 1).otherwise(0))
    ordered = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") > F.col("b")))
    return (
        larger.drop("main").join(smaller.drop("main"), [*keys, "side"])
        .where((F.col("c_a") != F.col("c_b")) & ordered)
        .where(F.least("left_a", "left_b") >= least_overlap(F.col("n_a"), F.col("n_b"), percent))
        .select("a", "b")
        .distinct()
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    return near_duplicates(read(spark, sf_dir, "documents"))


PLANS["op5_minhash"] = op5_minhash
SQL["op5_minhash"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT l.doc_id AS a, r.doc_id AS b
    FROM shingles l JOIN shingles r ON l.s = r.s AND l.doc_id <> r.doc_id
    JOIN sizes nl ON nl.doc_id = l.doc_id JOIN sizes nr ON nr.doc_id = r.doc_id
    GROUP BY l.doc_id, r.doc_id, nl.n, nr.n
    HAVING 100 * count(*) >= 85 * (nl.n + nr.n - count(*))
), reached AS (
    SELECT doc_id AS node, doc_id AS seen FROM documents
    UNION
    SELECT reached.node, links.b FROM reached JOIN links ON links.a = reached.seen
), least AS (
    SELECT node, min(seen) AS component_id FROM reached GROUP BY node
)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id JOIN least c ON c.node = d.doc_id
"""
