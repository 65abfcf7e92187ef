import random

import pytest
from llm_data import frame, prose  # noqa: F401

from lakemodels.llm import minhash as M


def brute(rows):
    """Components by comparing all pairs of shingle sets."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def edited(text, edits, seed):
    draw, words = random.Random(seed), text.split()
    for at in draw.sample(range(len(words)), edits):
        words[at] = f"edit{seed}x{at}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(frame, seed):
    """Chains of near copies around the threshold, a hot passage, short texts, copies."""
    rows, n = [], 0
    for base in range(6):
        text = prose(100 * seed + base, 150)
        for copy in range(12):
            rows.append((n, edited(text, copy % 6, 1000 * seed + n) if copy else text))
            n += 1
    chain = prose(seed, 120)
    for _ in range(8):
        rows.append((n, chain))
        chain = edited(chain, 2, seed + n)
        n += 1
    hot = prose(seed + 77, 30)
    for k in range(25):
        rows.append((n, hot + " " + prose(5000 + k, 10 + k)))
        n += 1
    for text in ["", None, "one", "One", "one two three", "one two three four", "a b c d e", "A B C D E", " \t\n"]:
        rows.append((n, text))
        n += 1
    random.Random(seed).shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(frame(rows)).collect()}
    assert got == brute(rows)


def test_rows_that_are_odd(frame):
    text = prose(3, 40)
    df = frame([(7, text), (7, text), (None, text), (2, None), (5, text), (9, "x" * 300_000)], ["component_id", "kept", "digest"])
    got = [tuple(r) for r in M.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted(
        [(7, 36, 5, False), (7, 36, 5, False), (None, 36, None, True), (2, 0, 2, True), (5, 36, 5, True), (9, 1, 9, True)], key=str
    )


def test_texts_under_one_id_keep_their_own_links(frame):
    """Two texts under 5, a near copy of the second under 9; both texts under 5 near copies under 3 and 8."""
    a, b, c = prose(11, 100), prose(12, 100), prose(13, 100)
    df = frame([(5, a), (5, b), (9, edited(b, 1, 4)), (20, c), (20, edited(a, 1, 5)), (3, edited(c, 1, 6)), (21, a)])
    got = sorted((r.doc_id, r.component_id, r.kept) for r in M.near_duplicates(df).collect())
    assert got == [(3, 3, True), (5, 5, True), (5, 5, True), (9, 5, False), (20, 3, False), (20, 5, False), (21, 5, False)]


def test_carried_columns_stay_with_their_rows(frame):
    text = prose(3, 40)
    df = frame([(1, text), (2, text), (3, None), (None, text)]).selectExpr("*", "doc_id * 10 AS mine", "length(text) AS size")
    got = {r.doc_id: (r.kept, r.mine, r.size) for r in M.near_duplicates(df, carry=["mine", "size"]).collect()}
    assert got == {1: (True, 10, len(text)), 2: (False, 20, len(text)), 3: (True, 30, None), None: (True, None, len(text))}


def test_empty_table(frame):
    assert M.near_duplicates(frame([])).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    from lakemodels.llm.common import connected

    edges = [(i, i + 1) for i in range(100, 160)] + [(0, k) for k in range(1, 60)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected(df, "a", "b").collect()}
    assert got == {i: 100 for i in range(100, 161)} | {k: 0 for k in range(60)}
