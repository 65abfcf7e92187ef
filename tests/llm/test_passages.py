import random

from conftest import rows
from llm_data import frame, prose  # noqa: F401

from lakemodels.llm import passages as P


def changed(text, step, seed):
    """Every step-th word replaced, left out or doubled in turn."""
    out = []
    for i, word in enumerate(text.split()):
        if i % step == step - 1:
            out += [f"new{seed}x{i}"] if i % 3 == 0 else [] if i % 3 == 1 else [word, f"more{i}"]
        else:
            out.append(word)
    return " ".join(out)


def test_exact_passages_have_their_exact_places(frame):
    shared = prose(1, 60)
    texts = [prose(10, 35) + " " + shared + " " + prose(11, 20), prose(12, 5) + " " + shared.upper(), shared + " " + prose(13, 400), prose(14, 300)]
    got = rows(P.passages(frame(list(enumerate(texts)))).select("doc_id", "start", "end", "other_id", "other_start", "other_end", "share"))
    places = {0: (35, 95), 1: (5, 65), 2: (0, 60)}
    assert got == [(d, *places[d], o, *places[o], 1.0) for d, o in [(1, 0), (1, 2), (2, 0)]]


def test_fuzzy_and_short_passages(frame):
    shared = prose(2, 120)
    texts = [shared, prose(20, 30) + " " + changed(shared, 12, 7) + " " + prose(21, 30), prose(22, 50) + " " + " ".join(shared.split()[:40]), changed(shared, 2, 9)]
    got = P.passages(frame(list(enumerate(texts)))).collect()
    assert [(r.doc_id, r.other_id) for r in got] == [(1, 0)]
    assert got[0].end - got[0].start >= 110 and 0.8 <= got[0].share < 1


def test_no_document_with_a_repeat_is_missed(frame):
    """Against all runs of 50 words; hot passages, nested ones and copies among them."""
    draw, texts = random.Random(6), []
    shared = [prose(500 + k, 50 + 7 * k) for k in range(6)]
    for k in range(150):
        parts = [prose(3000 + k, draw.randrange(60))]
        if k % 3:
            parts += [shared[0] if k % 2 else draw.choice(shared), prose(4000 + k, draw.randrange(40))]
        texts.append(" ".join(parts))
    texts += [texts[3], texts[3], "", None]
    runs = {}
    for d, text in enumerate(texts):
        words = (text or "").split()
        for k in range(len(words) - 49):
            runs.setdefault(" ".join(words[k : k + 50]), set()).add(d)
    wanted = {d for group in runs.values() if len(group) > 1 for d in group}
    got = P.passages(frame(list(enumerate(texts)))).collect()
    assert {r.doc_id for r in got} | {r.other_id for r in got} == wanted


def test_chains_are_best_chains():
    """Against trying every predecessor."""
    draw = random.Random(3)
    for _ in range(300):
        parts = sorted({(draw.randrange(40), draw.randrange(40), draw.randrange(1, 9)) for _ in range(draw.randrange(1, 9))})
        score = []
        for x, y, words in parts:
            best = float(words)
            for (px, py, pw), s in zip(parts, score, strict=False):
                if px + pw <= x and py + pw <= y:
                    best = max(best, words + s - P.GAP_COST * (x - px - pw + y - py - pw))
            score.append(best)
        chain = P.chains(parts)[0]
        got = sum(w for _, _, w in chain)
        got -= P.GAP_COST * sum(b[0] - a[0] - a[2] + b[1] - a[1] - a[2] for a, b in zip(chain, chain[1:], strict=False))
        assert abs(got - max(score)) < 1e-9


def test_common_subsequence():
    import numpy as np

    draw = random.Random(1)
    for _ in range(200):
        a, b = ([draw.randrange(5) for _ in range(draw.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert P.common_subsequence(np.array(a, np.int64), np.array(b, np.int64)) == table[-1][-1]


def test_rows_that_are_odd(frame):
    text = prose(9, 70)
    df = frame([(1, text), (1, text), (None, text), (2, text), (3, None), (4, ""), (5, "same " * 20_000), (6, "same " * 20_000)], ["pos", "words"])
    got = P.passages(df)
    assert rows(got.where("doc_id < 3").select("doc_id", "other_id", "share").distinct()) == [(2, 1, 1.0)]
    assert P.passages(frame([])).count() == 0


def test_passages_of_frequent_words_link_those_that_share_them(frame):
    """The smallest and largest documents with the words hold only half of what two others share."""
    left, right = prose(61, 34).split(), prose(62, 34).split()
    both = " ".join(left + right)
    texts = [prose(700 + k, 20) + " " + " ".join(left if k % 2 else right) + " " + prose(800 + k, 20) for k in range(24)]
    middle = [prose(900 + k, 15) + " " + both + " " + prose(950 + k, 15) for k in range(2)]
    for plain in (2, P.PLAIN):
        df = frame(list(enumerate(texts[:12] + middle + texts[12:])))
        got = P.chained(P.matches(df, P.seeds(df, P.KMER, P.WINDOW), P.KMER, P.WINDOW, 50, plain), P.KMER, P.WINDOW, 50)
        assert (13, 12) in {(r.doc, r.other) for r in got.collect()}
    assert [(r.doc_id, r.other_id, r.share) for r in P.passages(df).collect()] == [(13, 12, 1.0)]


def test_rare_seeds_pair_all_their_documents(frame):
    """Two halves that still smaller and larger documents have, and a passage of both that two in the middle share."""
    a, b = prose(63, 40), prose(64, 40)
    texts = [prose(70, 30) + " " + a, prose(71, 9) + " " + a + " " + b, prose(72, 9) + " " + a + " " + b, b + " " + prose(73, 30)]
    got = P.passages(frame(list(enumerate(texts)))).collect()
    assert [(r.matched, r.share) for r in got if {r.doc_id, r.other_id} == {1, 2}] == [(80, 1.0)]


def test_passages_far_apart_are_kept_each(frame):
    a, b = prose(65, 60), prose(66, 60)
    texts = [a + " " + prose(74, 150) + " " + b, a + " " + prose(75, 150) + " " + b]
    got = P.passages(frame(list(enumerate(texts)))).collect()
    assert sorted((r.start, r.end) for r in got) == [(0, 60), (210, 270)]


def test_changed_passages_of_frequent_seeds_are_found(frame):
    """Each half stands in many documents, both with one word between them only in two, and that word differs."""
    left, right = prose(67, 34), prose(68, 34)
    texts = [prose(1000 + k, 20) + " " + (left if k % 2 else right) + " " + prose(1100 + k, 20) for k in range(24)]
    middle = [prose(1200 + k, 15) + f" {left} other{k} {right} " + prose(1300 + k, 15) for k in range(2)]
    got = P.passages(frame(list(enumerate(texts[:12] + middle + texts[12:])))).collect()
    assert [(r.doc_id, r.start, r.end, r.other_id, r.matched) for r in got] == [(13, 15, 84, 12, 68)]


def test_every_copy_of_a_frequent_passage_is_found(frame):
    """A passage of many documents that stands twice in the smallest, in one between and in the largest; and long runs of one word."""
    shared = prose(69, 60)
    texts = [shared + " " + prose(1400 + k, 30) + (" " + shared if k in (0, 6, 11) else "") for k in range(12)]
    got = P.passages(frame(list(enumerate(texts)))).collect()
    places = {(r.doc_id, r.start) for r in got} | {(r.other_id, r.other_start) for r in got}
    assert places >= {(k, 0) for k in range(12)} | {(k, 90) for k in (0, 6, 11)}
    runs = [(k, prose(1500 + k, 10) + " and" * (3_000 if k in (1, 4) else 70) + " " + prose(1600 + k, 10)) for k in range(6)]
    got = P.passages(frame(runs)).collect()
    for k, text in runs:
        held = {w for r in got if r.doc_id == k for w in range(r.start, r.end)} | {w for r in got if r.other_id == k for w in range(r.other_start, r.other_end)}
        assert held >= set(range(10, len(text.split()) - 10)), k
    assert len(got) < 1_000


def test_words_of_all_pairs_of_all_seeds_are_in_a_passage(frame):
    draw = random.Random(12)
    shared = [prose(1700 + k, 70) for k in range(4)]
    texts = []
    for k in range(90):
        parts = [prose(1800 + k, draw.randrange(5, 40))]
        for _ in range(draw.randrange(1, 3)):
            words = draw.choice(shared).split()
            begin = draw.randrange(25)
            words = [f"new{draw.randrange(9)}" if draw.random() < 0.04 else w for w in words[begin : begin + draw.randrange(20, 70)]]
            parts += [" ".join(words), prose(draw.randrange(10**6), draw.randrange(5, 30))]
        texts.append(" ".join(parts))
    df = frame(list(enumerate(texts)))

    def held(rows):
        sides = [(r.doc_id, r.start, r.end) for r in rows] + [(r.other_id, r.other_start, r.other_end) for r in rows]
        return {(d, w) for d, a, b in sides for w in range(a, b)}

    shared_seeds = P.shared_seeds(P.seeds(df, P.KMER, P.WINDOW))
    all_pairs = P._all_pairs(shared_seeds, P.KMER)
    wanted = held(P._aligned(df, all_pairs, P.KMER, P.WINDOW, P.LEAST_WORDS, P.LEAST_SHARE).collect())
    first = held(P._aligned(df, P._matches(df, shared_seeds, P.KMER, P.WINDOW, 50, P.PLAIN), P.KMER, P.WINDOW, 50, P.LEAST_SHARE).collect())
    got = held(P.passages(df).collect())
    print(len(wanted), len(wanted - first), len(wanted - got))
    assert len(wanted) > 1_000 and len(wanted - got) <= 0.01 * len(wanted)


def test_pairs_of_seeds_that_no_passage_holds():
    import numpy as np

    places, hashes, frequent = np.array([0, 30, 9, 100, 101]), np.array([5, 7, 6, 8, 8]), np.array([True, False, False, False, True])
    key, a, b, left = P.seed_pairs(places, hashes, frequent, [(0, 15)], 6, 8, 50)
    assert list(zip(a.tolist(), b.tolist(), left.tolist())) == [(0, 9, False), (0, 30, True)] and len(set(key.tolist())) == 2
    assert P.seed_pairs(places, hashes, frequent, [], 6, 8, 50)[3].all() and not len(P.seed_pairs(places[:0], hashes[:0], frequent[:0], [], 6, 8, 50)[0])
    assert P._apart(np.array([1, 1, 2, 1, 1]), np.array([0, 5, 6, 40, 45]), 39).tolist() == [0, 2, 3, 4]
