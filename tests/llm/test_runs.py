import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import DATA
from llm_data import frame, prose  # noqa: F401

from lakemodels.llm import runs as R


def brute(words, least=24, power=3):
    """Every maximal stretch of every period, kept under its smallest one."""
    n, stretches = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, power * q):
                stretches.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in stretches.items()), key=lambda r: (r[0], r[2]))


def words(*parts):
    return " ".join(parts).encode().split()


CASES = [
    words("a " * 24),
    words("a " * 23),
    words("x y " * 12),
    words("x y " * 11 + "x"),
    words("p " + "a b c " * 9 + "a b q " + "a b c " * 9),
    words("a a b " * 20 + "a a c " * 20),
    words("a b " * 100 + "a " * 40 + "b " * 50),
    words(prose(1, 30), (prose(2, 12) + " ") * 3, prose(3, 40)),
    words(prose(1, 30), (prose(2, 12) + " ") * 2, prose(3, 40)),
    words(((("u v " * 13) + "w ") * 4 + "z ") * 3),
    [],
]


@pytest.mark.parametrize("text", CASES)
def test_runs_are_those_of_all_periods_tried(text):
    assert R.runs_of([text])[0] == brute(text)


def test_random_texts_together():
    draw = random.Random(5)
    for letters, least, power in [(1, 24, 3), (2, 24, 3), (2, 6, 3), (3, 4, 3), (2, 8, 4), (5, 1, 3)]:
        texts = []
        for _ in range(60):
            base = [b"%d" % draw.randrange(letters) for _ in range(draw.randrange(1, 12))]
            text = base * draw.randrange(1, 12)
            for _ in range(draw.randrange(4)):
                text[draw.randrange(len(text))] = b"%d" % draw.randrange(letters)
            texts.append(text + [b"%d" % draw.randrange(letters) for _ in range(draw.randrange(30))])
        settings = R.Settings(least, power)
        assert R.runs_of(texts, settings=settings) == [brute(t, least, power) for t in texts]


def test_suffix_array_and_lcp():
    draw = random.Random(2)
    for _ in range(50):
        sizes = [draw.randrange(1, 20) for _ in range(3)]
        codes = np.concatenate([np.array([draw.randrange(2) for _ in range(n)]) + 2 * k for k, n in enumerate(sizes)])
        ends = np.repeat(np.cumsum(sizes), sizes)
        sa, isa, lcp = R.suffix_array(codes, ends)
        suffixes = [tuple(codes[i : ends[i]]) for i in range(len(codes))]
        assert [suffixes[i] for i in sa] == sorted(suffixes) and (sa[isa] == np.arange(len(codes))).all()
        for j in range(1, len(codes)):
            a, b = suffixes[sa[j - 1]], suffixes[sa[j]]
            assert lcp[j] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_long_texts_of_one_word_and_of_lines():
    assert R.runs_of([[b"a"] * 200_000])[0] == [(0, 200_000, 1)]
    line = words(prose(4, 9))
    assert R.runs_of([line * 20_000])[0] == [(0, 180_000, 9)]
    assert R.runs_of([words(prose(6, 60_000))])[0] == []


def test_bad_settings():
    with pytest.raises(ValueError):
        R.Settings(least_power=2)


def contract(number, text):
    """The contract, literally."""
    w = text.encode().split() if text else []
    n, h = len(w), zlib.crc32(str(number).encode())
    if h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_is_the_contract(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r[0]: tuple(r[1:]) for r in R.op12_runs(spark, DATA).collect()}
    short = {k: t for k, t in texts.items() if t is None or len(t) < 30_000}
    assert got.keys() == texts.keys() and len(short) > 150
    assert {k: got[k] for k in short} == {k: contract(k, t) for k, t in short.items()}
    assert sum(v[0] > 0 for v in got.values()) > 5


def test_planted_runs_of_odd_rows(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate([None, "", " \t ", "one", "a b", "ä ö ü é"] * 20)] + [(None, "x y " * 30), (7, "x y " * 30), (7, "x y " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in R.op12_runs(spark, str(tmp_path)).collect()), key=str)
    wanted = [(k, *(contract(k, t) if k is not None else contract(1, t))) for k, t in rows]
    assert got == sorted(wanted, key=str)


def test_rows_that_are_odd(frame):
    repeated = "x y z " * 10
    df = frame([(1, None), (2, ""), (3, repeated), (3, repeated), (None, repeated), (5, "word " * 60_000)], ["runs", "Collapsed", "h"])
    got = R.periodic_runs(df).collect()
    assert sorted((r.doc_id or 0, len(r.runs), len(r.collapsed)) for r in got) == [(0, 1, 5), (1, 0, 0), (2, 0, 0), (3, 1, 5), (3, 1, 5), (5, 1, 4)]
    assert {r.h for r in got} == {"mine"} and R.periodic_runs(frame([])).count() == 0
