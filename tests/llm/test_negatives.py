import math
import random

import numpy as np
import oracle
import pytest
from conftest import DATA

from lakemodels.llm import negatives as N

SCHEMA = "id long, label int, vector array<double>, extra string"


def brute(rows, settings=N.Settings(), every=100):
    """All pairs, by whole numbers."""
    best = {}
    for number, label, vector, *_ in rows:
        if number is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own = (label, [max(-(2**63), min(2**63 - 1, math.floor(settings.scale * x))) for x in vector])
        best[number] = min(best.get(number, own), own)
    long = lambda s: max(-N.LONG, min(N.LONG, s))
    out = []
    for a, (label, x) in best.items():
        if a % every:
            continue
        scored = sorted((-long(sum(p * q for p, q in zip(x, y))), b, other == label) for b, (other, y) in best.items() if b != a)
        for score, p, _ in [s for s in scored if s[2]][: settings.positives]:
            inside = [s for s in scored if not s[2] and settings.least_percent * -score <= 100 * -s[0] <= 100 * -score]
            out += [(a, p, k, n, -score, -s) for k, (s, n, _) in enumerate(inside[: settings.negatives], 1)]
    return sorted(out)


def made(spark, rows, settings, every=100):
    df = spark.createDataFrame([(*r, "mine")[:4] for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, N.hard_negatives(df, f"id % {every} = 0", settings).collect()))


def test_same_as_all_pairs(spark):
    draw = random.Random(8)
    near = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(k, draw.randrange(4), [x + draw.gauss(0, 0.4) for x in near[draw.randrange(4)]]) for k in range(900)]
    rows += [(k + 900, draw.randrange(3), [draw.choice([-1.0, 0.0, 0.0, 1.0]) for _ in range(6)]) for k in range(300)]
    small = N.Settings(first_step=2, block_rows=64, slice_anchors=7, task_rows=200)
    got = made(spark, rows, small)
    assert got == brute(rows) and len(got) > 100
    assert made(spark, rows, N.Settings(positives=2, negatives=9, least_percent=50)) == brute(rows, N.Settings(positives=2, negatives=9, least_percent=50))


def test_rows_that_are_odd(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, 1, [1.0, 0.0]), (None, 1, [1.0, 1.0]), (1, None, [1.0, 1.0]), (2, 1, None), (3, 1, [1.0, None]), (4, 1, [nan, 1.0]),
        (5, 1, [inf, 1.0]), (6, 1, [2.0, 1.0]), (7, 2, [1.9, 5.0]), (7, 2, [1.9, 5.0]), (7, 2, [0.0]), (8, 2, [1.8]), (9, 2, [1.7, 0.0, 3.0]),
        (10, 1, []), (11, 2, []), (100, 5, [0.0, 0.0]), (101, 5, [1.0, 2.0]), (200, 9, [1.0]), (300, 1, [-1e18, 4e17]), (301, 3, [-1e18, 3.9e17]),
        (302, 1, [-1e30, 1.0]), (303, 4, [-1e30, 1.0]), (400, -3, [-1.0, -1.0]), (401, -3, [0.5, 0.5]),
    ]
    assert made(spark, rows, N.Settings()) == brute(rows)
    assert made(spark, [], N.Settings()) == []
    assert made(spark, [(100, 1, [1.0])], N.Settings()) == []


def test_threshold_stops_early():
    draw = np.random.default_rng(1)
    x = np.floor(256 * draw.exponential(size=(8192, 4)) ** 2)
    block = N.Block(np.arange(8192), np.zeros(8192, int), x)
    window = N.Range(5, None, None)
    scored = N.search(block, x[17], np.ones(8192, bool), [window], 16)
    scores = x @ x[17]
    assert window.held == sorted((-int(s), int(i)) for i, s in enumerate(scores))[:5]
    assert scored < 2000
    # A window that the best possible score does not reach is left before the first row.
    assert N.search(block, x[17], np.ones(8192, bool), [N.Range(5, 10**15, 10**16)], 16) == 0


def test_repeated_vectors_and_ties(spark):
    rows = [(k, k % 3, [1.0, 2.0]) for k in range(500)]
    assert made(spark, rows, N.Settings(block_rows=50)) == brute(rows)


@pytest.mark.parametrize("folder", [DATA, DATA.replace("0.001", "0.1")])
def test_query_equals_its_sql(spark, folder):
    names, wanted = oracle.duck_rows(oracle.connect(folder), N.SQL["op11_negatives"])
    frame = N.op11_negatives(spark, folder)
    assert sorted(frame.columns) == names and oracle.spark_rows(frame) == wanted and wanted
