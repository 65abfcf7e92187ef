import random

import pytest

from conftest import DATA, rows
from llm_data import frame, prose  # noqa: F401

from lakemodels.llm import licenses as L

SMALL = {"one": ["Released under the first small license of ours."], "two": ["Licensed under the second. It has two sentences, and a line."], "single": ["Unlicensed"]}


def brute(text, texts, threshold):
    """All runs of units against all templates, then the choice."""
    units = [m.span() for m in L._UNIT.finditer(text or "") if m.end() > m.start() and L.words_of(text[slice(*m.span())])]
    found = []
    for name, versions in texts.items():
        for version in versions:
            wanted = L.bigrams(L.words_of(version))
            for i in range(len(units)):
                for j in range(i, len(units)):
                    words = [w for a, b in units[i : j + 1] for w in L.words_of(text[a:b])]
                    ends = [L.bigrams(L.words_of(text[slice(*units[k])])) for k in (i, j)]
                    score = L.dice(L.bigrams(words), wanted)
                    touches = all(e & wanted for e in ends) if len(words) > 1 else True
                    if score >= threshold and touches:
                        found.append((-score, -len(wanted), i, j, name))
    used, out = set(), []
    for score, _, i, j, name in sorted(found):
        if not used & set(range(i, j + 1)):
            used |= set(range(i, j + 1))
            start = units[i][0] + len(text[slice(*units[i])]) - len(text[slice(*units[i])].lstrip())
            out.append((start, units[j][1], name, -score))
    return sorted(out)


def test_equals_all_runs():
    draw, known = random.Random(2), L.Templates(SMALL, 0.6)
    pieces = ["Released under the first small licence of ours.", "Licensed under the second.", "It has two sentences, and a line.", "Other words here.", "Unlicensed", "released UNDER the; first small license\n", "\n\n"]
    for _ in range(300):
        text = draw.choice([" ", "\n"]).join(draw.choice(pieces) for _ in range(draw.randrange(1, 9)))
        got = known.scan(text)
        assert [g[:3] for g in got] == [b[:3] for b in brute(text, SMALL, 0.6)], text


def test_templates_find_themselves_in_other_text():
    known = L.Templates(L.TEMPLATES, L.THRESHOLD)
    for name, versions in L.TEMPLATES.items():
        for version in versions:
            text = prose(1, 40) + ".\n" + version.upper() + "\n" + prose(2, 40) + "."
            assert [g[2] for g in known.scan(text)] == [name], version[:60]
    assert known.scan(prose(3, 500)) == []


def test_query_finds_every_license_line(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    lines = documents.selectExpr("doc_id", "explode(split(text, '\\n')) AS line").where("line rlike '^(Licensed|Released|This work is licensed) under'")
    got = L.op10_licenses(spark, DATA)
    assert got.where("dice < 0.8").count() == 0
    assert rows(got.select("doc_id").distinct()) == rows(lines.select("doc_id").distinct())


def test_rows_that_are_odd(frame):
    line = "Released under the MIT License."
    df = frame([(1, None), (2, ""), (3, line), (3, line), (None, line), (5, (line + "\n") * 3000)], ["license", "dice"])
    got = L.scan(df)
    assert rows(got.groupBy("doc_id").count()) == [(None, 1), (3, 2), (5, 3000)]
    assert L.scan(frame([])).count() == 0


def test_many_equal_lines_cost_a_few_steps_each():
    """20 000 lines, alone and with other lines between; memory and time grow with the lines."""
    import time
    import tracemalloc

    line, known = "Released under the MIT License.", L.Templates(L.TEMPLATES, L.THRESHOLD)
    known.scan(line)
    for text in [(line + "\n") * 20_000, "".join(f"{line}\nother words {i % 7}\n" for i in range(10_000)), "license\n" * 20_000 + line]:
        began = time.process_time()
        tracemalloc.start()
        found = known.scan(text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(found) == text.count(line)
        assert peak < 200e6
        assert time.process_time() - began < 20  # tracing slows it several times


def every_run(words, wanted, threshold):
    """(score, first, last) of all runs of units whose ends share a bigram, or one with a neighbour, with the template."""
    cross = [(a[-1], b[0]) for a, b in zip(words, words[1:])]
    near = [
        i for i, w in enumerate(words)
        if L.bigrams(w) & wanted or (i < len(cross) and cross[i] in wanted) or (i and cross[i - 1] in wanted)
    ]
    for i in near:
        for j in near:
            score = L.dice(L.bigrams(sum(words[i : j + 1], [])), wanted) if i <= j else 0
            if score >= threshold:
                yield score, i, j


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_single_words_and_repeats_equal_all_runs(threshold):
    small = {"one": ["license"], "two": ["license terms"], "three": ["license terms license terms apply here"]}
    draw, known = random.Random(5), L.Templates(small, threshold)
    for _ in range(300):
        units = [draw.choice(["license", "terms", "license terms", "apply here", "x"]) for _ in range(draw.randrange(1, 12))]
        runs = [
            (-score, -len(known.sets[n]), i, j, n)
            for n in known.candidates("\n".join(units))
            for score, i, j in every_run([u.split() for u in units], known.sets[n], threshold)
        ]
        used, wanted = set(), []
        for score, _, i, j, n in sorted(runs):
            if not used & set(range(i, j + 1)):
                used |= set(range(i, j + 1))
                wanted.append((sum(len(u) + 1 for u in units[:i]), known.names[n], -score))
        assert [(g[0], g[2], g[3]) for g in known.scan("\n".join(units))] == sorted(wanted), units
