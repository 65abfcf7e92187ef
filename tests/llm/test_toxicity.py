import random

import pytest
from conftest import DATA, rows
from llm_data import frame  # noqa: F401
from pyspark.sql import functions as F

from lakemodels.llm import toxicity as X


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def nearest_beginning(word, term):
    return min(distance(word[:k], term) for k in range(len(word) + 1))


def test_automaton_equals_edit_distance():
    terms = ["idiot$", "scum$", "worthless$", "lowei", "trash$"]
    automaton = X.Automaton(terms)
    draw = random.Random(5)
    words = [w.rstrip("$") for w in terms]
    for _ in range(1500):
        word = list(draw.choice(words))
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(word) + 1)
            action = draw.randrange(3)
            if action == 0:
                word.insert(at, draw.choice("abeistw"))
            elif word and at < len(word):
                word[at : at + 1] = [] if action == 1 else [draw.choice("abeistw")]
        word = "".join(word)
        wanted = {}
        for term in terms:
            errors = nearest_beginning(word + "$", term)
            if errors <= X.allowed_errors(term):
                wanted[term] = errors
        assert automaton.matches(word) == wanted, word


def test_misspelled_and_disguised_words_match():
    matcher = X.Matcher(["idiot$", "worthless$", "scum$"])
    assert matcher.match("idoit") is None  # two single errors in a word of five letters
    assert matcher.match("idiiot") == ("idiot$", 1)
    assert matcher.match("1diot") == ("idiot$", 0)
    assert matcher.match("w0rthles") == ("worthless$", 1)
    assert matcher.match("scun") is None  # four letters allow no error


def test_quotation_counts_less():
    matcher, weight = X.Matcher(["idiot$"]), {("idiot$", 0): 4.0}
    direct = X.evidence(matcher, weight, "you are an idiot and more", 5)
    quoted = X.evidence(matcher, weight, 'he used the word "idiot" in his essay', 5)
    assert direct[0] == 5.0 and direct[1] == 0.0
    assert quoted[0] == 0.0 and quoted[1] == 4.0


@pytest.mark.parametrize("text, wanted", [
    ("you don’t know, you moron, it’s over", False),
    ("l’homme est un moron, c’est clair", False),
    ("don‘t, moron, it‘s over", False),
    ("the word ‘moron’ is old", True),
    ("the old “moron” of the tests", True),
    ("das alte „moron“ der Probe", True),
    ("das alte »moron« der Probe", True),
    ("le vieux «moron» des tests", True),
    ("he “sings” moron “sings”", False),
    ("the dogs’ moron of the cats’ house", False),
    ("she’s sure ‘it’s moron’ was meant", True),
    ("a 5\" moron of “this” kind", False),
])
def test_apostrophes_are_no_quotation(text, wanted):
    matcher, weight = X.Matcher(["moron$"]), {("moron$", 0): 4.0}
    assert [m[3] for m in X.evidence(matcher, weight, text, 5)[2]] == [wanted]


@pytest.fixture(scope="module")
def model():
    weights = {("idiot$", 0): 6.0, ("idiot$", 1): 4.0}
    return X.Model(weights, 5, (0.9, 0.2), -3.0, ["idiot$"])


def test_rows_that_are_odd(frame, model):
    df = frame([(1, None), (2, ""), (3, "such an idiot"), (3, "such an idiot"), (None, "fine"), (4, "x " * 50_000)], ["score", "Found"])
    got = X.score(df, model)
    assert got.count() == 6 and "score" in got.columns and "Found" not in got.columns
    scores = {(r.doc_id, r.text): r.score for r in got.collect()}
    assert scores[3, "such an idiot"] > 0.7
    assert scores[1, None] == scores[2, ""] == scores[None, "fine"] < 0.7
    assert rows(got.select("found").distinct()) == [("",), ("idiot$~0x1",)]


def test_empty_tables(frame, spark, model):
    assert X.score(frame([]), model).count() == 0
    nothing = X.fit(spark, frame([(1, "a")]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert X.score(frame([(1, "a")]), nothing).count() == 1


def test_held_out_documents_are_found(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = X.op3_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out")
    right, n, toxic, caught = scored.agg(
        F.expr("count_if(predicted = toxic)"), F.count("*"), F.sum("toxic"), F.expr("count_if(toxic = 1 and predicted = 1)")
    ).first()
    assert n > 100 and right >= 0.95 * n and caught >= 0.75 * toxic
    assert X.op3_toxicity(spark, DATA).count() == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_short_terms_match_masked_swapped_and_repeated():
    matcher = X.Matcher(["scum$", "idiot$"])
    for word in ("sc*m", "s*um", "s**m", "sc4m"):
        assert matcher.match(word) == ("scum$", 0), word
    for word in ("sucm", "csum", "scmu", "scuum", "sscummm"):
        assert matcher.match(word) == ("scum$", 1), word
    for word in ("scam", "scums", "s44m", "sum", "s*m", "sc*b", "scrum"):
        assert matcher.match(word) is None, word


def test_a_masked_short_term_is_evidence():
    matcher, weight = X.Matcher(["scum$"]), {("scum$", 0): 4.0}
    assert X.evidence(matcher, weight, "they are sc*m", 5)[0] == 4.0
