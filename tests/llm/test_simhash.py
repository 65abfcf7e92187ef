import hashlib
import random

from conftest import DATA
from llm_data import frame, prose  # noqa: F401

from lakemodels.llm import simhash as S


def brute(rows):
    prints, out = S.Fingerprints(), {}
    ordered = sorted(rows, key=lambda r: -r[0])
    for k, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other, next_one = prints.of(text), prints.of(changed), prints.of(following)
        out[doc_id] = (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), own.hex(), other.hex(),
            S.likeness(own, other), S.likeness(own, next_one),
        )
    return out


def result(df):
    return {
        r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect()
    }


def test_neighbours_across_ranges(frame):
    rows = [(k * 3, prose(k, k % 40)) for k in range(120)] + [(1000, None), (1001, ""), (1002, "é" * 7), (-5, "a b c d")]
    random.Random(1).shuffle(rows)
    assert result(S.with_next(frame(rows))) == brute(rows)


def test_query_equals_brute_force(spark):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = S.op9_simhash(spark, DATA)
    wanted = brute(documents)
    assert result(got) == wanted
    values = [int(w[2], 16) for w in wanted.values()]
    for r in got.where("doc_id % 50 = 0").collect():
        assert r.n_within == sum((int(r.fingerprint, 16) ^ v).bit_count() <= S.RADIUS for v in values)
    assert got.where("doc_id % 50 <> 0 and n_within is not null").count() == 0


def test_edits_are_nearer_than_strangers(spark):
    got = S.with_next(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 400"))
    near, far = got.selectExpr("percentile(near_edited, 0.05)", "percentile(near_next, 0.95)").first()
    assert near > far


def test_search_finds_all_within_the_radius(spark):
    draw, base = random.Random(4), random.Random(8).getrandbits(S.BITS)
    values = [base]
    for k in range(120):
        value = base
        for bit in draw.sample(range(S.BITS), k % 14):
            value ^= 1 << bit
        values.append(value)
    values += [draw.getrandbits(S.BITS) for _ in range(200)]
    texts = [f"{v:064x}" for v in values]
    df = spark.createDataFrame([(t,) for t in [*texts, texts[3]]], "fingerprint string")
    asked = df.where(df.fingerprint.isin(texts[:5] + texts[130:133]))
    got = {(r.asked, r.found, r.distance) for r in S.within(asked, df).collect()}
    wanted = set()
    for a in {r.fingerprint for r in asked.collect()}:
        wanted |= {(a, t, d) for t in texts for d in [(int(a, 16) ^ int(t, 16)).bit_count()] if d <= S.RADIUS}
    assert got == wanted


def test_rows_that_are_odd(frame):
    one = S.with_next(frame([(4, "only one text here")], ["fingerprint", "part"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    ties = S.with_next(frame([(1, "a b c d"), (1, "a b c d"), (1, "x y z"), (None, "n"), (None, None)])).collect()
    assert len(ties) == 5 and len({r.fingerprint for r in ties if r.n_chars == 7}) == 1
    assert S.with_next(frame([])).count() == 0
    long = S.Fingerprints()
    assert long.of("word " * 50_000) == long.of("word " * 50_000) and long.of("") == bytes(S.BITS // 8)


def test_search_sends_only_asked_blocks_to_the_join(spark):
    draw = random.Random(9)
    texts = [f"{draw.getrandbits(S.BITS):064x}" for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "fingerprint string")
    found = S.within(df.where(df.fingerprint.isin(texts[:3])), df)
    assert sorted(r.found for r in found.collect()) == sorted(texts[:3])
    values = [[draw.getrandbits(63) - 2**62 for _ in range(3)] for _ in texts]
    keys = spark.createDataFrame(list(zip(texts, values)), "fingerprint string, keys array<long>")
    bloom = S.bloom_of(spark.createDataFrame([(values[7][1],), (values[9][0],)], "key long"), "key", S.ASKED_BITS)
    kept = {(r.fingerprint, tuple(r["keys"])) for r in S._kept_keys(keys, bloom).collect()}
    assert kept == {(texts[7], (values[7][1],)), (texts[9], (values[9][0],))}


def test_query_keeps_its_rows_once(spark):
    """The finished rows are checkpointed by with_next alone, and rows that ask nothing meet no join."""
    plan = S.op9_simhash(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    union = plan.splitlines()[0]
    assert "Union" in union
