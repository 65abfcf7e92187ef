import math
import re

import numpy as np
import pytest
import synthetic
from pyspark.sql import functions as F

from lakemodels.analytics import isoforest, kmeans, scaling, tfidf
from lakemodels.operators import quantile
from lakemodels.operators.quantile import exact_quantile, flag_low
from lakemodels.operators.windows import GROUP_LIMIT, top_per_group


def brute_force_neighbours(texts, n, max_df=0.95, stop=()):
    """Straight TF-IDF over a small list of (id, text)."""
    counts = {}
    for i, text in texts:
        words = [w for w in re.findall(r"\w\w+", text.lower()) if w not in stop]
        counts[i] = {w: words.count(w) for w in set(words)}
    df = {}
    for words in counts.values():
        for w in words:
            df[w] = df.get(w, 0) + 1
    vectors = {}
    for i, words in counts.items():
        raw = {w: c * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, c in words.items() if df[w] <= max_df * len(texts)}
        norm = math.sqrt(sum(x * x for x in raw.values())) or 1.0
        vectors[i] = {w: x / norm for w, x in raw.items()}
    out = set()
    for i, a in vectors.items():
        scored = []
        for j, b in vectors.items():
            score = sum(x * b[w] for w, x in a.items() if w in b)
            if i != j and score > 0:
                scored.append((-round(score, 6), j))
        for rank, (score, j) in enumerate(sorted(scored)[:n], 1):
            out.add((i, j, rank, -score))
    return out


def neighbours(spark, texts, n, **options):
    frame = spark.createDataFrame(texts, "id bigint, text string")
    return {tuple(r) for r in tfidf.tfidf_top_n(frame, "id", F.col("text"), n, **options).collect()}


def close(a, b):
    strip = lambda s: {r[:3] for r in s}
    return strip(a) == strip(b) and all(
        any(x[:3] == y[:3] and abs(x[3] - y[3]) < 2e-6 for y in b) for x in a
    )


@pytest.mark.parametrize("seed, size, words", [(1, 60, 12), (2, 80, 40), (3, 40, 5)])
def test_neighbours_equal_brute_force(spark, seed, size, words):
    """Skewed vocabularies, many exact copies, empty texts."""
    rng = np.random.default_rng(seed)
    weights = 1 / np.arange(1, words + 1)
    texts = []
    for i in range(size):
        length = int(rng.integers(0, 7))
        texts.append((i, " ".join(f"word{w}" for w in rng.choice(words, length, p=weights / weights.sum()))))
    texts += [(1000 + i, texts[3][1]) for i in range(size // 2)]
    assert close(neighbours(spark, texts, 3), brute_force_neighbours(texts, 3))


def test_split_postings_give_the_same_neighbours(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "_TEXTS_PER_SHARE", 4)
    texts = [(i, f"common word{i % 7} word{i % 5}") for i in range(40)]
    assert close(neighbours(spark, texts, 3, max_df=1.0), brute_force_neighbours(texts, 3, max_df=1.0))


@pytest.mark.parametrize("texts_per_block, by_block", [(2_000, True), (20, True), (1, False)])
def test_both_ways_of_scoring(spark, monkeypatch, texts_per_block, by_block):
    """Texts with many common terms meet by block, others pair by pair; the result is the same."""
    monkeypatch.setattr(tfidf, "_TEXTS_PER_BLOCK", texts_per_block)
    used, plain = [], tfidf._met_by_block
    monkeypatch.setattr(tfidf, "_met_by_block", lambda *a: used.append(1) or plain(*a))
    texts = [(i, f"one{i % 3} two{i % 5} three{i % 7} four{i % 11}") for i in range(150)]
    assert close(neighbours(spark, texts, 3), brute_force_neighbours(texts, 3))
    assert bool(used) == by_block


def test_long_texts_by_block(spark):
    """Texts of some forty words from a skewed vocabulary, near copies among them."""
    rng = np.random.default_rng(7)
    weights = 1 / np.arange(1, 301) ** 0.8
    words = [rng.choice(300, 40, p=weights / weights.sum()) for _ in range(160)]
    words += [np.where(rng.random(40) < 0.1, 299, w) for w in words[:40]]
    texts = [(i, " ".join(f"word{w}" for w in row)) for i, row in enumerate(words)]
    assert close(neighbours(spark, texts, 3), brute_force_neighbours(texts, 3))


def _packed_table(whole, leaders, home, other):
    """A block as its groups hold it; terms are numbered by the power of two of their texts."""
    import pyarrow as pa

    column_counts = (whole > 0).sum(axis=0)
    rows = []
    for row in whole[leaders]:
        at = np.flatnonzero(row)
        entries = np.zeros(len(at), tfidf._ENTRY)
        entries["term"] = (np.log2(column_counts[at]).astype(np.int64) << tfidf._BAND_BITS) + at
        entries["weight"] = row[at]
        rows.append(np.sort(entries, order="term").tobytes())
    same = [home] * len(leaders), [other] * len(leaders)
    return pa.table({"leader": leaders, "vector": pa.array(rows, pa.binary()), "threshold": np.full(len(leaders), -1e-6), "block_a": same[0], "block_b": same[1]})


def _skewed_matrix(rng, texts, terms=3_000, words=120):
    weights = 1 / np.arange(1, terms + 1)
    matrix = np.zeros((texts, terms))
    for row in matrix:
        at, times = np.unique(rng.choice(terms, words, p=weights / weights.sum()), return_counts=True)
        row[at] = times
    matrix *= np.log((1 + texts) / (1 + (matrix > 0).sum(axis=0))) + 1
    return matrix / np.linalg.norm(matrix, axis=1)[:, None]


@pytest.mark.parametrize("same", [True, False])
def test_no_neighbour_is_lost_between_blocks(same):
    n, rng = 3, np.random.default_rng(3)
    matrix = _skewed_matrix(rng, 500)
    left, right = (np.arange(500), np.arange(500)) if same else (np.arange(250), np.arange(250, 500))
    score = matrix @ matrix.T
    a, b, got = tfidf._meet(
        _packed_table(matrix, left, 0, 0 if same else 1), _packed_table(matrix, right, 0, 0 if same else 1), n
    )
    found = {(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())}
    found |= {(y, x) for x, y in found}
    assert np.allclose(got, [score[x, y] for x, y in zip(a.to_pylist(), b.to_pylist())])
    for x in [*left, *([] if same else right)]:
        others = [y for y in (right if same or x < 250 else left) if y != x]
        best = sorted(others, key=lambda y: -score[x, y])[:n]
        assert {(x, y) for y in best} <= found


def test_pairs_that_are_scored_grow_slower_than_all_pairs():
    """Under a tenth of all pairs outlives the bands, and ten times the texts score under 20 times the pairs."""
    scored = []
    for texts in (200, 2_000):
        rng = np.random.default_rng(5)
        matrix = _skewed_matrix(rng, texts, 3_000)
        table = _packed_table(matrix, np.arange(texts), 0, 0)
        sides = [tfidf._entries(table["vector"].combine_chunks())] * 2
        needs = [np.full(texts, -1e-6), np.full(texts, -1e-6)]
        terms = np.unique(sides[0][1]["term"])
        active = tfidf._active(sides, [texts, texts], needs, terms, 3, True)
        scored.append(int(active.sum()))
        assert active.sum() < 0.1 * texts * (texts - 1) / 2
    assert scored[1] < 20 * scored[0]


def test_a_third_of_all_texts_are_one_copy(spark):
    texts = [(i, "same old words here") for i in range(30)] + [(100 + i, f"other number{i} words") for i in range(60)]
    found = neighbours(spark, texts, 2)
    assert {r[1] for r in found if r[0] == 5} == {0, 1} and {r[1] for r in found if r[0] == 0} == {1, 2}
    assert close(found, brute_force_neighbours(texts, 2))


def test_stop_words(spark):
    texts = [(1, "the red ball"), (2, "the blue car"), (3, "red car")]
    assert close(neighbours(spark, texts, 2, stop_words=["the"]), brute_force_neighbours(texts, 2, stop=("the",)))


@pytest.mark.parametrize("q", [0, 0.005, 0.1, 0.5, 0.731, 0.995, 1])
@pytest.mark.parametrize("band", [3, 40, 100_000])
def test_quantiles_are_exact(spark, q, band):
    rng = np.random.default_rng(5)
    # Heavy ties: a third of all rows share one value.
    values = np.concatenate([rng.normal(size=400), np.full(200, 0.25), [float("nan")]])
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    assert exact_quantile(frame, F.col("v"), q, band) == pytest.approx(np.quantile(values[:-1], q), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("q", [0, 0.31, 0.5, 1])
def test_a_sketch_that_is_off_does_no_harm(spark, monkeypatch, q):
    monkeypatch.setattr(quantile, "_SKETCH", 8)
    monkeypatch.setattr(quantile, "_RANK_ERROR", 0.002)
    values = np.random.default_rng(9).normal(size=3_000).round(2)
    frame = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    assert exact_quantile(frame, F.col("v"), q, 40) == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_a_quantile_takes_three_scans(spark, monkeypatch):
    looks, look = [], quantile._look
    monkeypatch.setattr(quantile, "_look", lambda *a: looks.append(1) or look(*a))
    frame = spark.range(500_000).select((F.pmod(F.xxhash64("id"), F.lit(10**12)) / 7.0).alias("v"))
    exact = np.quantile(np.array([r.v for r in frame.collect()]), 0.123)
    assert exact_quantile(frame, F.col("v"), 0.123) == pytest.approx(exact, rel=1e-12)
    assert len(looks) == 2  # and one sort of what is left


def test_quantiles_of_infinite_values(spark):
    inf = float("inf")
    frame = spark.createDataFrame([(v,) for v in [-inf, -1.0, 0.0, 1.0, inf] * 9], "v double")
    assert exact_quantile(frame, F.col("v"), 0.5, 3) == 0.0 and exact_quantile(frame, F.col("v"), 0.0, 3) == -inf


def test_quantile_edges(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantile(empty, F.col("v"), 0.5) is None
    with pytest.raises(ValueError):
        exact_quantile(empty, F.col("v"), 1.5)
    flagged = flag_low(spark.range(1000).withColumn("v", F.col("id").cast("double")), "v", 0.01)
    assert flagged.where("is_anomaly").count() == 10


def test_standardize(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = scaling.standardize(frame, ["a", "b"]).orderBy("a").collect()
    assert [r.b_scaled for r in scaled] == [0.0] * 3
    assert [round(r.a_scaled, 6) for r in scaled] == [-1.224745, 0.0, 1.224745]


def test_kmeans_finds_the_planted_kinds(spark):
    people = synthetic.customers(spark, 900).cache()
    features = ["orders_last_90d", "avg_order_value", "days_since_signup"]
    clusters = kmeans.kmeans_clusters(people, features, restarts=3)
    assert clusters.schema["cluster_id"].dataType.simpleString() == "smallint"
    summary = {r.cluster_id: r for r in kmeans.cluster_summary(clusters, features).collect()}
    assert sorted(summary) == [0, 1, 2] and sum(r.n_rows for r in summary.values()) == 900
    # Numbered by centroid: light, casual, power customers.
    assert summary[0].avg_orders_last_90d < summary[1].avg_orders_last_90d < summary[2].avg_orders_last_90d
    for row in clusters.groupBy("cluster_id").agg(F.first("centroid").alias("c"), F.count_distinct("centroid").alias("n")).collect():
        assert row.n == 1
        assert row.c.orders_last_90d == pytest.approx(summary[row.cluster_id].avg_orders_last_90d, abs=0.5)
    people.unpersist()


def test_kmeans_does_not_depend_on_partitions(spark):
    people = synthetic.customers(spark, 400).cache()
    features = ["orders_last_90d", "avg_order_value", "days_since_signup"]
    doubled = people.unionByName(people)  # equal rows count by weight
    fits = [kmeans.fit_centroids(frame.repartition(n), features, restarts=2) for n, frame in ((1, people), (7, people), (64, people), (5, doubled))]
    for other in fits[1:3]:
        assert np.allclose(other["original"], fits[0]["original"], rtol=1e-9) and np.allclose(other["scaled"], fits[0]["scaled"], rtol=1e-9)
    assert np.allclose(fits[3]["original"], fits[0]["original"], rtol=0.02)
    odd = people.unionByName(people.limit(3).withColumn("avg_order_value", F.lit(None).cast(people.schema["avg_order_value"].dataType)))
    assert np.allclose(kmeans.fit_centroids(odd, features, restarts=2)["original"], fits[0]["original"], rtol=1e-9)
    people.unpersist()


def test_isolation_forest_finds_the_planted_rows(spark):
    placed = synthetic.orders(spark, 3000)
    from lakemodels.functions import scalars

    rows = placed.withColumn("hour_of_day", scalars.hour_of_day(F.col("ordered_at"))).withColumn(
        "day_of_week", scalars.day_of_week(F.col("ordered_at"))
    )
    features = ["amount", "hour_of_day", "day_of_week"]
    scored = isoforest.isolation_forest(rows, "order_id", features)
    n, flagged, planted, low, high = scored.agg(
        F.count("*"), F.count_if("is_anomaly"), F.count_if((F.col("order_id") < 0) & F.col("is_anomaly")),
        F.min("anomaly_score"), F.max("anomaly_score"),
    ).first()
    assert n == 3005 and 10 <= flagged <= 16 and planted == 5
    assert -1 < low < 0 < high < 1
    again = isoforest.isolation_forest(rows, "order_id", features)
    assert again.where("is_anomaly").select("order_id").exceptAll(scored.where("is_anomaly").select("order_id")).isEmpty()


def test_tree_samples_are_bounded_and_repeatable(spark):
    frame = spark.range(60_000).withColumn("x", F.col("id") * 1.0)
    for rows_used in (frame, frame.where("id < 1000"), frame.where("id < 100")):
        sample = isoforest.tree_samples(rows_used, "id", 20, 256, 1)
        per_tree = {r.tree: r["count"] for r in sample.groupBy("tree").count().collect()}
        assert set(per_tree.values()) == {min(256, rows_used.count())} and len(per_tree) == 20
        assert sample.exceptAll(isoforest.tree_samples(rows_used, "id", 20, 256, 1)).isEmpty()
        assert sample.count() == sample.select("tree", "id").distinct().count()


@pytest.mark.parametrize("n", [3, GROUP_LIMIT + 1])
def test_top_rows_of_a_hot_group(spark, n):
    frame = spark.range(6000).selectExpr("IF(id < 5000, 0, 1) AS g", "pmod(xxhash64(id), 100000) AS v", "id")
    got = top_per_group(frame, ["g"], [F.col("v"), F.col("id")], n)
    wanted = {}
    for r in frame.collect():
        wanted.setdefault(r.g, []).append((r.v, r.id))
    wanted = {(g, i, k + 1) for g, rows in wanted.items() for k, (_, i) in enumerate(sorted(rows)[:n])}
    assert {(r.g, r.id, r["rank"]) for r in got.collect()} == wanted and got.columns == ["g", "v", "id", "rank"]


def test_every_group_is_limited_before_it_meets_in_one_task(spark):
    frame = spark.range(100_000).selectExpr("id % 2 AS g", "id")
    small = top_per_group(frame, ["g"], [F.col("id")], 500)._jdf.queryExecution().executedPlan().toString()
    large = top_per_group(frame, ["g"], [F.col("id")], 5000)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in small and "__share" in large and "__share" not in small


def test_tree_samples_follow_one_rule_at_every_size(spark):
    for n in (600, 50_000):
        samples = isoforest.tree_samples(spark.range(n), "id", 100, 256, 42)
        sizes, distinct = samples.groupBy("tree").count().agg(F.min("count"), F.max("count")).first(), samples.select("id").distinct().count()
        assert tuple(sizes) == (256, 256) and distinct < 25_600
    # No row is expanded into all trees before its draws are made.
    assert "Generate explode(filter(" in samples._jdf.queryExecution().optimizedPlan().toString()


def test_weights_shuffle_texts_and_terms_of_parts_only(spark):
    """No row per term and text is shuffled, by text or by term; rows that share an id are one text, as in the SQL."""
    df = spark.createDataFrame([(1, "red fox red"), (1, "blue fox"), (2, "blue sky"), (3, ""), (4, None)], "id bigint, text string")
    weights = tfidf.tfidf_weights(df, "id", F.col("text"))
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"Exchange hashpartitioning\(([a-z_]+)", plan)) <= {"__part", "to_part", "term"}
    got = {(r.id, r.term): (r.tf, r.df, round(r.weight, 6)) for r in weights.collect()}
    idf = {t: math.log(5 / (1 + n)) + 1 for t, n in [("red", 1), ("fox", 1), ("blue", 2), ("sky", 1)]}
    wanted = {}
    for text, terms in [(1, {"red": 2, "fox": 2, "blue": 1}), (2, {"blue": 1, "sky": 1})]:
        norm = math.sqrt(sum((k * idf[t]) ** 2 for t, k in terms.items()))
        wanted |= {(text, t): (k, {"blue": 2}.get(t, 1), round(k * idf[t] / norm, 6)) for t, k in terms.items()}
    assert got == wanted


def test_texts_meet_without_a_shuffle(spark, monkeypatch):
    """Slices are sent to the tasks; the vectors lie on disk once, however many slices there are."""
    monkeypatch.setattr(tfidf, "_TEXTS_PER_SLICE", 40)
    monkeypatch.setattr(tfidf, "_TEXTS_PER_BLOCK", 16)
    stored, plain = [], tfidf._meeting
    monkeypatch.setattr(tfidf, "_meeting", lambda *a: stored.append(a[1]) or plain(*a))
    rng = np.random.default_rng(5)
    matrix = np.abs(rng.normal(size=(150, 30))) * (rng.random((150, 30)) < 0.4)
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    rows = []
    for i, row in enumerate(matrix):
        entries = np.array([(int(t), row[t]) for t in np.flatnonzero(row)], tfidf._ENTRY)
        rows.append((i, bytearray(entries.tobytes()), None))
    met = tfidf._met_by_block(spark.createDataFrame(rows, "leader bigint, vector binary, threshold double"), 3)
    pairs = {(r.a, r.b): r.score for r in met.collect()}
    assert len(stored) == 4 and "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
    score = matrix @ matrix.T
    np.fill_diagonal(score, -1)
    for i in range(150):
        for j in np.argsort(-score[i])[:3]:
            assert abs((pairs.get((i, j)) or pairs.get((j, i))) - score[i, j]) < 1e-9
    assert all(a != b and (b, a) not in pairs for a, b in pairs)
