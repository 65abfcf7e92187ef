"""The pipeline, stage by stage, against plain versions on the given documents."""

import corpus_pipeline
import public_tokenizers
import pytest
from conftest import DATA
from llm_data import frame  # noqa: F401
from test_minhash import brute as near_classes
from test_secrets import brute_base
from tokenizers import Tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and behind each one."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], DATA).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert [s.columns for s in stages[:-1]] == [COLUMNS] * 5
    assert stages[-1].columns == ["doc_id", "lang", "source", "n_tokens", "ids"]


def test_toxic_documents_go_and_clean_ones_stay(spark):
    """On the larger tables: the smallest ones label too few documents to learn from.

    These label 34 toxic documents to learn from, too few for terms that a tenth of them share.
    """
    folder = DATA.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    before, after = texts(docs), texts(corpus_pipeline.drop_toxic(spark, docs, folder))
    assert after.items() <= before.items()
    gone = set(before) - set(after)
    assert not [d for d in gone if labels.get(d) == 0]
    toxic = [d for d in labels if labels[d] == 1]
    assert len(gone & set(toxic)) >= 0.5 * len(toxic)


def test_one_of_each_class_stays(stages):
    before = texts(stages[1])
    classes = near_classes(list(before.items()))
    assert texts(stages[2]) == {d: t for d, t in before.items() if classes[d][2]}


def test_documents_with_benchmark_items_go(spark, stages):
    items = [r.text.split() for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    before = texts(stages[2])
    leaks = {d for d, t in before.items() if any(" ".join(i) in " ".join(t.split()) for i in items)}
    assert set(before) - set(texts(stages[3])) == leaks


def test_secrets_are_hidden(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for d, text in before.items():
        assert brute_base(after[d]) == ""
        assert (after[d] != text) >= bool(brute_base(text))
    assert stages[4].where("n_chars <> char_length(text)").count() == stages[3].where("n_chars <> char_length(text)").count()


def test_ids_are_those_of_the_library(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before = texts(stages[4])
    got = {r.doc_id: list(r.ids) for r in stages[5].collect()}
    assert got == {d: library.encode(t, add_special_tokens=False).ids for d, t in before.items()}


def test_run_is_the_stages(spark, stages):
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == {r.doc_id: r.n_tokens for r in stages[-1].collect()}


def test_only_the_copy_goes_where_an_id_has_several_texts(frame):
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    docs = frame([(3, b), (5, a), (5, b), (8, c), (8, c + " end"), (8, c), (9, "  ".join(c.split()))])
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_near_copies(docs.sparkSession, docs, DATA).collect())
    assert got[:2] == [(3, b), (5, a)]
    assert len(got) == 3 and got[2][0] == 8 and got[2][1] in (c, c + " end")


def test_rows_that_are_odd(spark):
    rows = [(1, "same text of more than five words", "en", "a", 33), (1, "same text of more than five words", "en", "a", 33),
            (None, "no id here", None, None, None), (3, None, "en", "a", None), (4, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0
        docs = spark.createDataFrame(stage(spark, docs, DATA).collect(), docs.schema) if stage is not corpus_pipeline.STAGES[-1][1] else docs
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "3", "4", "None"]
