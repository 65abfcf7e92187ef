"""A corpus pipeline of five operators: toxicity, near duplicates, benchmark leaks, secrets, token ids.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before it kept; ``sf_dir`` holds
the side tables (labels, benchmark). All stages but the last return the columns of ``documents``.

Rows without doc_id or text pass all filters. Repeated rows count as copies: one of them stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemodels.llm import bpe, decontamination, minhash, secrets, toxicity
from lakemodels.llm.plans import read
from lakemodels.sources.workspace import freeze, fresh_dir, remove_dir

REJECTED_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold. The score is learned from labels that are not held out."""
    labels = read(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.fit(spark, docs, labels)
    named = docs.select(*[F.col(c).alias(f"in_{c}") for c in docs.columns])
    scored = toxicity.score(named, model, "in_text").where(F.col("score") < REJECTED_FROM)
    return scored.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates: of the rows with its smallest doc_id, the one least by digest.

    A row is known by doc_id and the digest of its text, so other texts under the doc_id of a copy stay.
    """
    keyed = docs.select("doc_id", "text", F.md5("text").alias("row_digest"))
    marked = freeze(minhash.near_duplicates(keyed, carry=["row_digest"]).where("doc_id is not null and n_shingles > 0"))
    first = marked.where("kept").groupBy("component_id").agg(
        F.min("row_digest").alias("first"), F.max("row_digest").alias("last")
    )
    others = marked.where("kept").join(first.where("first < last"), "component_id").where("row_digest > first")
    copies = marked.where("not kept").select("doc_id", "row_digest").unionByName(others.select("doc_id", "row_digest"))
    named = docs.select(*[F.col(c).alias(f"in_{c}") for c in docs.columns])
    same = (F.col("in_doc_id") == F.col("doc_id")) & (F.md5("in_text") == F.col("row_digest"))
    left = named.join(copies.distinct(), same, "left_anti")
    return left.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns]).dropDuplicates(["doc_id", "text"])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in its own or other numbers, names and units."""
    leaks = decontamination.contaminated(docs, read(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark."""
    return secrets.redact(docs, secrets.fit(docs))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every document."""
    rows = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), bpe.vocabulary(bpe.default_path()))
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", redact_secrets),
    ("bpe", encode_texts),
]

# A learned score, a trained field and BPE are beyond SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove_dir(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
