"""Importing this module registers the queries of every operator of the package, and the pipeline."""

import corpus_pipeline
from lakemodels.llm import (
    bpe,
    decontamination,
    html_text,
    licenses,
    minhash,
    negatives,
    passages,
    pii,
    preferences,
    runs,
    secrets,
    simhash,
    toxicity,
)
from lakemodels.llm.plans import PLANS, SQL

PLANS["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = [
    "PLANS",
    "SQL",
    "bpe",
    "decontamination",
    "html_text",
    "licenses",
    "minhash",
    "negatives",
    "passages",
    "pii",
    "preferences",
    "runs",
    "secrets",
    "simhash",
    "toxicity",
]
