"""A training corpus from ``documents``: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftline.llm import fmindex, minhash, mixing, store, tokenstore, toxicity

STAGES = [
    ("toxicity", toxicity.stage),
    ("near_dedup", minhash.stage),
    ("decontamination", fmindex.stage),
    ("mixing", mixing.stage),
    ("tokens", tokenstore.stage),
]

#: The first stage is a fitted model and the last a tokenizer; tests/llm hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns: doc_id, start, n_tokens, ids_crc32 of each document of the mixed corpus."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, path = store.mark(), store.place(spark, name)
        docs = store.settle_at(stage(spark, docs, sf_dir), path)
        store.sweep(spark, before, keep=path)  # what the stage has written on its way
    return docs
