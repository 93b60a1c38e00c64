"""A corpus pipeline of five operators: toxicity, near-duplicates, benchmark passages, mixing, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion_ops.llm.common import col, table
from medallion_ops.llm.decontaminate import decontaminate
from medallion_ops.llm.mixing import mixed_documents
from medallion_ops.llm.queries import remainder, tokenizer_path
from medallion_ops.llm.simhash import deduplicate
from medallion_ops.llm.token_files import read_index, write_token_files
from medallion_ops.llm.toxicity import fit_toxicity, score_toxicity
from medallion_ops.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; the others go."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=remainder(5) != 0)
    scored = score_toxicity(docs, model, score_col="__toxicity").where(F.col("__toxicity") < 0.5)
    return scored.select(*[col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 3 bits or fewer: the smallest doc_id."""
    return deduplicate(docs, shingle=3, distance=3)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents", n=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0, 1 or 2 times)."""
    return mixed_documents(docs, weights=(3, 1, 2), budget=1.5, epochs=2)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files; per document its place, length and checksum, read back from them."""
    folder, manifest = write_token_files(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return read_index(folder, manifest)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mixing", mixing),
    ("token_files", token_files),
]
# Learned scores, fingerprints and token files have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
