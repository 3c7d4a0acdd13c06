"""The corpus pipeline: documents in, packed sequences out; each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import jaccard_forest, language_id, packing, secret_scan, template_windows
from sievework.llm.common import held, shipped
from sievework.session import stage

#: language predictions that are less sure than this are rejected
LEAST_SURE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no sure language, go; the others' ``lang`` is the predicted one."""
    shipped(spark)
    model = language_id.fit(docs, ~held(docs["doc_id"], 5, 0))
    return language_id.label(docs, model, LEAST_SURE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    shipped(spark)
    return jaccard_forest.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return template_windows.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    shipped(spark)
    return secret_scan.redact(docs, secret_scan.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, placed in sequences."""
    shipped(spark)
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]
#: no stage but the join of windows can be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
