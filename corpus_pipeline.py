"""The corpus pipeline: language ID, near-dedup, benchmark decontamination, PII redaction, mixing. Each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbar.llm import decontaminate, language, mixing, neardup, pii
from quillbar.llm.common import Scratch, held_out, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with none that holds half of the letters, go. Learned from the labels of two thirds of the rows."""
    model = language.train(docs.filter(~held_out("doc_id", 3, 1)))
    return language.confident(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return neardup.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes the name of its kind; ``n_chars`` follows the text."""
    redacted = pii.redact(docs, pii.fit(docs))
    length = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if "n_chars" in docs.columns else None
    return redacted.select(*[length if c == "n_chars" else c for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their copies; longer ones are likelier. Null and blank texts have no words, so that they
    neither fill a target nor are drawn for one."""
    return mixing.mix(docs, appetite=mixing.by_length(F.col("size"))).filter("copies > 0")


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
]
# Trained models and edit distances are beyond SQL; tests/llm/test_pipeline.py checks every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
