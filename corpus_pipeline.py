"""The corpus pipeline: five stages over documents, each one of the operators in ``fieldstat.llm``.

A stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame; all but the last return the columns of ``docs``. Every
stage's result is written as Parquet to the shared folder and read again.

Rows with a null id or text go through every stage: they are toxic, duplicate
or contaminated only as far as the operators' docstrings define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstat.llm import decontam, line_dedup, mixing, near_dup, toxicity
from fieldstat.llm.tables import read, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays under the threshold; learnt from the labelled ones among ``docs``."""
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model, out="_toxicity")
    return scored.where(F.col("_toxicity") < toxicity.THRESHOLD).select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.one_of_each(docs).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a row for each copy of a document, numbered in ``copy``."""
    return mixing.mixed_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_shared_lines), ("near_duplicates", one_of_each),
          ("decontamination", drop_leaks), ("source_mix", mix_sources)]

# Learnt scores, signatures and Newton steps are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
