"""The training-data pipeline: toxic documents go, one of each group of near-duplicates stays,
documents that hold benchmark items go, secrets are masked, and the sources are mixed.

Each stage takes (spark, docs, sf_dir), works on every row of its predecessor and returns the
columns of `documents`; the last returns one row per document with the words that the mixture
takes of it. Between stages the rows are written as Parquet and read again.

Defined results: a null or empty text is judged for toxicity as one without evidence, is neither a
near-duplicate nor a leak, and takes no words; of equal rows and rows with equal texts one stays; very long texts are worked on whole; extra
columns, whatever their names, are kept up to the mixture; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from liftlens.llm import decontaminate, mixing, near_dedup, secrets, toxicity
from liftlens.llm.common import table
from liftlens.operators.scale import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.words_taken(mixing.mix(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
