"""A training-corpus pipeline over ``documents``: filter, deduplicate, mix, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import langid, mixing, omh, packing, toxicity
from docloom.llm._util import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity reaches the threshold go; null and empty texts are scored like any other."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is undetermined go, as do those without a language of at least a third of the text."""
    return langid.keep_identified(docs, 1 / 3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays; documents without words or without an id all stay."""
    return omh.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: absent, once or twice; those without words go."""
    return mixing.draw(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, a repeated one as often as it occurs, and where they stand."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unidentified),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Learned models and tokenizers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
