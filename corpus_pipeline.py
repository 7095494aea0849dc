"""A corpus pipeline from the operators of ``shelfwise.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.  Null and empty texts, repeated
rows, empty tables and extra columns have the results that the operators'
docstrings define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import langid, mixing, packing, simhash, toxicity
from shelfwise.llm.common import free_name, ship, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept."""
    ship(spark)
    prediction = free_name(docs, "prediction")
    return langid.identify(docs, hold=False).where(~F.col(f"{prediction}.rejected")).select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity under one half."""
    ship(spark)
    score = free_name(docs, "toxicity")
    return toxicity.judge(docs, table(spark, sf_dir, "labels")).where(F.col(score) < 0.5).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return simhash.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document taken twice is there twice, one not taken is not."""
    return mixing.draw(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    ship(spark)
    return packing.pack(docs)


STAGES = [("language_id", language), ("toxicity", toxic), ("simhash_dedup", near_copies),
          ("mixing", mixed), ("packing", packed)]

#: Models, fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
