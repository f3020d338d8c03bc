"""A corpus pipeline over ``documents``: language, near duplicates, personal data, mixture, packing.

Every stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the columns of
``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import op2_mixing, op3_language, op4_pii, op9_packing, op10_jaccard
from tessera.llm.base import DOC_COLUMNS, stored
from tessera.session import read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter, or words whose own best labels have less
    than half of the probability on average.  A clear mix of languages stays.  A missing
    ``lang`` is filled in."""
    out = op3_language.predict(docs.select(*DOC_COLUMNS), op3_language.train(docs), carry=DOC_COLUMNS)
    kept = out.where((F.col("lang_pred") != op3_language.UNKNOWN) & (F.col("sure") >= op3_language.MIN_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*DOC_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every linked group stays: runs of five words,
    similarity 0.8 or more (``op10_jaccard`` as a query has its own contract)."""
    return op10_jaccard.keep_one(docs.select(*DOC_COLUMNS), width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets."""
    return op4_pii.redact(docs.select(*DOC_COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out to reach their source's share of the words."""
    return op2_mixing.emit(docs.select(*DOC_COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the packed sequences."""
    return op9_packing.pack(docs.select(*DOC_COLUMNS))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("packing", packing)]

#: tokens and packing have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
