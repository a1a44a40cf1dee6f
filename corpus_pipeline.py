"""A training corpus from ``documents``: quality rules, language ID, near duplicates, mixing, packing.

Every stage takes what the one before kept and is written as Parquet in the shared folder. The first three
return the rows they keep, the fourth repeats or drops rows to mix the sources, the last returns placed
token pieces. SQL can't express tokenisation or the packing order, so ORACLE_SQL is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerostage.llm.common import read, saved, ship
from aerostage.llm.language import keep_identified
from aerostage.llm.mixing import mixed_documents
from aerostage.llm.near_duplicates import keep_one_of_each
from aerostage.llm.packing import digests
from aerostage.llm.quality_rules import keep_documents

#: A language that contains a smaller share of a text's grams is taken as no language at all.
LEAST_LANGUAGE_SCORE = 0.3


def _quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return keep_documents(docs)


def _language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return keep_identified(docs, LEAST_LANGUAGE_SCORE)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return keep_one_of_each(docs)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return digests(docs)


STAGES = [
    ("quality_rules", _quality_rules),
    ("language_id", _language_id),
    ("near_duplicates", _near_duplicates),
    ("mixing", _mixing),
    ("packing", _packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
