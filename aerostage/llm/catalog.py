"""Registered queries of this package: ``opN_<name>`` for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerostage.llm.chat import op2_chat_quotes
from aerostage.llm.common import ship
from aerostage.llm.fingerprints import op9_fingerprints
from aerostage.llm.language import op5_language_id
from aerostage.llm.mixing import op6_mixing
from aerostage.llm.ngram_join import op4_ngram_join
from aerostage.llm.packing import op3_packing
from aerostage.llm.pii import op13_personal_data
from aerostage.llm.quality_model import op1_quality_model
from aerostage.llm.quality_rules import op10_quality_rules
from aerostage.llm.runs import op11_periodic_runs
from aerostage.llm.sharding import op7_sharding
from aerostage.llm.toxicity import op8_toxicity
from aerostage.llm.variants import op12_spelling_variants

OPERATORS = [op1_quality_model, op2_chat_quotes, op3_packing, op4_ngram_join, op5_language_id, op6_mixing, op7_sharding, op8_toxicity,
             op9_fingerprints, op10_quality_rules, op11_periodic_runs, op12_spelling_variants, op13_personal_data]


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _shipped(q) for q in OPERATORS}
