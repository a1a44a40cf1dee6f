"""The registered queries against DuckDB where SQL exists, and the pipeline against a plain run of its stages."""

import collections
import glob
import os

import duckdb
import pytest

import corpus_pipeline
from aerostage.llm.catalog import queries
from aerostage.llm.oracle import oracle_sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = con.execute(oracle_sql()[name])
    names = [c[0] for c in want.description]
    want = [dict(zip(names, r)) for r in want.fetchall()]
    got = queries()[name](spark, SF)
    cols = sorted(got.columns)
    assert cols == sorted(names)
    rows = sorted(tuple(r) for r in got.select(cols).collect())
    assert rows == sorted(tuple(r[c] for c in cols) for r in want)


def test_pipeline(spark):
    from aerostage.llm import language, mixing, ngram_join, quality_rules
    from aerostage.llm.common import read

    docs = read(spark, SF, "documents")
    kept = {r["doc_id"] for r in quality_rules.quality_rules(docs).where("kept").collect()}
    left = docs.where(docs.doc_id.isin(list(kept)))
    named = {r["doc_id"] for r in language.identify(left).where("lang_pred <> 'und' and score >= 0.3").collect()}
    left = left.where(left.doc_id.isin(list(named)))
    one = {r["doc_id"] for r in ngram_join.jaccard_components(left).where("doc_id = component_id").collect()}
    left = left.where(left.doc_id.isin(list(one)))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(left).collect() if r["copies"]}
    out = corpus_pipeline.run(spark, SF).collect()
    assert collections.Counter(r["doc_id"] for r in out if r["piece"] == 0) == collections.Counter(copies)
    fill = collections.Counter()
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert fill[r["sequence_id"]] == r["offset"]
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 1024
