"""Driver contract: entry() runs, and a sample of named queries equals its DuckDB oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from rankeval.plans.named import QUERIES
from rankeval.plans.oracle import SQL

SF = "/root/testdata/sf0.001"
SAMPLE = ["term_stats", "qrels_derived", "metrics_bm25", "metrics_float", "sweep_lambda", "best_k1",
          "test_split_eval", "upsert_last_wins", "wilcoxon_exact", "welch_t", "docs_flatten", "qrels_file",
          "append_terms", "append_search", "hits_file", "metrics_file"]


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else float(f"{v:.9e}")
    return v


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert df.columns == ["query_id", "rr", "ap", "p", "recall", "cut"]
    assert len(rows) == 40


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(se.queries()) and set(se.oracle_sql()) <= set(se.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_named_query_matches_oracle(spark, con, name):
    sdf = se.queries()[name](spark, SF)
    rel = con.sql(se.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    s_rows = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=repr)
    d_rows = sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    assert s_rows == d_rows
