"""Every registered query with SQL equals it on the smallest tables; the others run."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from linkspan.plans import oracles, queries

SF = "/root/testdata/sf0.001"
HEAVY = {"pair_features", "matcher_oof"}
TIGHT = queries.Limits(max_df=20, rerank_depth=50, keys=10, last_key=30, standin=30, grams=5, rescue=20)
BLOCKING = ["block_score", "block_top_k", "block_quota_top_k", "rerank_exact", "trigram_fallback", "rarest_key_block", "coverage", "three_views", "standin_block", "rescue_channel"]


def canon(df):
    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        return repr(round(float(v), 6)) if isinstance(v, float | np.floating) else str(v)

    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - HEAVY))
def test_query(spark, duck, name):
    got = queries.queries()[name](spark, SF).toPandas()
    sql = oracles.oracle_sql().get(name)
    if sql:
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canon(got) == canon(want)


@pytest.mark.parametrize("name", BLOCKING)
def test_blocking_with_caps_that_bind(spark, duck, name):
    """No token of these tables is above the operators' own caps, so what happens beyond a cap is seen with smaller ones."""
    got = queries.QUERIES[name](queries.View(spark, SF, TIGHT)).toPandas()
    assert len(got) and canon(got) == canon(duck.execute(oracles.oracle_sql(TIGHT)[name]).df())


def test_names_and_addresses_hold_whole_texts(spark, duck):
    rows = queries.View(spark, SF).records.selectExpr("source_row", "business_name || business_address as joined").collect()
    texts = dict(duck.execute("select doc_id, text from documents").fetchall())
    assert {r.source_row for r in rows} == set(texts)
    assert all(texts[r.source_row].lstrip(" \t\n\x0b\f\r").rstrip() == r.joined.lstrip(" \t\n\x0b\f\r").rstrip() for r in rows)


def test_matcher_learns_from_all_features(spark):
    from linkspan.operators import features

    got = queries.queries()["pair_features"](spark, SF)
    assert set(features.feature_names(features.GROUPS)) <= set(got.columns)
