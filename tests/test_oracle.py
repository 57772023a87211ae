"""Registered queries against their DuckDB oracle on the smallest tables."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from trendspark.sources.testdata import TABLES, table_path

SF = "/root/testdata/sf0.001"
NAMES = ["dedup_latest", "canonical_rates", "velocity_context", "category_lookup", "trending_rollup",
         "category_momentum", "channel_cumulative", "channel_trend_score", "video_trends",
         "cross_market", "trend_opportunities", "category_rollup_orders", "video_trends_orders",
         "dq_nulls", "dq_uniqueness", "q1_7", "q2_2", "q3_3", "q3_4", "q4_6", "q4_7", "v_channel"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_is_registered_with_an_oracle():
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 70
    assert set(oracles) <= set(qs)
    optional = re.compile(r"op\d+_|pipeline$")  # of the corpus operators, which may be absent
    assert {n for n in set(qs) - set(oracles) if not optional.match(n)} == set()


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    spark_cols, spark_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    duck_cols, duck_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert spark_cols == duck_cols
    assert spark_rows == duck_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["trend_stage", "video_count"] and len(rows) > 0
