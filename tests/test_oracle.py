"""A few registered queries against their SQL in a second engine, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"
NAMES = ["merge_us", "species_for_zone", "er_score", "mdl_key_parse", "zone_score_delta", "parquet_digest", "cell_lonlat", "idw_knn"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    a, b = e.queries()[name](spark, SF).toPandas(), c.sql(e.oracle_sql()[name]).df()
    cols = sorted(a.columns)
    rows = lambda d: sorted(str(tuple(None if x != x or x is None else x for x in r)) for r in d[cols].astype(object).values.tolist())
    assert cols == sorted(b.columns) and rows(a) == rows(b)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize(("name", "cut"), [("bilinear_resample", "s_suppkey"), ("lon_span", "lon"), ("match_taxa_cascade", "o_custkey"), ("sync_plan", "c_custkey"), ("registry_merge", "c_custkey %"), ("assign_mdl_id", "r_regionkey"), ("score_delta", "o_orderkey")])
def test_whole_tables(spark, name, cut):
    out, c = e.queries()[name](spark, SF), duckdb.connect()
    assert not [x for x in out._jdf.queryExecution().analyzed().toString().splitlines() if "Filter" in x and cut in x]
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    want = c.sql(e.oracle_sql()[name])
    assert sorted(map(str, map(tuple, out.select(want.columns).collect()))) == sorted(map(str, want.fetchall()))
