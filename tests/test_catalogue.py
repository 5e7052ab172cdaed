"""Every query of the spatial catalogue against its SQL in DuckDB, on whole tables of the smallest scale."""

import os

import duckdb
import pytest

from spotweave import plan_queries, quant_queries, queries, record_queries

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")


def plain(v):
    """Arrays as lists; pandas makes floats of integers beside NULLs, so whole floats are integers again."""
    if hasattr(v, "tolist") and getattr(v, "ndim", 0):
        return [plain(x) for x in v]
    return int(v) if isinstance(v, float) and v.is_integer() else v


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(repr([plain(v) for v in r]) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    assert record_queries and plan_queries and quant_queries
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    want = duck.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


#: Queries that SQL can't express: test_by_brute_force, test_trimming and test_graphs compare each of them with plain Python, row by row.
WITHOUT_SQL = {"adapter_scan_classify", "split_long_reads", "barcode_extract_adapter", "internal_adapter_trim", "trim_adapters", "trim_with_gaps", "tissue_components", "tissue_segments", "transcribed_regions"}


def test_all_other_queries_have_sql():
    assert set(queries.QUERIES) - set(queries.ORACLES) == WITHOUT_SQL
