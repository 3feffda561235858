"""Every registered query against its DuckDB oracle on the smallest scale folder."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from seqcat.plans import table_queries
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
QUERIES = table_queries.QUERIES
SQL = table_queries.ORACLE
# oracle SQL of file-listing queries is pinned to the driver's sf0.01 folder
FILE_KEYS = {"src_video_files", "src_still_files", "file_md5", "file_mtime"}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sequence_id", "frame_count", "sensor_band", "time_of_day", "value", "metadata_quality"]


def test_registry_consistent():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(norm(x) for x in r) for r in df.collect()]
    if name not in SQL:
        assert len(got) > 0
        return
    sql = SQL[name]
    if name in FILE_KEYS:
        sql = sql.replace("/root/testdata/sf0.01", SF_SMALL)
    cur = con.execute(sql)
    ocols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    want = [tuple(norm(r[i]) for i in idx) for r in cur.fetchall()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
