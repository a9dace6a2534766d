"""Every registered query against its DuckDB oracle at sf0.001 (exact match
after the rounding both sides apply)."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from paneltide.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)   # signed zeros must match too
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    scols = sdf.columns
    srows = sdf.collect()
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    order = sorted(scols)
    a = Counter(tuple(_norm(r[scols.index(c)]) for c in order) for r in srows)
    b = Counter(tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "crime_rate" in df.columns


@pytest.mark.parametrize("name", ["dedup_keep_first", "panel_yearly", "rolling5_complete", "interpolate_gaps",
                                  "group_row_ranges", "cusum_process", "kde_density", "levene_median",
                                  "model_table", "polygon_area"])
def test_partition_invariance(spark, name):
    """Same result with 1 and 16 shuffle partitions (order keys are complete)."""
    fn = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = fn(spark, SF)
            out.append(Counter(tuple(_norm(v) for v in r) for r in df.collect()))
        assert out[0] == out[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
