"""Replay the driver contract the way an outside harness would: a plain
default SparkSession (no settings from this package; only the web UI is
kept off), run from another
working directory, ``entry()`` smoke check, then every ``queries()`` result
against its ``oracle_sql()`` in DuckDB (exact value match, column names
sorted).

usage: cd /tmp && python /root/repo/tools/driver_check.py [sf_dir] [--tz ZONE]
"""

from __future__ import annotations

import datetime as dt
import importlib.util
import os
import sys
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else repr(v)


def main() -> None:
    args = sys.argv[1:]
    sf = next((a for a in args if a.startswith("/")), "/root/testdata/sf0.01")
    tz = args[args.index("--tz") + 1] if "--tz" in args else None
    b = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false"))       # no web UI server
    if tz:
        b = b.config("spark.sql.session.timeZone", tz)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spec = importlib.util.spec_from_file_location("__spark_entry__", os.path.join(REPO, "__spark_entry__.py"))
    E = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(E)
    smoke = E.entry(spark)
    print("entry:", smoke.count(), "rows;", smoke.schema.simpleString()[:120], flush=True)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        df = fn(spark, sf)
        cols = sorted(df.columns)
        a = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
        rel = con.execute(sqls[name])
        dc = [d[0] for d in rel.description]
        b_ = Counter(tuple(norm(r[dc.index(c)]) for c in cols) for r in rel.fetchall()) \
            if sorted(dc) == cols else None
        if a != b_:
            bad.append(name)
    print(f"queries: {len(qs)}, oracle entries: {len(sqls)}, mismatches: {bad}")


if __name__ == "__main__":
    main()
