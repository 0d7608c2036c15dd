"""Runs queries in Spark and their oracles in DuckDB and compares the sorted rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else v + 0.0
        return v

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is not None, str(type(x)), x) if x is not None else (False, "", "") for x in r))


def compare(spark: SparkSession, con, sf_dir: str, query, sql: str) -> tuple[int, int, list]:
    """Row counts of both sides and the first differing rows."""
    df = query(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(got), len(want), [("columns", sorted(set(df.columns) ^ set(names)))]
    diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
    if len(got) != len(want):
        left, right = set(got), set(want)
        diff = [("only spark", list(left - right)[:2]), ("only oracle", list(right - left)[:2])]
    return len(got), len(want), diff


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from fixtures.oracles import ORACLES
    from fixtures.queries import QUERIES
    from haulwatch.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        start = time.time()
        try:
            if name not in ORACLES:
                print(f"{name}: no oracle, {QUERIES[name](spark, sf_dir).count()} rows, {time.time()-start:.1f}s", flush=True)
                continue
            got, want, diff = compare(spark, con, sf_dir, QUERIES[name], ORACLES[name])
            print(f"{'ok  ' if not diff and got == want else 'DIFF'} {name}: {got} / {want} rows, {time.time()-start:.1f}s", *diff, flush=True)
        except Exception as e:
            print(f"FAIL {name}: {str(e)[:700]}", flush=True)


if __name__ == "__main__":
    main()
