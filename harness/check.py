"""Run every query next to its SQL: ``python -m harness.check [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(r[i] for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return a == b and isinstance(a, bool) == isinstance(b, bool)


def compare(spark: SparkSession, con, sf: str, query, sql: str) -> str:
    """Empty when equal, else the first difference."""
    df = query(spark, sf)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for a, b in zip(ours, theirs):
        if not all(map(same, a, b)):
            return f"{a} / {b}"
    return "" if ours else "no rows on either side"


def main() -> None:
    from harness.oracles import ORACLES
    from harness.registry import QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = database(sf), 0
    for name in names:
        started = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, sf, QUERIES[name], ORACLES[name])
                verdict = problem or "equal"
            else:
                problem, verdict = "", f"{QUERIES[name](spark, sf).count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = verdict = f"{type(error).__name__}: {error}"
        bad += bool(problem)
        print(f"{name:24s} {time.time() - started:6.2f}s  {verdict[:400]}", flush=True)
    print(f"{bad} different")


if __name__ == "__main__":
    main()
