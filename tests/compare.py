"""Compare registered queries with their SQL: ``python tests/compare.py [sf] [name …]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return f"{value:.6f}"
    return "NULL" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """(equal, message) for one query."""
    start = time.time()
    df = query(spark, sf_dir)
    got_cols, got = rows_of(df.columns, df.collect())
    spark_time = time.time() - start
    start = time.time()
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want_cols, want = rows_of(columns, result.fetchall())
    note = f"{len(got)} rows, spark {spark_time:.1f}s, duckdb {time.time() - start:.1f}s"
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w]
        return False, f"{note}; {len(want)} expected; first difference: {pairs[:1] or (got[:1], want[:1])}"
    return True, note


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con, sql, bad = connect(sf_dir), E.oracle_sql(), []
    for name, query in E.queries().items():
        if wanted and name not in wanted:
            continue
        if name not in sql:
            print(f"{name:32s} no SQL, {query(spark, sf_dir).count()} rows", flush=True)
            continue
        try:
            ok, note = compare(spark, con, name, query, sql[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:32s} {'ok ' if ok else 'BAD'} {note}", flush=True)
        bad += [] if ok else [name]
    print("all equal" if not bad else f"not equal: {bad}")


if __name__ == "__main__":
    main()
