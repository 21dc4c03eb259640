"""Run queries in Spark and their SQL in DuckDB and compare; usable as a script.

    python tests/check_oracle.py SF_DIR [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    columns = spark_df.columns
    mine = rows_of(columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(names) != sorted(columns):
        return f"columns {sorted(columns)} vs {sorted(names)}"
    theirs = rows_of(names, cur.fetchall())
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ, first {bad[0]}" if bad else None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as contract
    from salescompass.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle, con = contract.queries(), contract.oracle_sql(), connect(sf_dir)
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con, oracle[name]) if name in oracle else f"no sql, {df.count()} rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed; without sql: {sorted(set(queries) - set(oracle))}; without query: {sorted(set(oracle) - set(queries))}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
