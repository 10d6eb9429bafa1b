"""Run registered queries beside their SQL: ``python tests/check_queries.py [sf] [names...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value) -> str:
    if value is None or (isinstance(value, float) and value != value) or value is pd.NA:
        return "null"
    if isinstance(value, (bool,)) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, float) or type(value).__name__.startswith("float"):
        return repr(float(value)) if float(value) != int(value) else str(int(value))
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(normal(v) for v in row) for row in frame.itertuples(index=False))


def compare(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    ours, theirs = rows_of(spark_frame), rows_of(sql_frame)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return "ok"


def main() -> int:
    import __spark_entry__ as entry
    from wayfare.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        **{
            "spark__master": "local[8]",
            "spark__sql__shuffle__partitions": "8",
            "spark__ui__enabled": "false",
            "spark__ui__showConsoleProgress": "false",
            "spark__driver__memory": "8g",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, build in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            frame = build(spark, sf_dir).toPandas()
            spent = time.time() - start
            if name in oracles:
                outcome = compare(frame, con.execute(oracles[name]).df())
            else:
                outcome = "rows only"
        except Exception as error:  # report and go on with the next query
            outcome, frame, spent = f"ERROR {str(error)[:700]}", [], time.time() - start
        failed += outcome not in ("ok", "rows only")
        print(f"{name:45s} {len(frame):8d} {spent:6.2f}s {outcome}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
