"""Compare registered queries with their oracle SQL.

    python tests/oracle.py [--sf 0.01] [query ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, [tuple(_plain(v) for v in row) for row in df.select(*names).collect()]


def rows_of_sql(con, text: str) -> tuple[list[str], list[tuple]]:
    found = con.execute(text)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in found.fetchall()]
    return [names[i] for i in order], rows


def difference(df, con, text: str) -> str | None:
    """None when both give the same columns and the same bag of rows, types included."""
    left_names, left = rows_of_spark(df)
    right_names, right = rows_of_sql(con, text)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    key = lambda row: tuple((v is not None, type(v).__name__, str(v)) for v in row)
    for a, b in zip(sorted(left, key=key), sorted(right, key=key)):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"row {str(a)[:600]} != {str(b)[:600]}"
    return None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    args = parser.parse_args()
    from hooklens.plans import catalog
    from hooklens.session import build_session

    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    runs, texts = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for name in args.names or runs:
        start = time.time()
        try:
            df = runs[name](spark, sf_dir)
            if name in texts:
                problem = difference(df, con, texts[name])
                state = "ok" if problem is None else f"DIFFERENT: {problem}"
            else:
                state = f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            state = f"FAILED: {type(error).__name__}: {str(error)[:1500]}"
        bad += state.startswith(("DIFF", "FAIL"))
        print(f"{name:24s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
