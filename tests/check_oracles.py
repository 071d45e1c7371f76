"""Compare every registered query with its SQL: python tests/check_oracles.py [sf] [names]."""

import glob
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry
from gridloom.session import build_session


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    return "nan" if isinstance(value, float) and value != value else value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(_cell(row[k]) for k in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> tuple[int, list[str]]:
    """Rows of the query, and how it differs from its SQL."""
    frame = entry.queries()[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return sum(got.values()), []
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    want = rows_of(names, found.fetchall())
    problems = []
    if sorted(names) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} but SQL {sorted(names)}")
    kinds = {c[0]: str(c[1]).lower() for c in found.description}
    same = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean"}
    for column, kind in frame.dtypes:
        if same.get(kind, kind) != kinds.get(column):
            problems.append(f"{column} is {kind} but SQL {kinds.get(column)}")
    if got != want:
        problems.append(f"{sum(got.values())} rows, SQL {sum(want.values())}")
        problems.append(f"only here {list((got - want).items())[:3]}")
        problems.append(f"only SQL {list((want - got).items())[:3]}")
    return sum(got.values()), problems


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(entry.queries())
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con, bad = database(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            count, problems = compare(spark, con, sf_dir, name)
        except Exception as exc:
            count, problems = 0, [f"{type(exc).__name__}: {str(exc)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '} {name} {count} rows {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")


if __name__ == "__main__":
    main()
