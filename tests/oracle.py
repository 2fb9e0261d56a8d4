"""Run registered queries and their SQL side by side and compare the rows.

python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daymark.catalog import REGISTRY  # noqa: E402
from daymark.session import build_session  # noqa: E402

ROOT = os.environ.get("TESTDATA", "/root/testdata")


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float) and math.isnan(value):
        return (1, "")
    if isinstance(value, float) and value == 0:
        value = 0.0
    return (2, str(value))


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted((tuple(_key(r[i]) for i in order) for r in rows)))


SPARK_KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, folder: str, name: str, empty_ok: bool = False) -> str | None:
    """None when equal, otherwise what differs."""
    entry = REGISTRY[name]
    df = entry.run(spark, folder)
    kinds = dict(df.dtypes)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.sql()
    if sql is None:
        return None if rows or empty_ok else "no rows"
    doubles = sorted(c for c, k in kinds.items() if k == "double")
    if doubles != sorted(entry.doubles):
        return f"doubles {doubles} but declared {sorted(entry.doubles)}"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    for column, kind in kinds.items():
        want = SPARK_KIND.get(kind)
        if column in types and want and types[column] != want:
            return f"type of {column}: {kind} against {types[column]}"
    a, b = normal(df.columns, rows), normal(names, expected)
    if a[0] != b[0]:
        return f"columns {a[0]} against {b[0]}"
    if len(a[1]) != len(b[1]):
        return f"{len(a[1])} rows against {len(b[1])}: {a[1][:2]} {b[1][:2]}"
    for x, y in zip(a[1], b[1]):
        if x != y:
            return f"{x}\n   against\n{y}"
    return None if rows or empty_ok else "no rows"


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    args = parser.parse_args()
    folder = f"{ROOT}/sf{args.sf}"
    spark = build_session("oracle", "local[8]", 8, **{"spark.driver.memory": "8g",
                                                      "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    names = args.names or list(REGISTRY)
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:400]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += problem is not None
        mark = "" if REGISTRY[name].oracle else " (rows only)"
        print(f"{name:34s} {time.time() - start:6.2f}s {'ok' + mark if problem is None else problem}",
              flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")


if __name__ == "__main__":
    main()
