"""Run every registered query and its SQL side by side and compare schema and rows.

usage: python tools/check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from callops.queries import ORACLES, QUERIES  # noqa: E402
from callops.session import build_session  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    return value


def compare(spark, folder: str, name: str, df=None) -> str:
    start = time.time()
    df = QUERIES[name](spark, folder) if df is None else df
    order = sorted(df.columns)
    got = Counter(tuple(_norm(v) for v in row) for row in df.select(*[f"`{c}`" for c in order]).collect())
    spent = time.time() - start
    if name not in ORACLES:
        return f"{name}: rows only, {sum(got.values())} rows, {spent:.1f}s"
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    db.execute("CREATE TABLE answer AS " + ORACLES[name])
    types = dict(db.execute("SELECT column_name, column_type FROM (DESCRIBE answer)").fetchall())
    if sorted(types) != order:
        return f"{name}: COLUMNS spark-only {set(order) - set(types)} sql-only {set(types) - set(order)}"
    want = Counter(
        tuple(_norm(v) for v in row)
        for row in db.execute("SELECT " + ", ".join(f'"{c}"' for c in order) + " FROM answer").fetchall())
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    kinds = [f"{f.name}:{f.dataType.simpleString()}/{types[f.name]}" for f in df.schema.fields
             if pairs.get(f.dataType.simpleString()) != types[f.name]]
    note = f" TYPES {kinds}" if kinds else ""
    if got == want:
        return f"{name}: ok {sum(got.values())} rows {spent:.1f}s{note}"
    only_spark, only_sql = list((got - want).items())[:2], list((want - got).items())[:2]
    return (f"{name}: DIFFERENT spark {sum(got.values())} sql {sum(want.values())} rows, "
            f"{sum((got - want).values())} differ{note}\n  {order}\n  spark {only_spark}\n  sql   {only_sql}")


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        try:
            print(compare(spark, folder, name), flush=True)
        except Exception as error:  # report and go on with the other queries
            print(f"{name}: FAILED {str(error)[:1500]}", flush=True)


if __name__ == "__main__":
    main()
