"""Run registered queries on Spark and their checking texts on DuckDB, and compare.

    python tests/oracle.py <folder> [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (0, "") if math.isnan(v) else (1, repr(v))
    return (1, repr(v))


def compare(df, con, sql: str) -> str:
    """Empty text if both sides agree on columns, types and all values."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    types = {c[0]: str(c[1]) for c in cur.description}
    want = cur.fetchall()
    mine = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if mine != types:
        return f"schema {mine} vs {types}"
    order = sorted(names)
    got = sorted(tuple(_cell(r[n]) for n in order) for r in df.collect())
    ix = [names.index(n) for n in order]
    exp = sorted(tuple(_cell(r[i]) for i in ix) for r in want)
    if len(got) != len(exp):
        return f"rows {len(got)} vs {len(exp)}"
    bad = [(a, b) for a, b in zip(got, exp) if a != b]
    if bad:
        a, b = bad[0]
        diff = [(n, x[1], y[1]) for n, x, y in zip(order, a, b) if x != y]
        return f"{len(bad)} of {len(got)} rows differ, e.g. {diff[:4]} in {[x[1] for x in a][:6]}"
    return "" if got else "no rows on both sides"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from staymill.functions.session import session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g",
                    spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, texts, bad = connect(folder), oracle_sql(), []
    for name, fn in queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in texts:
                result = compare(df, con, texts[name])
            else:
                n = len(df.collect())
                result = "" if n else "no rows"
        except Exception as e:  # noqa: BLE001 - report and go on
            result = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok ' if not result else 'BAD'} {time.time() - start:6.1f}s {'sql ' if name in texts else 'rows'} {name} {result}", flush=True)
        if result:
            bad.append(name)
    print("bad:", bad)


if __name__ == "__main__":
    main()
