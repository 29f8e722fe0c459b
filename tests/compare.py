"""Run queries on Spark and their SQL twins in DuckDB and compare the rows.

    python tests/compare.py [sf-dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def normalise(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def families(types, of):
    return {name: of(str(kind).lower()) for name, kind in types}


def spark_family(kind: str) -> str:
    return {"bigint": "int", "int": "int", "double": "float", "string": "text",
            "boolean": "bool"}.get(kind, "time" if kind.startswith("timestamp") else kind)


def duck_family(kind: str) -> str:
    return {"bigint": "int", "integer": "int", "double": "float", "varchar": "text",
            "boolean": "bool"}.get(kind, "time" if kind.startswith("timestamp") else kind)


def check(spark, con, name, function, sql, sf_dir):
    """None when equal, else what differs."""
    df = function(spark, sf_dir)
    got = normalise(df.collect(), df.columns)
    if sql is None:
        return None, len(got)
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = normalise(cur.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got)
    kinds = con.execute(f"DESCRIBE {sql}").fetchall()
    ours, theirs = (
        families(df.dtypes, spark_family), families([k[:2] for k in kinds], duck_family)
    )
    if ours != theirs:
        diff = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]}
        return f"types {diff}", len(got)
    if got != want:
        bad = next(((a, b) for a, b in zip(got, want) if a != b), None)
        return f"{len(got)} rows vs {len(want)}; first difference {bad}", len(got)
    return None, len(got)


def main(argv):
    from __spark_entry__ import oracle_sql, queries

    from tracewell.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
        "spark.log.level": "ERROR",
    })
    con, sqls, failed = duck(sf_dir), oracle_sql(), 0
    for name, function in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        begin = time.time()
        try:
            problem, n = check(spark, con, name, function, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001 - reported per query
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        failed += problem is not None
        state = "ok" if problem is None else "FAIL"
        note = "" if name in sqls else " (rows only)"
        print(f"{state:4} {name:28} {n:7} rows {time.time() - begin:6.2f}s{note} {problem or ''}",
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
