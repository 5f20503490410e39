"""Run registered queries next to their SQL in DuckDB and compare.

    python tools/check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# DuckDB type -> Spark type with the same meaning
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float",
    "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
    "BOOLEAN": "boolean",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def _same(a: object, b: object) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    spark_types = dict(df.dtypes)
    names = sorted(spark_types)
    rel = con.sql(sql)
    duck_types = {n: TYPES.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    if sorted(duck_types) != names:
        return f"columns {names} != {sorted(duck_types)}"
    if duck_types != spark_types:
        diff = {n: (spark_types[n], duck_types[n]) for n in names if spark_types[n] != duck_types[n]}
        return f"types {diff}"
    ours = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    cols = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(con.sql(f"SELECT {cols} FROM ({sql})").fetchall(), key=_key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"first difference {a} != {b}"
    if not ours:
        return "no rows at all"
    return None


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    from millrace.queries import ORACLES, QUERIES
    from millrace.session import build_session

    spark = build_session("check", "local[8]", 8, spark__driver__memory="8g",
                          spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in args[1:] or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
                kind = "V"
            else:
                rows = len(df.collect())
                problem = None if rows else "no rows at all"
                kind = f"R {rows} rows"
        except Exception as e:  # report and go on with the next query
            problem, kind = f"{type(e).__name__}: {str(e)[:1200]}", "-"
        took = time.time() - start
        print(f"{'ok ' if problem is None else 'BAD'} {name:26s} {kind:14s} {took:6.2f}s"
              + (f"  {problem}" if problem else ""), flush=True)
        bad += problem is not None
    print(f"{bad} bad")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
