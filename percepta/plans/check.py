"""Compare catalogue queries with their DuckDB twins.

``python -m percepta.plans.check [--sf DIR] [name ...]`` runs each query on
Spark and its SQL on DuckDB over the same parquet files and reports column
names, row counts, and whether the row multisets are equal (exactly, and
within 1e-9 for doubles). Test-time tool: results are collected here on
purpose, at small scale factors.
"""

from __future__ import annotations

import argparse
import json
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_TO_DUCKDB = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "float": "FLOAT",
    "smallint": "SMALLINT",
    "tinyint": "TINYINT",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def _rows(columns: list[str], records: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def _close(a: tuple, b: tuple, tol: float) -> bool:
    for x, y in zip(a, b, strict=True):
        if isinstance(x, float) or isinstance(y, float):
            if x is None or y is None:
                if x is not y:
                    return False
            elif abs(float(x) - float(y)) > tol * max(1.0, abs(float(x))):
                return False
        elif x != y:
            return False
    return True


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    spark_cols = df.columns
    spark_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {
        "query": name,
        "spark_sec": round(t1 - t0, 2),
        "rows": len(spark_rows),
        "columns": sorted(spark_cols),
    }
    if sql is None:
        out["oracle"] = "none"
        return out
    res = con.execute(sql)
    oracle_cols = [d[0] for d in res.description]
    oracle_types = {d[0]: str(d[1]).upper() for d in res.description}
    oracle_rows = res.fetchall()
    spark_types = dict(df.dtypes)
    type_diff = {
        c: (t, oracle_types.get(c))
        for c, t in spark_types.items()
        if SPARK_TO_DUCKDB.get(t, t.upper()) != oracle_types.get(c)
    }
    out["types_match"] = not type_diff
    if type_diff:
        out["type_diff"] = {c: list(v) for c, v in type_diff.items()}
    out["oracle_rows"] = len(oracle_rows)
    out["columns_match"] = sorted(spark_cols) == sorted(oracle_cols)
    if not out["columns_match"]:
        out["oracle_columns"] = sorted(oracle_cols)
        out["match"] = False
        return out
    a = _rows(spark_cols, spark_rows)
    b = _rows(oracle_cols, oracle_rows)
    out["exact"] = a == b
    out["match"] = len(a) == len(b) and all(_close(x, y, 1e-9) for x, y in zip(a, b, strict=False))
    if not out["match"]:
        for x, y in zip(a, b, strict=False):
            if not _close(x, y, 1e-9):
                out["first_diff"] = [repr(x), repr(y)]
                break
    return out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args(argv)

    from percepta.plans.catalog import QUERIES
    from percepta.plans.oracle import ORACLE_SQL
    from percepta.session import build_session

    spark = build_session("local[8]")
    con = duckdb_connection(args.sf)
    names = args.names or list(QUERIES)
    bad = 0
    for name in names:
        try:
            res = compare(spark, con, name, QUERIES[name], ORACLE_SQL.get(name), args.sf)
        except Exception as exc:  # report and go on
            res = {"query": name, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        if "error" in res or res.get("match") is False:
            bad += 1
        print(json.dumps(res), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
