"""Compares queries with their SQL in DuckDB: python -m tests.oracle SF_DIR [NAME...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(x):
    if x is None or isinstance(x, (str, bool, int, bytes)):
        return x
    if isinstance(x, float):
        return None if math.isnan(x) else x
    if isinstance(x, (list, tuple)):
        return tuple(map(_plain, x))
    return float(x) if hasattr(x, "as_tuple") else str(x)


def _key(row):
    return tuple((x is None, str(type(x)), round(x, 6) if isinstance(x, float) else x) if x is not None else (True, "", "") for x in row)


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in at) for r in rows), key=_key)


def difference(got, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """What differs between a DataFrame and the SQL's rows, types of columns included; empty if nothing."""
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    types = {c[0]: str(c[1]) for c in want.description}
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)}, want {sorted(names)}"
    near = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    a, b = rows_of(got.columns, got.collect()), rows_of(names, want.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows, want {len(b)}"
    for x, y in zip(a, b):
        if x != y and not all(p == q or isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-12, abs_tol=1e-12) for p, q in zip(x, y)):
            return f"{str(x)[:300]}, want {str(y)[:300]}"
    kinds = [f"{c} {t} ({types[c]})" for c, t in got.dtypes if near.get(t, t) != types[c]]
    return "" if not kinds else f"kinds only: {kinds}"


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as e
    from quern.session import local_session

    spark = local_session(cores=os.environ.get("CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql, bad = database(sf_dir), e.queries(), e.oracle_sql(), 0
    for name in names or queries:
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            what = difference(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as x:  # noqa: BLE001
            what = "ERROR " + str(x)[:600]
        bad += bool(what) and not what.startswith(("no SQL", "kinds"))
        print(f"{name} {time.time() - began:.1f} s {what or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
