"""Runs queries against their SQL in DuckDB: ``python tests/agree.py DIR [PREFIX|NAME ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def views(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in sorted(Path(d).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(v: object) -> object:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


def rows(columns: list[str], found: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(plain(r[i])) for i in order) for r in found)


def compare(spark, con, d: str, query, sql: str) -> str:  # noqa: ANN001
    """'' if rows and columns agree."""
    df = query(spark, d)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} {sorted(rel.columns)}"
    kind = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}
    types = {c: str(t) for c, t in zip(rel.columns, rel.types, strict=True)}
    off = [(c, t, types[c]) for c, t in df.dtypes if t in kind and kind[t] != types[c]]
    a, b = rows(df.columns, got), rows(rel.columns, want)
    if a != b:
        miss, more = [x for x in b if x not in set(a)][:2], [x for x in a if x not in set(b)][:2]
        return f"rows {len(a)} {len(b)}; only in SQL {miss}; only in Spark {more}"
    return f"types {off}" if off else ""


if __name__ == "__main__":
    import __spark_entry__ as e

    from marketlens.session import build_session

    spark = build_session(cpus=8)
    spark.sparkContext.setLogLevel("ERROR")
    d, wanted = sys.argv[1], sys.argv[2:]
    con, sql = views(d), e.oracle_sql()
    bad = 0
    for name, query in e.queries().items():
        if wanted and not any(name == w or name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            said = compare(spark, con, d, query, sql[name]) if name in sql else f"no SQL, {query(spark, d).count()} rows"
        except Exception as x:  # noqa: BLE001
            said = "ERROR " + str(x)[:600]
        bad += bool(said) and not said.startswith("no SQL")
        print(f"{name} {time.time() - t:.1f}s {(said or 'ok')[:1200]}", flush=True)
    print("failures", bad)
