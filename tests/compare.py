"""Run named queries against their DuckDB text and compare the full results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([_cell(r[i]) for i in order]) for r in rows)


def compare(spark, folder: str, name: str, fn, sql: str | None) -> str | None:
    """None if equal, else what differs."""
    df = fn(spark, folder)
    mine = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if mine else "no rows"
    rel = duck(folder).sql(sql)
    theirs = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    a, b = _rows(df.columns, mine), _rows(rel.columns, theirs)
    if a == b:
        if not a:
            return "both empty"
        return None
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"{len(a)} vs {len(b)} rows\n  spark only {only_a}\n  duckdb only {only_b}"


def types(spark, folder, fn, sql):
    """Pairs of column types, to spot a schema difference."""
    rel = duck(folder).sql(sql)
    mine = dict(fn(spark, folder).dtypes)
    return {c: (mine.get(c), str(t)) for c, t in zip(rel.columns, rel.types, strict=True)}


SAME = {
    ("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"),
    ("timestamp_ntz", "TIMESTAMP"), ("boolean", "BOOLEAN"), ("date", "DATE"),
}


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from tests.conftest import session

    folder, wanted = argv[0], argv[1:]
    spark = session(8)
    queries, oracles = e.queries(), e.oracle_sql()
    bad = 0
    for name in queries:
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            out = compare(spark, folder, name, queries[name], oracles.get(name))
            if out is None and name in oracles:
                odd = {c: p for c, p in types(spark, folder, queries[name], oracles[name]).items() if p not in SAME}
                out = f"types {odd}" if odd else None
        except Exception as x:  # noqa: BLE001
            out = f"{type(x).__name__}: {str(x)[:1500]}"
        bad += out is not None
        print(f"{'ok  ' if out is None else 'FAIL'} {name} {time.time() - start:.1f}s {'' if name in oracles else '(rows)'} {out or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
