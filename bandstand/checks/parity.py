"""Compare registered queries with their SQL on the same tables: ``python -m bandstand.checks.parity [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from bandstand.checks import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, type(v).__name__ if isinstance(v, str) else "", v if v is not None else 0) for v in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return str(value) if isinstance(value, (bytes, list, dict)) else value


def ordered(columns: list[str], rows) -> list[tuple]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in at) for r in rows), key=_key)


def difference(spark, con, name: str, d: str) -> str | None:
    """None when equal; otherwise what differs."""
    frame = QUERIES[name](spark, d)
    ours = ordered(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in ORACLE:
        return None if ours else "no rows"
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    theirs = ordered(columns, result.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}; first ours {ours[:2]} theirs {theirs[:2]}"
    for a, b in zip(ours, theirs):
        if a != b:
            close = all(
                x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9))
                for x, y in zip(a, b)
            )
            return f"{'inexact' if close else 'value'}: {a} != {b}"
    if not ours:
        return "no rows"
    types = {c: t for c, t in frame.dtypes}
    duck = {c[0]: str(c[1]).lower() for c in result.description}
    same = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean", "date": "date"}
    odd = {c: (types[c], duck[c]) for c in types if same.get(types[c]) != duck[c]}
    return f"types {odd}" if odd else None


def main() -> None:
    from bandstand.runtime import local_session

    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = [n for n in QUERIES if any(p in n for p in sys.argv[2:])] if len(sys.argv) > 2 else list(QUERIES)
    spark, con = local_session(cores="8"), connect(d)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            problem = difference(spark, con, name, d)
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "ok " if problem is None else "BAD"
        bad += problem is not None
        print(f"{kind} {name} {time.time() - begin:.1f}s {'' if name in ORACLE else '(rows only) '}{problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} differ")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
