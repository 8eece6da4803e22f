"""Run registered queries beside their SQL twins and compare all values.

Usage: python tests/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(rows: list, names: list[str]) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v))
        return str(v)

    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str:
    df = queries()[name](spark, sf_dir)
    mine = canonical([tuple(r) for r in df.collect()], df.columns)
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows only ({len(mine)})"
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = canonical(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"MISMATCH columns {sorted(df.columns)} vs {sorted(names)}"
    if len(mine) != len(theirs):
        return f"MISMATCH rows {len(mine)} vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"MISMATCH values {len(bad)}: {bad[0]}" if bad else f"match ({len(mine)})"


if __name__ == "__main__":
    from seriesmill.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(master="local[8]", partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    db = tables(sf)
    for query in sys.argv[2:] or list(queries()):
        start = time.time()
        try:
            outcome = compare(session, db, query, sf)
        except Exception as error:  # noqa: BLE001
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{query:24s} {time.time() - start:6.1f}s  {outcome}", flush=True)
