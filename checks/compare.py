"""Compare the registered queries with DuckDB: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

from checks.registry import ORACLES, QUERIES
from skyrisk.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duckdb_views(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def normalised(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, name: str, folder: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = QUERIES[name](spark, folder)
    ours = normalised(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None
    answer = con.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    theirs = normalised(columns, answer.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"{[(n, x, y) for n, x, y in zip(sorted(columns), a, b) if x != y or type(x) is not type(y)]}"
    return None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = duckdb_views(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, con, name, folder)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind:4} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")


if __name__ == "__main__":
    main()
