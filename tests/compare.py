"""Runs registered queries in Spark and, as SQL, in DuckDB, and compares the results."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(rows) -> list[tuple[str, ...]]:
    def text(v) -> str:
        if isinstance(v, float):
            return repr(v + 0.0)
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where both agree on columns and rows, else what differs first."""
    cols = sorted(df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != cols:
        return f"columns {sorted(names)} against {cols}"
    order = [names.index(c) for c in cols]
    theirs = normal([tuple(r[i] for i in order) for r in result.fetchall()])
    ours = normal([tuple(r[c] for c in cols) for r in df.collect()])
    if ours == theirs:
        return None
    only_ours, only_theirs = set(ours) - set(theirs), set(theirs) - set(ours)
    return (
        f"{len(ours)} rows against {len(theirs)}; columns {cols}\n"
        f"  only Spark ({len(only_ours)}): {sorted(only_ours)[:2]}\n"
        f"  only SQL   ({len(only_theirs)}): {sorted(only_theirs)[:2]}"
    )


def main(folder: str, prefixes: list[str]) -> None:
    from tests.conftest import make_session

    import __spark_entry__ as entry

    spark, con = make_session(), connect(folder)
    oracle, bad = entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in oracle:
                found = difference(df, con, oracle[name])
                note = f"rows={con.execute('SELECT count(*) FROM (' + oracle[name] + ')').fetchone()[0]}"
            else:
                found, note = None, f"rows={df.count()} (no SQL)"
        except Exception as e:  # report every query, then go on
            found, note = str(e)[:1500], ""
        print(f"{'OK ' if found is None else 'BAD'} {name} {time.time() - start:.2f}s {note}", flush=True)
        if found:
            bad.append(name)
            print(found, flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
