"""Run a query and its SQL on the same tables and tell how they differ."""

from __future__ import annotations

import collections
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if the rows agree, else a description; columns are matched by name."""
    names = sorted(df.columns)
    got = [tuple(r[n] for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != names:
        return f"columns {names} != {sorted(cols)}"
    at = [cols.index(n) for n in names]
    want = [tuple(r[i] for i in at) for r in cur.fetchall()]
    typed = lambda rows: collections.Counter((tuple((type(v).__name__, v) for v in r)) for r in rows)
    a, b = typed(got), typed(want)
    if a == b:
        return None
    return f"{len(got)} rows, {len(want)} expected\n  only here: {list((a - b).items())[:2]}\n  missing: {list((b - a).items())[:2]}"


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as entry
    from millrace.session import build_session

    spark = build_session("compare", cpus=8)
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            result = difference(df, con, oracles[name]) if name in oracles else f"(no SQL) {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += result is not None and not result.startswith("(no SQL)")
        print(f"{'ok ' if result is None else '-- '}{name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print(f"{bad} of {len(names or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
