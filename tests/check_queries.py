"""Run queries beside their SQL and compare schema names, row counts and values.

    python tests/check_queries.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    got_cols = sorted(spark_df.columns)
    got = sorted(map(repr, (tuple(r[c] for c in got_cols) for r in spark_df.collect())))
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = [names.index(c) for c in sorted(names)]
    want = sorted(map(repr, (tuple(r[i] for i in order) for r in cursor.fetchall())))
    if got_cols != sorted(names):
        return f"columns {got_cols} vs {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"values {a[:300]} vs {b[:300]}"
    return None


def main() -> None:
    import __spark_entry__ as contract

    from quillmark.session import local_session

    sf_dir = sys.argv[1]
    queries, sql = contract.queries(), contract.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, con = local_session(), duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(queries[name](spark, sf_dir), con, sql[name]) if name in sql else "no sql"
        except Exception as failure:  # noqa: BLE001
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")


if __name__ == "__main__":
    main()
