"""Compare registered queries with their SQL on a data folder: python tests/check.py [sf_dir] [names...]."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    rows = [tuple(str(v) for v in r) for r in frame.itertuples(index=False)]
    return sorted(rows)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    a, b = canonical(spark_frame), canonical(sql_frame)
    if a == b:
        return None
    sa, sb = set(a), set(b)
    only_a, only_b = sorted(sa - sb)[:1], sorted(sb - sa)[:1]
    return f"rows {len(a)} / {len(b)}; only spark {len(sa - sb)} {str(only_a)[:900]}; only sql {len(sb - sa)} {str(only_b)[:900]}"


def main() -> None:
    import __spark_entry__ as e
    from bench import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark, con, bad = session(8), database(sf_dir), 0
    for name in names:
        t = time.time()
        try:
            got = e.queries()[name](spark, sf_dir).toPandas()
        except Exception as x:  # report and go on
            print(f"{name:28s} SPARK ERROR {str(x)[:1500]}")
            bad += 1
            continue
        took = time.time() - t
        sql = e.oracle_sql().get(name)
        if sql is None:
            print(f"{name:28s} {took:6.2f}s rows {len(got)} (no SQL)")
            continue
        t = time.time()
        try:
            want = con.execute(sql).df()
        except Exception as x:
            print(f"{name:28s} SQL ERROR {str(x)[:1500]}")
            bad += 1
            continue
        problem = difference(got, want)
        bad += problem is not None
        print(f"{name:28s} {took:6.2f}s sql {time.time() - t:5.2f}s rows {len(got):6d} {'ok' if problem is None else 'DIFF ' + problem}")
    print("bad:", bad)


if __name__ == "__main__":
    main()
