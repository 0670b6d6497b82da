"""Compare every query with its SQL twin: ``python tests/check.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from tidemart.session import build_session  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


UNJUDGED = "unjudged: it ran, but there is no SQL to compare with"


def plain(value):
    return value.item() if hasattr(value, "item") else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty when equal, else what differs, or ``UNJUDGED`` for a query without a twin."""
    df = contract.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return UNJUDGED
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for g, w in zip(got, want):
        if repr(g) != repr(w):
            return f"{sorted(names)}\n   got  {g}\n   want {w}"
    return ""


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in sys.argv[2:] or contract.queries():
        start = time.time()
        try:
            diff = compare(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff not in ("", UNJUDGED)
        print(f"{'ok  ' if not diff else 'ran ' if diff == UNJUDGED else 'FAIL'} {name} {time.time() - start:.1f}s {diff}",
              flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
