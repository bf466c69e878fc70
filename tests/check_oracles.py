"""Run registered queries against their oracle SQL: ``python tests/check_oracles.py [sf] [name ...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def shape(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr))


def expected(folder, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    cur = con.execute(sql)
    return shape([d[0] for d in cur.description], cur.fetchall())


def compare(spark, folder, run, sql):
    """None if equal, else a short description of the difference."""
    df = run(spark, folder)
    got = shape(df.columns, df.collect())
    if sql is None:
        return None if got[1] else "no rows"
    want = expected(folder, sql)
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        a, b = set(map(repr, got[1])), set(map(repr, want[1]))
        return (f"{len(got[1])} rows, expected {len(want[1])}; extra {sorted(a - b)[:2]}; "
                f"missing {sorted(b - a)[:2]}")
    return None if got[1] else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidemark.session import build_session

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                  "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    runs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in runs.items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            problem = compare(spark, f"/root/testdata/sf{sf}", run, oracles.get(name))
        except Exception as e:  # report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - began:6.2f}s "
              f"{'' if name in oracles else '(rows only) '}{problem or ''}", flush=True)
    print("failed:", bad)
