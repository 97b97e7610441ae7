"""Compare registered queries with their SQL: python tests/check.py [sf] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> str:
    """Empty when both give the same columns and rows, else what differs. No plan may multiply rows."""
    df = query(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "NestedLoop" in plan:
        return "cross or nested-loop join"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows_of(names, rel.fetchall())
    if got == want:
        return "" if got else "no rows"
    more, less = list((got - want).items())[:2], list((want - got).items())[:2]
    counts = f"rows {sum(got.values())} vs {sum(want.values())}"
    return f"{counts}; only Spark {more}; only SQL {less}"


def main() -> int:
    import __spark_entry__ as e
    from brookmart.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    wanted = args[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = e.oracle_sql()
    failed = 0
    for name, q in e.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, q, oracles[name])
            else:
                problem = "" if q(spark, sf_dir).count() else "no rows"
        except Exception as x:
            problem = f"{type(x).__name__}: {str(x)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - t:.1f}s {problem}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
