"""Run registered queries and their SQL oracles side by side.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, int) and not isinstance(v, bool):
        return repr(v)
    return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in data)


def oracle_connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(df, con, sql) -> str:
    names, got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    other, want = rows([d[0] for d in rel.description], rel.fetchall())
    if names != other:
        return f"columns {sorted(set(names) ^ set(other))}"
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        where = [(n, x, y) for n, x, y in zip(names, *bad[0]) if x != y]
        return f"{len(bad)} rows differ, first in {where}"
    return "" if got else "empty"


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), oracle_connection(sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = []
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            problem = differences(queries[name](spark, sf), con, oracle[name]) if name in oracle else "no oracle"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{time.time() - start:6.2f}s {name} {problem or 'ok'}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
