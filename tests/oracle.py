"""Compare registered queries with their SQL in DuckDB, value by value."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def connect(sf_dir: str = TESTDATA):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(v):
    if v is None or v != v:
        return "∅"
    if isinstance(v, float):
        return repr(v + 0.0) if v else "0.0"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return str(v)


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir: str = TESTDATA):
    """None when equal, else a short description of the first difference."""
    df = fn(spark, sf_dir)
    mine = canonical([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = canonical(cursor.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"{name}: columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{name}: {len(mine)} rows != {len(theirs)}"
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{name}: {len(different)}/{len(mine)} rows differ, first {different[0]}" if different else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract

    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:]
    con = connect()
    oracles = contract.oracle_sql()
    for name, fn in contract.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(session, con, name, fn, oracles[name])
                status = problem or "ok"
            else:
                status = f"rows {fn(session, TESTDATA).count()}"
        except Exception as e:  # report and go on
            status = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {status[:1800]}", flush=True)
