"""Run registered queries against their SQL: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql):
    """None if both give the same columns and rows, else what differs."""
    got_rows = [tuple(r) for r in spark_df.collect()]
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(spark_df.columns) != sorted(want_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(want_columns)}"
    got, want = rows_of(spark_df.columns, got_rows), rows_of(want_columns, want_rows)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; " + str(
            (sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]))
    if got != want:
        return next(f"{g} != {w}" for g, w in zip(got, want) if g != w)
    return None


def main():
    import __spark_entry__ as entry
    from colophon.session import get_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    wanted = sys.argv[2:]
    spark = get_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                diff = difference(df, con, sqls[name])
            else:
                diff = None if df.count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            diff = f"{type(error).__name__}: {str(error)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.1f}s "
              f"{'' if name in sqls else '(no sql) '}{diff or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
