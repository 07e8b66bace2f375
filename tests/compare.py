"""Run registered queries next to their SQL twins and compare the rows.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import collections
import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return value


def spark_rows(frame) -> tuple[list[str], collections.Counter]:
    order = sorted(frame.columns)
    rows = frame.select(*[f"`{name}`" for name in order]).collect()
    return order, collections.Counter(tuple(_plain(v) for v in row) for row in rows)


def sql_rows(con, sql: str) -> tuple[list[str], collections.Counter]:
    result = con.sql(sql)
    order = sorted(result.columns)
    picks = [result.columns.index(name) for name in order]
    rows = result.fetchall()
    return order, collections.Counter(tuple(_plain(row[i]) for i in picks) for row in rows)


def difference(ours, theirs) -> str | None:
    """None when equal, else a short description."""
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    extra, lost = ours[1] - theirs[1], theirs[1] - ours[1]
    if not extra and not lost:
        return None
    return (
        f"rows {sum(ours[1].values())} / {sum(theirs[1].values())}; {sum(extra.values())} extra, "
        f"{sum(lost.values())} lost\n   ours   {str(next(iter(extra), None))[:700]}\n   theirs {str(next(iter(lost), None))[:700]}"
    )


def main() -> int:
    import __spark_entry__ as entry
    from pairforge import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    con, failed = connect(sf_dir), 0
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            ours = spark_rows(fn(spark, sf_dir))
            middle = time.time()
            problem = difference(ours, sql_rows(con, oracle[name])) if name in oracle else "no oracle"
            size = sum(ours[1].values())
        except Exception as error:  # report and go on with the next query
            problem, middle, size = f"{type(error).__name__}: {str(error)[:900]}", time.time(), -1
        took = f"{middle - start:6.2f}s {time.time() - middle:6.2f}s"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {took} {size:8d} {name} {problem or ''}", flush=True)
    print(f"{failed} problems")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
