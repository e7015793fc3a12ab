"""Run registered queries beside their SQL in an in-process DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((repr([_plain(row[i]) for i in order]) for row in rows))


def compare(spark, con, sf_dir: str, name: str, plan, sql: str | None) -> str:
    """'' when equal, else what differs."""
    frame = plan(spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    mine, theirs = _sorted(frame.columns, got), _sorted(columns, want)
    if mine == theirs:
        return "" if got else "no rows"
    only_mine = [r for r in mine if r not in set(theirs)]
    only_theirs = [r for r in theirs if r not in set(mine)]
    return (
        f"{len(got)} rows against {len(want)}; {len(only_mine)} differ, "
        f"e.g. {only_mine[:2]} / {only_theirs[:2]}"
    )[:1500]


def main() -> int:
    from pyspark.sql import SparkSession

    from vicinity.plans import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, plan in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, plan, ORACLES.get(name))
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        mark = "rows" if name not in ORACLES else "same"
        print(f"{'BAD ' if problem else mark} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
