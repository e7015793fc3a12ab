import csv
import random

import pytest
from pyspark.sql import functions as F

from vicinity.sources.catalog import REQUIRED_COLUMNS, read_catalog
from vicinity.sources.ranges import csv_columns, csv_records


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def field(rng):
    word = "".join(rng.choice("abcé ½,") for _ in range(rng.randrange(1, 15)))
    kind = rng.random()
    if kind < 0.2:
        return "line one\n" * rng.randrange(1, 60) + word
    if kind < 0.4:
        return f'say "{word}" twice ""'
    return word if kind < 0.9 else ""


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_with_line_breaks_over_many_ranges(spark, tmp_path, small_ranges, end):
    rng, want, files = random.Random(8), {}, []
    for f in range(3):
        path = tmp_path / f"{f}.csv"
        rows = [[str(i), *[field(rng) for _ in range(3)]] for i in range(150)]
        with open(path, "w", newline="", encoding="utf-8") as out:
            csv.writer(out, lineterminator=end).writerows(rows)
        want |= {(f, i): tuple(r) for i, r in enumerate(rows)}
        files.append(str(path))
    records = csv_records(spark, files)
    blocks = spark.read.text(files).select("_metadata.file_block_start", "_metadata.file_path").distinct().count()
    assert blocks > 20 and spark.read.text(files).rdd.getNumPartitions() > 10
    got = csv_columns(records, 4).collect()
    assert len(got) == len(want)
    seen = {}
    for r in sorted(got, key=lambda r: (r._path, r.position)):
        f = int(r._path[-5])
        seen[f] = seen.get(f, -1) + 1
        assert tuple(x or "" for x in (r.c0, r.c1, r.c2, r.c3)) == want[f, seen[f]]


def test_same_catalogue_as_in_one_task(spark, tmp_path, small_ranges):
    rng = random.Random(2)
    for f, names in enumerate((list(REQUIRED_COLUMNS), list(reversed(REQUIRED_COLUMNS)))):
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding="utf-8-sig" if f else "utf-8") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(names)
            writer.writerows([[field(rng) or "x" for _ in names] for _ in range(40)])
    one, many = (read_catalog(spark, str(tmp_path), in_ranges=r).orderBy("file_row").drop("file_row").collect() for r in (False, True))
    assert one == many and len(one) == 80
    numbers = read_catalog(spark, str(tmp_path), in_ranges=True).agg(F.count_distinct("file_row")).first()[0]
    assert numbers == 80


def test_lines_are_not_dealt_to_find_where_records_begin(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,t\n1,"a\nb"\n2,c\n')
    found = csv_records(spark, [str(tmp_path / "a.csv")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") <= 1
    assert sorted(r.record for r in found.collect()) == ['1,"a\nb"', "2,c", "n,t"]
