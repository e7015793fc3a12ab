import datetime as dt
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_cells import clustered

from vicinity.operators.approx import assign_cells
from vicinity.operators.layout import LaidOut, cell_ranges, interleaved, nearest_cells, rank

SCHEMA = "id long, x double, day date, name string, n int"


def sample(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=draw.randrange(1000))
        rows.append((i, draw.random(), day, "p" * draw.randrange(3) + str(draw.randrange(10**6)), draw.randrange(50)))
    return rows


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


@pytest.fixture(scope="module")
def rows():
    return sample(20_000)


@pytest.fixture(scope="module")
def laid_out(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("laid out") / "t")
    return LaidOut.write(spark.createDataFrame(rows, SCHEMA), path, ["x", "day", "n"], rows_per_file=300)


def test_rank_and_order(spark):
    edges = F.array(*map(F.lit, range(0, 510, 2)))
    frame = spark.range(-3, 520).select("id", rank(F.col("id"), edges).alias("r"))
    for i, r in frame.collect():
        assert r == sum(e <= i for e in range(0, 510, 2))
    few = F.array(F.lit(10), F.lit(20), F.lit(30))
    assert [r[0] for r in spark.range(5, 45, 10).select(rank(F.col("id"), few)).collect()] == [0, 64, 128, 192]
    assert spark.range(1).select(rank(F.lit(None).cast("int"), edges)).first()[0] == 0
    assert spark.range(1).select(rank(F.lit(5), F.array().cast("array<int>"))).first()[0] == 0
    key = spark.range(1).select(interleaved([F.lit(0b10000001), F.lit(0b00000011)])).first()[0]
    assert key == 0b1000000000000111


WANTED = [
    {"x": (0.2, 0.3)},
    {"day": (dt.date(2021, 1, 1), dt.date(2021, 2, 1)), "n": [3, (10, 12), (49, None)]},
    {"x": (None, 0.1), "n": (40, None), "name": ("p1", "p5")},
    {"n": 7, "x": (0.5, 0.9), "day": (None, dt.date(2020, 3, 1))},
    {"n": [], "x": (0.0, 1.0)},
    {"n": 1000},
]


def passes(row, wanted):
    def one(v, w):
        if isinstance(w, list):
            return any(one(v, x) for x in w)
        low, high = w if isinstance(w, tuple) else (w, w)
        return v is not None and (low is None or v >= low) and (high is None or v <= high)

    names = dict(zip(("id", "x", "day", "name", "n"), row))
    return all(one(names[c], w) for c, w in wanted.items())


@pytest.mark.parametrize("wanted", WANTED)
def test_filters_find_what_brute_force_finds(laid_out, rows, wanted):
    assert ids(laid_out.rows(wanted)) == [r[0] for r in rows if passes(r, wanted)]


def test_each_column_rules_files_out(laid_out):
    assert ids(laid_out.table()) == list(range(20_000))
    x, n, day = (0.2, 0.25), (3, 5), (dt.date(2021, 1, 1), dt.date(2021, 1, 31))
    for wanted, most in (({"x": x}, 0.5), ({"n": 3}, 0.5), ({"x": x, "n": 3}, 0.25), ({"x": x, "n": n, "day": day}, 0.1)):
        s = laid_out.share(wanted).first()
        assert s["rows"] == 20_000 and 0 < s["rows_read"] <= most * s["rows"], (wanted, s)
        assert s["files"] >= 20_000 / 600


def test_filtered_top_k_reads_few_row_groups(spark, tmp_path):
    """Of a filtered search in cells: at most a tenth of all row groups."""
    base = clustered(24_000, width=8, centres=40, seed=5)
    frame = spark.createDataFrame(base, "id long, embedding array<float>, kind string, price double")
    centres = {}
    for i, v, *_ in base:
        centres.setdefault(i % 40, list(map(float, v)))
    centroids = spark.createDataFrame(sorted(centres.items()), "cell int, centroid array<double>")
    placed = assign_cells(frame, centroids)
    path = str(tmp_path / "t")
    laid_out = LaidOut.write(placed, path, ["cell", "price"], rows_per_file=100)
    prices = sorted(r[3] for r in base)
    low, high = prices[6000], prices[9000]
    query = list(map(float, base[17][1]))
    cells = nearest_cells(centroids, query, 3)
    hits = laid_out.search(query, 5, where={"price": (low, high)}, centroids=centroids, probes=3, columns=["cell"])
    got = [(r["id"], r["cell"]) for r in hits.collect()]
    near = placed.filter(F.col("cell").isin(cells) & F.col("price").between(low, high)).collect()

    def distance(v):
        dot = sum(a * b for a, b in zip(v, query))
        return 1 - dot / (sum(a * a for a in v) ** 0.5 * sum(b * b for b in query) ** 0.5)

    want = sorted((round(distance(r["embedding"]), 9), r["id"], r["cell"]) for r in near)[:5]
    assert got == [(i, c) for _, i, c in want]

    groups = passing = 0
    for file in (tmp_path / "t" / "rows").rglob("*.parquet"):
        about = pq.ParquetFile(file).metadata
        for g in range(about.num_row_groups):
            ranges = {}
            for c in range(about.num_columns):
                column = about.row_group(g).column(c)
                if column.path_in_schema in ("cell", "price"):
                    ranges[column.path_in_schema] = (column.statistics.min, column.statistics.max)
            groups += 1
            passing += ranges["price"][1] >= low and ranges["price"][0] <= high and any(
                ranges["cell"][0] <= c <= ranges["cell"][1] for c in cells
            )
    assert groups >= 100 and 0 < passing <= groups / 10
    share = laid_out.share({"cell": cell_ranges(cells), "price": (low, high)}).first()
    assert share["files_read"] <= share["files"] / 10


def test_one_key_fills_many_files(spark, tmp_path):
    rows = [(i, 0.5, dt.date(2020, 1, 1), "same", 1) for i in range(3000)] + sample(3000, 2)
    laid_out = LaidOut.write(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "t"), ["x", "n"], rows_per_file=200)
    assert laid_out.files.agg(F.max("rows")).first()[0] <= 400
    assert laid_out.rows({"x": 0.5, "n": 1, "name": "same"}).count() == 3000


def test_equal_rows_all_stay(spark, tmp_path):
    rows = [(1, 0.5, None, "same", 1)] * 2000
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    laid_out = LaidOut.write(frame, str(tmp_path / "t"), ["x"], rows_per_file=500)
    assert laid_out.table().count() == 2000 and laid_out.files.count() >= 2


def test_nulls_nan_empty_and_odd_names(spark, tmp_path):
    nan = float("nan")
    rows = [(1, None, None, None), (2, nan, "", Decimal("1.5")), (3, 2.0, "é" * 100, None), (4, -0.0, None, Decimal("-3"))]
    frame = spark.createDataFrame(rows, "id long, `key` double, `a.b ``c` string, tie decimal(10,2)")
    laid_out = LaidOut.write(frame, str(tmp_path / "t"), ["key", "a.b `c", "tie"], rows_per_file=1)
    assert laid_out.table().columns == frame.columns
    assert ids(laid_out.rows({"key": (None, None)})) == [2, 3, 4]
    assert ids(laid_out.rows({"key": (1.0, None)})) == [2, 3]  # NaN is above every number
    assert ids(laid_out.rows({"key": 0.0})) == [4]
    assert ids(laid_out.rows({"a.b `c": "é" * 100})) == [3]
    assert ids(laid_out.rows({"tie": (Decimal("0"), None)})) == [2]
    none = LaidOut.write(frame.filter("false"), str(tmp_path / "none"), ["key"])
    assert none.rows({"key": 1.0}).collect() == [] and none.table().count() == 0
    assert tuple(none.share({"key": 1.0}).first()) == (0, 0, 0, 0)
    more = none.append(frame)
    assert ids(more.table()) == [1, 2, 3, 4] and ids(more.rows({"key": 2.0})) == [3]


def test_append_and_unfinished_batches(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame(rows[:2000], SCHEMA)
    first = LaidOut.write(frame, path, ["x", "n"], rows_per_file=200)
    with pytest.raises(FileExistsError):
        LaidOut.write(frame, path, ["x"])
    # a batch that never finished: rows and files without ``about``
    frame.write.parquet(f"{path}/rows/batch=1")
    assert ids(LaidOut(spark, path).table()) == list(range(2000))
    more = first.append(spark.createDataFrame(rows[2000:3000], SCHEMA), rows_per_file=200)
    assert ids(more.table()) == list(range(3000))
    assert ids(more.rows({"n": 5})) == [r[0] for r in rows[:3000] if r[4] == 5]
    assert ids(first.table()) == list(range(2000))
    with pytest.raises(RuntimeError):
        first.append(frame)


def test_bad_arguments(spark, tmp_path, laid_out):
    frame = spark.createDataFrame(sample(3), SCHEMA)
    for by in ([], ["x", "x"], list("abcdefgh")):
        with pytest.raises(ValueError):
            LaidOut.write(frame, str(tmp_path / "t"), by)
    with pytest.raises(ValueError):
        laid_out.search([1.0], where={"cell": 1}, centroids=frame)


def test_cell_ranges():
    assert cell_ranges([5, 3, 4, 9, 4, 7]) == [(3, 5), (7, 7), (9, 9)] and cell_ranges([]) == []


def test_many_files_are_written_from_a_bounded_number_of_ranges(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id", "id % 50 AS a")
    laid_out = LaidOut.write(rows, str(tmp_path / "t"), ["id", "a"], rows_per_file=10)
    files = laid_out.files.collect()
    parts = {f.file.split("-")[1] for f in files}
    assert len(parts) <= 200 and len(files) >= 300 and max(f.rows for f in files) <= 10
    found = laid_out.rows({"id": (100, 299), "a": 7}).collect()
    assert sorted(r.id for r in found) == [107, 157, 207, 257]
    assert laid_out.table().count() == 3000
