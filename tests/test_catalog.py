import csv

import pytest
from pyspark.sql import functions as F

from vicinity.operators.changes import (
    append_text,
    assign_ids,
    delete_rows,
    first_wins,
    insert_rows,
    upsert,
    write_back,
)
from vicinity.operators.checks import fingerprint
from vicinity.operators.fresh import is_stale, refresh
from vicinity.operators.meta import merge_meta, prefixed, resolve_alias, update_meta
from vicinity.operators.numbering import number_rows, with_batches
from vicinity.plans import ingest
from vicinity.sources.catalog import (
    NATURAL_KEY,
    REQUIRED_COLUMNS,
    CatalogError,
    clean_catalog,
    empty_catalog,
    is_usable,
    load_catalog,
    read_catalog,
)


def item(**changes):
    row = {
        "Name": "Test Ale",
        "Country": "Poland",
        "Brand": "Test Works",
        "Categories": "ALE, IPA",
        "Tasting Notes": "Citrus, Pine",
        "ABV": "6%",
        "IBU": "45",
        "Food Pairing": "Cheese",
        "Rating": "4.2",
        "Rate Count": "100",
        "Description": "Bitter",
    }
    return row | changes


@pytest.fixture
def write(tmp_path):
    def to_file(rows, name="in.csv", encoding="utf-8", columns=REQUIRED_COLUMNS):
        path = tmp_path / name
        with path.open("w", newline="", encoding=encoding) as out:
            writer = csv.DictWriter(out, fieldnames=list(columns), extrasaction="ignore")
            writer.writeheader()
            writer.writerows(rows)
        return str(path)

    return to_file


def test_missing_file_pointer_file_and_empty_file_are_refused(spark, tmp_path):
    with pytest.raises(CatalogError, match="not found"):
        read_catalog(spark, str(tmp_path / "nothing.csv"))
    pointer = tmp_path / "pointer.csv"
    pointer.write_text("version https://git-lfs.github.com/spec/v1\noid sha256:1\n")
    with pytest.raises(CatalogError, match="Git-LFS"):
        read_catalog(spark, str(pointer))
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    with pytest.raises(CatalogError, match="empty"):
        read_catalog(spark, str(empty))


def test_missing_columns_are_named(spark, write):
    path = write([item()], columns=[c for c in REQUIRED_COLUMNS if c not in ("ABV", "Description")])
    with pytest.raises(CatalogError, match=r"\['ABV', 'Description'\]"):
        read_catalog(spark, path)


def test_byte_order_mark_blank_header_and_odd_spacing(spark, tmp_path):
    path = tmp_path / "odd.csv"
    header = "," + ",".join(f" {c} " for c in REQUIRED_COLUMNS)
    body = '0,Köstritzer , DE ,Brew,"LAGER, Black",,4.8%,,,4.5,17,"Two\nlines with ""quotes"""'
    path.write_text(header + "\n" + body + "\n", encoding="utf-8-sig")
    row = read_catalog(spark, str(path)).first()
    assert row["Name"] == "Köstritzer" and row["Country"] == "DE" and row["Categories"] == "LAGER, Black"
    assert row["Description"] == 'Two\nlines with "quotes"' and row["IBU"] == ""


def test_a_byte_order_mark_before_a_required_header(spark, write):
    assert read_catalog(spark, write([item()], encoding="utf-8-sig")).count() == 1


def test_unusable_rows(spark, write):
    rows = [
        item(),
        item(Name="Test 1/6 Barrel"),
        item(Name="Test ⅙ Barrel"),
        item(Name="Big", Description="Kegs are intended for Kegerator use only."),
        item(Name=""),
    ]
    usable = read_catalog(spark, write(rows)).filter(is_usable())
    assert [r["Name"] for r in usable.collect()] == ["Test Ale"]


def test_first_row_in_file_order_wins_across_files(spark, write, tmp_path):
    (tmp_path / "many").mkdir()
    write([item(Name=f"N{i % 7}", Description=f"first {i}") for i in range(40)], "many/a.csv")
    write([item(Name=f"N{i % 9}", Description=f"second {i}") for i in range(400)], "many/b.csv")
    rows = read_catalog(spark, str(tmp_path / "many"))
    assert rows.select("file_row").distinct().count() == 440
    kept = {r.beer_name: r.info for r in clean_catalog(rows).collect()}
    assert len(kept) == 9
    for i in range(7):
        assert f"first {i} " in kept[f"N{i}"]
    assert "second 7 " in kept["N7"] and "second 8 " in kept["N8"]


def test_every_file_is_read_by_its_own_header(spark, write, tmp_path):
    (tmp_path / "mixed").mkdir()
    write([item(Name="A", Description="a")], "mixed/a.csv")
    write([item(Name="B", Description="b")], "mixed/b.csv", "utf-8-sig", list(reversed(REQUIRED_COLUMNS)))
    spaced = [f" {c} " for c in sorted(REQUIRED_COLUMNS)] + ["Type"]
    write([{f" {k} ": v for k, v in item(Name="C", Description="c").items()} | {"Type": "t"}], "mixed/c c.csv", columns=spaced)
    rows = {r.Name: r for r in read_catalog(spark, str(tmp_path / "mixed")).collect()}
    assert {n: (r.Description, r.Country, r.Type) for n, r in rows.items()} == {
        "A": ("a", "Poland", ""), "B": ("b", "Poland", ""), "C": ("c", "Poland", "t"),
    }
    assert rows["A"].file_row < rows["B"].file_row < rows["C"].file_row


@pytest.mark.parametrize("last", ["pointer", "empty", "short"])
def test_the_last_file_is_checked_too(spark, write, tmp_path, last):
    (tmp_path / "bad").mkdir()
    write([item()], "bad/a.csv")
    write([item()], "bad/b.csv")
    if last == "short":
        write([item()], "bad/z.csv", columns=[c for c in REQUIRED_COLUMNS if c != "ABV"])
    else:
        head = "version https://git-lfs.github.com/spec/v1" if last == "pointer" else ""
        (tmp_path / "bad" / "z.csv").write_text(head)
    with pytest.raises(CatalogError, match={"pointer": "z.csv is a Git", "empty": "z.csv is empty", "short": "z.csv: missing"}[last]):
        read_catalog(spark, str(tmp_path / "bad"))


def test_columns_are_mapped(spark, write):
    row = clean_catalog(read_catalog(spark, write([item(ABV="8.5%", Brand="", IBU="", Rating="4.75")]))).first()
    assert float(row.abv) == 8.5 and row.brewery is None and row.min_ibu is None
    assert float(row.review_overall) == 4.75 and row.number_of_reviews == 100 and row.hoppy is None
    assert row.info == (
        "Test Ale Style: ALE, IPA. Bitter Tasting notes: Citrus, Pine. Pairs well with: Cheese. Brewed in Poland."
    )


def now():
    return F.lit("2024-01-01").cast("timestamp")


def later():
    return F.lit("2024-02-01").cast("timestamp")



def test_loading_twice_adds_nothing_and_keeps_ids_and_hashes(spark, write):
    rows = [item(Name=n) for n in "ABC"] + [item(Name="A", Description="copy"), item(Name="No brand", Brand="", Categories="")]
    path = write(rows + [item(Name="")])
    first, report = load_catalog(spark, path, empty_catalog(spark), now())
    assert report.first().asDict() == {"read": 6, "skipped": 1, "duplicates": 1, "total": 4, "inserted": 4, "updated": 0}
    assert sorted(r.id for r in first.collect()) == [1, 2, 3, 4]
    first = first.drop("change")
    second, report = load_catalog(spark, path, first, later())
    assert report.first().asDict() == {"read": 6, "skipped": 1, "duplicates": 1, "total": 4, "inserted": 0, "updated": 4}
    columns = ["id", *NATURAL_KEY, "text_hash", "updated_at"]
    assert fingerprint(first, columns).first() == fingerprint(second, columns).first()


def test_changed_text_moves_the_time_and_clears_the_vector(spark, write):
    first, _ = load_catalog(spark, write([item(Name=n) for n in "AB"]), empty_catalog(spark), now())
    embedded = refresh(first.drop("change"), now())
    assert embedded.filter(is_stale()).count() == 0
    again = [item(Name="A", Description="New words"), item(Name="B", ABV="9%"), item(Name="C")]
    second, _ = load_catalog(spark, write(again, "again.csv"), embedded, later())
    got = {r.beer_name: r for r in second.collect()}
    assert got["A"].embedding is None and got["A"].updated_at.month == 2 and got["A"].change == "update"
    assert got["B"].embedding is not None and got["B"].updated_at.month == 1 and float(got["B"].abv) == 9.0
    assert got["C"].id == 3 and got["C"].change == "insert"
    assert {r.beer_name for r in second.filter(is_stale()).collect()} == {"A", "C"}


def test_rows_missing_from_the_source_stay(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, k string, info string")
    source = spark.createDataFrame([("b", "z", 5)], "k string, info string, file_row long")
    got = upsert(target, source, ["k"], now(), "file_row", change_col="c")
    assert {(r.id, r.k, r["info"], r.c) for r in got.collect()} == {(1, "a", "x", "keep"), (2, "b", "z", "update")}


def test_first_wins_without_order_values(spark):
    rows = [("a", None, 1), ("a", None, 2), ("b", 5, 3), ("b", None, 4), ("c", None, 5), (None, 2, 6), (None, 1, 7)]
    df = spark.createDataFrame(rows, "k string, row long, v int")
    first = {r.k: r.v for r in first_wins(df, ["k"], "row").collect()}
    last = {r.k: r.v for r in first_wins(df, ["k"], "row", last=True).collect()}
    assert first.pop("a") in (1, 2) and last.pop("a") in (1, 2)
    assert first == {"b": 3, "c": 5, None: 7} and last == {"b": 3, "c": 5, None: 6}


def test_first_wins_with_a_hot_key_and_null_keys(spark):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i}", i * 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "row long, k string, v long").repartition(11)
    got = {r.k: r for r in first_wins(df, ["k"], "row", copies="n").collect()}
    assert len(got) == 1002
    assert (got["hot"].row, got["hot"].v, got["hot"].n) == (0, 0, 1000)
    assert (got[None].row, got[None].n) == (1, 1000) and got["k2"].n == 1


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_row_numbers_are_dense_and_in_order(spark, ranges):
    values = [(7 * i * i) % 100_003 for i in range(500)] + [10**12, -5]
    df = spark.createDataFrame([(v,) for v in set(values)], "v long").repartition(6)
    got = [(r.v, r.row_no) for r in number_rows(df, "v", ranges=ranges).orderBy("v").collect()]
    assert got == [(v, i + 1) for i, v in enumerate(sorted(set(values)))]


def test_row_numbers_of_nothing_and_of_one(spark):
    assert number_rows(spark.createDataFrame([], "v long"), "v").count() == 0
    assert number_rows(spark.createDataFrame([(4,)], "v long"), "v").first().row_no == 1


def test_batches_are_full_but_the_last(spark):
    df = spark.range(150).selectExpr("id * 3 AS id")
    sizes = with_batches(df, "id", 64).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [(r[0], r[1]) for r in sizes] == [(0, 64), (1, 64), (2, 22)]


def test_ids_go_on_above_the_highest(spark):
    new = spark.createDataFrame([("x", 20), ("y", 10)], "n string, file_row long")
    existing = spark.createDataFrame([(41,), (7,)], "id long")
    assert {r.n: r.id for r in assign_ids(new, existing, "file_row").collect()} == {"y": 42, "x": 43}
    assert {r.n: r.id for r in assign_ids(new, existing.limit(0), "file_row").collect()} == {"y": 1, "x": 2}


def test_update_delete_insert(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 3)], "id long, info string, n int")
    assert [r.info for r in append_text(df, F.col("id") == 2, "!").orderBy("id").collect()] == ["a", "b!"]
    assert [r.id for r in delete_rows(df, F.col("n") > 2).collect()] == [1]
    new = spark.createDataFrame([("c", 1)], "info string, file_row long")
    assert [(r.id, r.info, r.n) for r in insert_rows(df, new, "file_row").orderBy("id").collect()][-1] == (3, "c", None)


def test_write_back_keeps_what_has_no_new_vector(spark):
    df = spark.createDataFrame(
        [(1, "t", "old", [1.0], None), (2, "u", "old", [2.0], None)],
        "id long, info string, text_hash string, embedding array<float>, embedded_at timestamp",
    )
    new = spark.createDataFrame([(2, [9.0])], "id long, embedding array<float>")
    one, two = write_back(df, new, now()).orderBy("id").collect()
    assert one.embedding == [1.0] and one.text_hash == "old" and one.embedded_at is None
    assert two.embedding == [9.0] and len(two.text_hash) == 64 and two.embedded_at is not None


def test_last_value_per_key_wins(spark):
    entries = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 0)], "key string, value string, turn int")
    assert {r.key: r.value for r in merge_meta(entries, ["turn"]).collect()} == {"a": "2", "b": "3"}
    info = spark.createDataFrame([("model", "m")], "setting string, value string")
    merged = update_meta(entries.filter("key = 'b'"), prefixed(info))
    assert {r.key: r.value for r in merged.collect()} == {"b": "3", "embedding_model": "m"}


@pytest.mark.parametrize("small_rows", [100, 0])
def test_aliases(spark, small_rows):
    names = spark.createDataFrame([("Žatec Brewery",), ("Other",), (None,)], "n string")
    aliases = spark.createDataFrame([("Žatec Brewery", "Žatec")], "Brewery string, matches string")
    got = resolve_alias(names, F.col("n"), aliases, "Brewery", "matches", "r", small_rows)
    assert {(r.n, r.r) for r in got.collect()} == {("Žatec Brewery", "Žatec"), ("Other", "Other"), (None, None)}


def test_files_are_as_many_as_the_input_has_pieces(spark, tmp_path, monkeypatch):
    rows = spark.range(2000).selectExpr("id AS `No`", "concat('text ', id) AS t")
    rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(ingest, "FILE_BYTES", 1000)
    ingest._write_csv(stored, str(tmp_path / "csv"), "No")
    assert len(list((tmp_path / "csv").glob("*.csv"))) > 2 * spark.sparkContext.defaultParallelism
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2000
