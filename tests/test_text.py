import hashlib
from urllib.parse import quote_plus

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vicinity.functions.text import (
    clean,
    classify_request,
    compose_info,
    default_if_blank,
    fold_description,
    is_keg,
    result_line,
    search_link,
    text_hash,
    to_number,
    to_whole,
    truncate,
)


def apply(spark, fn, *values, types=None):
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate(types or ["string"] * len(values)))
    df = spark.createDataFrame([tuple(values)], schema)
    return df.select(fn(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


def test_clean(spark):
    assert apply(spark, clean, "﻿ \t Name \r\n") == "Name"
    assert apply(spark, clean, None) == ""
    assert apply(spark, clean, "Köstritzer ") == "Köstritzer"


@pytest.mark.parametrize("text,number", [("8%", 8.0), ("8.5%", 8.5), ("$1,234.5", 1234.5), ("", None), ("n/a", None), (None, None)])
def test_decorated_numbers(spark, text, number):
    assert apply(spark, to_number, text) == number


@pytest.mark.parametrize("text,number", [("17", 17), ("17.9", 17), ("-1.9", -1), ("", None), ("x", None)])
def test_whole_numbers(spark, text, number):
    assert apply(spark, to_whole, text) == number


@pytest.mark.parametrize(
    "name,description,expected",
    [
        ("Test 1/6 Barrel", "", True),
        ("Test ⅙ barrel", "", True),
        ("Test ½KEG", "", True),
        ("Test 1 / 2 keg", None, True),
        ("Other", "Kegs are intended for Kegerator use only.", True),
        ("Barrel Aged", "in a keg", False),
        (None, None, False),
    ],
)
def test_small_lots(spark, name, description, expected):
    assert apply(spark, is_keg, name, description) is expected


def test_fold_description(spark):
    got = apply(spark, fold_description, "Good.", "Oak, Plum", "", "Poland")
    assert got == "Good. Tasting notes: Oak, Plum. Brewed in Poland."
    assert apply(spark, fold_description, "", "", "", "") == ""


def compose(spark, name, style, description, **scores):
    values = [name, style, description, *scores.values()]
    types = ["string"] * 3 + ["int"] * len(scores)
    keys = list(scores)
    return apply(
        spark,
        lambda n, s, d, *rest: compose_info(n, s, d, dict(zip(keys, rest)) if keys else None),
        *values,
        types=types,
    )


def test_compose_info(spark):
    assert compose(spark, "Stout Porter", "Porter", "Dark.") == "Stout Porter Style: Porter. Dark."
    assert compose(spark, "Pale", "Ale", "") == "Pale Style: Ale."
    assert compose(spark, "Köstritzer", None, None) == "Köstritzer"
    assert compose(spark, "", None, None) == ""


def test_compose_info_lists_scores_from_forty_in_a_fixed_order(spark):
    got = compose(spark, "IPA", None, None, astringency=50, bitter=40, hoppy=90, malty=39, sweet=None)
    assert got == "IPA Taste: hoppy, bitter, astringent."
    assert "Taste" not in compose(spark, "Lager", None, None, hoppy=0, bitter=39, sweet=None)
    assert compose(spark, "Old", None, None, alcohol=41, body=41, fruits=41) == "Old Taste: fruity, strong, full-bodied."


def test_hash_is_sha256_of_utf8(spark):
    for text in ("", "hello", "Köstritzer 🍺"):
        assert apply(spark, text_hash, text) == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("text,shown", [("short", "short"), ("x" * 60, "x" * 60), ("x" * 61, "x" * 59 + "…"), ("a\nb", "a b"), (None, "")])
def test_truncate(spark, text, shown):
    assert apply(spark, truncate, text) == shown


def test_default_if_blank(spark):
    assert apply(spark, lambda c: default_if_blank(c, "d"), "  ") == "d"
    assert apply(spark, lambda c: default_if_blank(c, "d"), " v ") == "v"
    assert apply(spark, lambda c: default_if_blank(c, "d"), None) == "d"


@given(st.text(st.characters(blacklist_categories=("Cs",), blacklist_characters="\0"), max_size=40))
@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_search_link_is_form_encoded(spark, name):
    assert apply(spark, lambda c: search_link(c, "q="), name) == "q=" + quote_plus(name)


def test_result_line(spark):
    got = apply(spark, result_line, 1, "Pale", "IPA", 0.12345, 42, types=["int", "string", "string", "double", "long"])
    assert got == "  1. Pale  (IPA)  d=0.123  [id=42]"


CASES = [
    ("hoppy lager", ("search", "hoppy lager", None, None), None),
    ("  fruity IPA  ", ("search", "fruity IPA", None, None), None),
    ("Weißbier zitrone", ("search", "Weißbier zitrone", None, None), None),
    ("a" * 4000, ("search", "a" * 4000, None, None), None),
    ("a" * 4001, ("error", None, None, None), "4001"),
    ("", ("error", None, None, None), "prompt or command"),
    ("   ", ("error", None, None, None), "prompt or command"),
    (None, ("error", None, None, None), "prompt or command"),
    (":like 42", ("like", None, 42, None), None),
    (":LIKE 1", ("like", None, 1, None), None),
    (":like", ("error", None, None, None), ":like"),
    (":like abc", ("error", None, None, None), ":like"),
    (":like 1 2", ("error", None, None, None), ":like"),
    (":like -4", ("error", None, None, None), ":like"),
    (":like 1234567890", ("error", None, None, None), ":like"),
    (":top 1", ("top", None, None, 1), None),
    (":top 50", ("top", None, None, 50), None),
    (":top 0", ("error", None, None, None), "between 1 and 50"),
    (":top 51", ("error", None, None, None), "between 1 and 50"),
    (":top -3", ("error", None, None, None), "between 1 and 50"),
    (":top abc", ("error", None, None, None), ":top"),
    (":top", ("error", None, None, None), ":top"),
    (":explain", ("explain", None, None, None), None),
    (":help", ("help", None, None, None), None),
    (":cls", ("clear", None, None, None), None),
    (":clear", ("clear", None, None, None), None),
    (":quit", ("quit", None, None, None), None),
    (":Quit", ("quit", None, None, None), None),
    (":exit", ("quit", None, None, None), None),
    (":q", ("quit", None, None, None), None),
    (":foo", ("error", None, None, None), ":help"),
]


def test_requests(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, line string")
    rows = df.select("i", classify_request("line").alias("r")).orderBy("i").collect()
    for row, (line, expected, message) in zip(rows, CASES):
        got = row.r
        assert (got.kind, got.prompt, got.like_id, got.top) == expected, line
        assert (got.error is None) == (message is None), line
        assert message is None or message in got.error
