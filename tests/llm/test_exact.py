import hashlib
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vicinity.llm import exact


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def check(docs, rows):
    """Ids repeat in some tests, so the rows that stay are counted per id."""
    groups = defaultdict(list)
    for d, t in docs:
        groups[plain(t)].append((-len(t or ""), d is None, d or 0, d))
    expected = []
    for text, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for i, m in enumerate(members):
            expected.append((m[3], members[0][3], len(members), i == 0, hashlib.sha256(text.encode()).hexdigest()))
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)


def result(spark, docs, **options):
    frame = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, digest string, row int")
    return exact.group_copies(frame, every_digest=True, **options).collect()


def test_odd_rows(spark, odd_docs):
    check([(r.doc_id, r.text) for r in odd_docs.collect()], exact.group_copies(odd_docs, every_digest=True).collect())


@pytest.mark.parametrize("heavy", [1_000, 3])
def test_copies_of_all_sizes(spark, monkeypatch, heavy):
    monkeypatch.setattr(exact, "HEAVY", heavy)
    rng = random.Random(5)
    head = "the same beginning of many texts " * 4
    docs = [(None, None), (None, ""), (3, " \n\v"), (3, " \n\v"), (4, "x"), (None, "x "), (5, "x\r")]
    for i in range(300):  # a third of all rows
        docs.append((1000 + i, rng.choice(["hot text", "hot  text", "hot\ttext "])))
    for i in range(200):  # equal lengths and heads, other ends
        docs.append((2000 + i, head + f"{rng.randrange(150):04d}"))
    for i in range(200):
        docs.append((3000 + i, f"{i:05d}"))
    docs += [(7, "a b"), (7, "a b"), (6, "ab "), (8, "ab "), (9, "a b"), (10, "a b")]
    rng.shuffle(docs)
    check(docs, result(spark, docs))


def test_bits_shared_by_keys_join_no_texts(spark, monkeypatch):
    monkeypatch.setattr(exact, "BITS", 8)
    docs = [(i, f"text {i % 70} " + "x" * (i % 11)) for i in range(200)]
    check(docs, result(spark, docs))


def test_digest_only_where_rows_may_be_equal(spark):
    docs = spark.createDataFrame([(1, "one"), (2, "other"), (3, "oth er")], "doc_id long, text string")
    assert {r.doc_id: r.digest is None for r in exact.group_copies(docs).collect()} == {1: True, 2: False, 3: False}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(0, 3), st.none() | st.text("ab \n ", max_size=4)), max_size=12))
def test_any_texts(spark, docs):
    check(docs, result(spark, docs))


def test_main_path_is_native(spark, odd_docs):
    plan = exact.group_copies(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(odd_docs):
    assert exact.group_copies(odd_docs.limit(0)).collect() == []
