import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vicinity.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    times = Counter(windows)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_exclamations": text.count("!"),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len({i + d for i, x in enumerate(windows) if times[x] > 1 for d in range(3)}),
    }


EXTRA = [
    (20, "a b c " * 40),
    (21, "x y z x y z"),
    (22, "a a a a"),
    (23, "same line\nsame line\n\n \nsame line\n"),
    (24, "word " * 60 + "!" * 40),
    (25, "*** " * 60),
    (26, " ".join(f"w{i}" for i in range(60))),
    (27, " ".join(f"w{i}" for i in range(60)) + " # $ % & | < >"),
]


def test_odd_rows(spark, odd_docs):
    extra = spark.createDataFrame([(i, t, "", "", 0, "") for i, t in EXTRA], odd_docs.schema)
    docs = odd_docs.union(extra)
    got = sorted(((r.doc_id, *(r[m] for m in quality.MEASURES)) for r in quality.measure(docs).collect()), key=str)
    want = sorted(((d.doc_id, *(brute(d.text)[m] for m in quality.MEASURES)) for d in docs.collect()), key=str)
    assert got == want


def test_empty_table(odd_docs):
    entries = quality.ledger(odd_docs.limit(0))
    assert entries.collect() == [] and quality.ablations(entries, quality.PROSE).collect() == []


@settings(max_examples=20, deadline=None)
@given(texts=st.lists(st.text(alphabet=" \t\nab#!é", max_size=60), min_size=1, max_size=30))
def test_any_texts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.measure(docs).collect():
        assert {m: r[m] for m in quality.MEASURES} == brute(texts[r.doc_id])


def test_policies_and_ablations(spark):
    docs = spark.createDataFrame(EXTRA, "doc_id long, text string")
    entries = quality.ledger(docs)
    kept = {r.doc_id for r in quality.apply(entries, quality.PROSE).filter("kept").collect()}
    assert kept == {26}
    assert {r.doc_id for r in quality.apply(entries, quality.BASE).filter("kept").collect()} == {26, 27}
    rows = {r.rule: r for r in quality.ablations(entries, quality.PROSE).collect()}
    failed = {r.doc_id: r.failed for r in entries.collect()}
    for n, rule in enumerate(quality.RULES):
        if rule in quality.PROSE.rules:
            mask = quality.PROSE.mask & ~(1 << n)
            assert rows[rule].fail == sum(bool(f >> n & 1) for f in failed.values())
            assert rows[rule].fail_alone == sum(f & quality.PROSE.mask == 1 << n for f in failed.values())
            assert rows[rule].kept_without == sum(not f & mask for f in failed.values())
    assert quality.STRICT.mask == (1 << len(quality.RULES)) - 1


def test_keep_good_returns_the_columns(odd_docs, spark):
    good = spark.createDataFrame([(26, EXTRA[6][1], "l", "s", 9, "clash")] * 2, odd_docs.schema)
    out = quality.keep_good(odd_docs.union(good))
    assert out.columns == odd_docs.columns
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, good.collect()))


def test_no_python_and_no_shuffle(spark, sf):
    from vicinity.llm.queries import QUERIES

    plan = QUERIES["op4_quality_ledger"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_query_agrees_with_sql(spark, sf):
    oracle = pytest.importorskip("oracle")
    from vicinity.llm.queries import ORACLES, QUERIES

    con = oracle.connect(sf)
    for name in sorted(ORACLES):
        assert not oracle.compare(spark, con, sf, name, QUERIES[name], ORACLES[name]), name
