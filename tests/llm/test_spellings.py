import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vicinity.llm import spellings
from vicinity.llm.queries import QUERIES


def brute_words(docs, divisor=31):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % divisor == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, factor=10):
    around = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, found in around.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= factor * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(around[w]), form[w], words.get(form[w]), root))
    return sorted(out)


def result(spark, words, factor=10):
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = spellings.variants(frame, factor).collect()
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows)


def test_words_near_each_other(spark):
    rng = random.Random(3)
    words = {}
    for base in ("booookkeeper", "aaaaaaaa", "abababab", "straßenüber", "zzzzzzzy"):
        words[base] = rng.choice([1, 10, 100, 1000])
        for _ in range(60):
            w = list(base)
            for _ in range(rng.choice([1, 1, 2])):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "z", "ÿ"])
            words["".join(w)] = rng.choice([1, 2, 9, 10, 11, 100, 1000])
    words |= {"k" * n: 10**i for i, n in enumerate(range(7, 25))}  # a long chain of forms
    assert result(spark, words) == brute(words)


@pytest.mark.parametrize("plain", [4, 9, 128])
def test_long_words(spark, monkeypatch, plain):
    monkeypatch.setattr(spellings, "PLAIN", plain)
    rng = random.Random(4)
    words = {"ab" * 100: 5, "ab" * 100 + "c": 70, "ab" * 60 + "x" + "ab" * 40: 3, "z" * 128: 1, "z" * 127: 20, "z" * 129: 400}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randrange(3, 12))): rng.randrange(1, 100) for _ in range(120)}
    assert result(spark, words) == brute(words)


def test_a_run_of_very_many_letters(spark):
    words = {"q" * 20_000: 1, "q" * 19_999: 10, "q" * 10_000 + "r" + "q" * 9_999: 1}
    got = result(spark, words)
    assert [(len(r[0]), r[2], r[3] and len(r[3]), len(r[5])) for r in got] == [(19_999, 2, None, 19_999), (20_000, 2, 19_999, 19_999), (20_000, 2, 19_999, 19_999)]


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.text("abé", min_size=1, max_size=6), st.integers(1, 200), max_size=25))
def test_any_words(spark, words):
    if words:
        assert result(spark, words, 3) == brute(words, 3)


DOCS = [
    (1, None),
    (2, ""),
    (None, "Wonderful wonderful WONDERFUL wonderfull"),
    (3, "naïvetés naïvetés ÀBCDEFGH àbcdefgh ×÷×÷×÷× ×÷×÷×÷×"),
    (3, "under_scores wonder7ful 世界wonderful\U0001f600wonderful \x00wonderful\x85wonderful"),
    (4, "short words only " * 50),
]


@pytest.mark.parametrize("divisor", [1, 2, 31])
def test_words_of_documents(spark, monkeypatch, divisor):
    monkeypatch.setattr(spellings, "HELD_WORDS", 3)
    frame = spark.createDataFrame([(*d, 1) for d in DOCS], "doc_id long, text string, n int")
    got = spellings.count_words(frame, "doc_id", "text", 7, 2, spellings.drop_by_checksum(divisor)).collect()
    assert {r.word: r.n for r in got} == brute_words(DOCS, divisor)


def test_query_on_the_test_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op12_spelling_variants"](spark, sf).collect()
    words = brute_words(docs)
    assert sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows) == brute(words) and len(rows) > 100


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert spellings.variants(spellings.count_words(frame, "doc_id", "text", 7, 2)).collect() == []
