import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vicinity.llm import repetitions
from vicinity.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and (i, length) not in found:
                found[i, length] = q
            i = max(j, i) + 1
    return sorted((s, q, length) for (s, length), q in found.items())


def brute_collapse(w, runs):
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def result(spark, docs):
    frame = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, runs string")
    rows = repetitions.find_runs(frame).collect()
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed).decode()) for r in rows), key=str)


def expected(docs):
    out = []
    for d, t in docs:
        w = WORD.findall(t or "")
        runs = brute_runs(w)
        out.append((d, len(w), runs, brute_collapse(w, runs)))
    return sorted(out, key=str)


def test_odd_rows(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert result(spark, docs) == expected(docs)


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_runs_of_all_scales(spark, monkeypatch, piece):
    monkeypatch.setattr(repetitions, "PIECE_BYTES", piece)
    rng = random.Random(11)
    docs = [(1, "a " * 5), (2, "a " * 6), (3, "a b " * 4), (4, "a b a b a b a"), (5, "x " * 1000), (5, "x " * 1000)]
    docs += [(None, "a a a a a a b " * 6), (6, ("a " * 7 + "b ") * 5 + "a " * 9), (7, "\n".join(["a b a b c"] * 4))]
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            period = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 31, 32, 33, 64, 100]))]
            size = rng.randrange(1, 7 * len(period) + 2)
            parts += (period * 8)[:size]
            parts += [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(3))]
        docs.append((100 + i, " ".join(parts)))
    rng.shuffle(docs)
    assert result(spark, docs) == expected(docs)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aab"), max_size=60).map(" ".join), max_size=12))
def test_any_texts(spark, texts):
    docs = list(enumerate(texts))
    if docs:
        assert result(spark, docs) == expected(docs)


def test_a_long_text_of_one_word(spark):
    (row,) = result(spark, [(1, "a " * 30_000 + "b")])
    assert row[2] == [(0, 1, 30_000)] and row[3] == "a b"


def rewritten(doc, w):
    g, last = divmod(zlib.crc32(str(doc).encode()), 10)
    if last or not w:
        return w
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_query_on_the_test_table(spark, sf):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    wanted = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = rewritten(r.doc_id, WORD.findall(r.text or ""))
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-x[2], x[0], x[1]), default=None)
        four = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
        listed = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
        wanted.append((r.doc_id, len(runs), *four, sha(listed), sha(brute_collapse(w, runs))))
    rows = QUERIES["op13_periodic_runs"](spark, sf)
    assert rows.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    got = sorted(map(tuple, rows.collect()))
    assert got == sorted(wanted) and sum(r[1] > 0 for r in got) > 5


def test_empty_table(spark):
    assert result(spark, [(1, None)]) == [(1, 0, [], "")]
    assert repetitions.find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
