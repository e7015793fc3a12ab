import random
import re
from collections import defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from vicinity.llm import quality, suffixes


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghé", k=rng.randrange(2, 8)))
    base = [word() for _ in range(120)]
    passage = " ".join(word() for _ in range(60))
    rows = []
    for i in range(40):
        words = [word() for _ in range(rng.randrange(55, 120))]
        if i % 5 == 0:
            words = list(base)
            words[i % 7] = word()
        text = " ".join(words) + (" " + passage if i % 4 == 1 else "")
        rows.append((i, text))
    rows += [(50, "too short"), (51, None), (52, ""), (53, " ".join(["*** x"] * 80)), (1, rows[7][1]), (None, rows[8][1]), (None, rows[8][1])]
    rows += [(60, rows[3][1]), (60, rows[3][1])]
    return spark.createDataFrame(
        [(d, t, "en", "src", len(t or ""), "clash") for d, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, kept string",
    )


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_stages_against_brute_force(spark, docs):
    good = corpus_pipeline.quality_rules(spark, docs, "")
    assert good.columns == docs.columns
    base = [r for r in docs.collect() if r.text and len(r.text.split()) >= 50 and r.doc_id != 53]
    assert rows_of(good) == sorted(map(tuple, base), key=str)

    single = corpus_pipeline.near_duplicates(spark, good, "")
    assert single.columns == docs.columns
    left = list(base)
    root = list(range(len(left)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [shingles(r.text) for r in left]
    for i in range(len(left)):
        for j in range(i):
            if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(left):
        groups[find(i)].append((r.doc_id is None, r.doc_id or 0, tuple(r)))
    want = sorted((min(g)[2] for g in groups.values()), key=str)
    assert rows_of(single) == want and len(want) < len(left)

    cleaned = corpus_pipeline.repeated_passages(spark, single, "")
    assert cleaned.columns == docs.columns
    from test_suffixes import brute

    kept = {r[0]: r[4] for r in brute([(k, r[1]) for k, r in enumerate(want)], 200)}
    expect = []
    for k, r in enumerate(want):
        text = kept[k].decode("utf-8", "ignore")
        expect.append((r[0], text, r[2], r[3], r[4] if text == r[1] else len(text), r[5]))
    assert rows_of(cleaned) == sorted(expect, key=str)
    assert any(a[1] != b[1] for a, b in zip(sorted(want, key=str), rows_of(cleaned)))

    from test_packing import check

    packed = corpus_pipeline.best_fit_packing(spark, cleaned, "").collect()
    bins, least = check(packed, cleaned.collect(), 2048)
    assert bins <= least + 1


def test_empty_table(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), "")
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").collect() == []


def test_columns_named_like_those_of_the_stages(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "own1", 7), (1, text, "own1", 7), (2, text + " more", "own2", 8), (3, "another text of its own, of eleven words or a few", "own3", 9)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _row string, kept int")
    single = corpus_pipeline.near_duplicates(spark, table, "")
    assert single.columns == table.columns and rows_of(single) == [rows[0], rows[3]]
    cleaned = corpus_pipeline.repeated_passages(spark, table.filter("doc_id > 1"), "")
    assert {(r[0], r[2], r[3]) for r in rows_of(cleaned)} == {(2, "own2", 8), (3, "own3", 9)}


def test_run_on_the_test_table(spark, sf):
    out = corpus_pipeline.run(spark, sf).collect()
    assert out and all(0 < r.length <= 2048 for r in out)
    assert "pipeline" in corpus_pipeline.QUERIES and corpus_pipeline.ORACLE_SQL is None


def test_entry_registers_all(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {re.match(r"op\d+_", n)[0] for n in names if re.match(r"op\d+_", n)}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names
    assert quality.PROSE.rules and suffixes.ONCE == 0 and public_tokenizers.path("word_bpe_49k.json")
