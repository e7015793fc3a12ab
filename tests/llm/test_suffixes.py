import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vicinity.llm import suffixes


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    times = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if times[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, kept))
    return sorted(out, key=str)


def result(spark, rows, length):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, kept string")
    return sorted(((*tuple(r)[:4], bytes(r.kept)) for r in suffixes.remove_repeats(frame, length).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randrange(1, 8)))
    passages = [" ".join(word() for _ in range(rng.randrange(4, 30))) for _ in range(6)]
    rows = [(1, None), (2, ""), (None, "no id"), (3, "ab" * 200), (4, "x" * 17), (5, "x" * 16), (6, "\x00" * 50)]
    base = [word() for _ in range(80)]
    for i in range(60):
        words = [word() for _ in range(rng.randrange(0, 50))]
        for _ in range(rng.randrange(3)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(passages))
        if i % 4 == 0:
            words = [word() if rng.random() < 0.06 else w for w in base]
        rows.append((10 + i, " ".join(words)))
    rows += [(80, rows[20][1]), (81, rows[20][1]), (10, "an id twice"), (90, passages[0][:20]), (91, passages[0])]
    return rows


@pytest.mark.parametrize("length", [16, 31, 60])
def test_against_brute_force(spark, length):
    assert result(spark, corpus(length), length) == brute(corpus(length), length)


def test_small_buckets_and_runs(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 500)
    monkeypatch.setattr(suffixes, "RUN_SUFFIXES", 40)
    assert result(spark, corpus(5), 24) == brute(corpus(5), 24)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=70), max_size=8))
def test_any_texts(spark, texts):
    rows = list(enumerate(texts))
    if rows:
        assert result(spark, rows, 16) == brute(rows, 16)


COLLIDING = ["rutopaffquisaitysazbmazx", "hcnlzqdfquisaitygaqdpjoc", "jkrkqmhfquisaityjtrueyhy", "ncdjgqikquisaitymjjeuzcz"]


def test_surroundings_that_agree_in_their_upper_bits_only(spark):
    # one anchor each, of one gram; hashes of the first and the last two agree in 32 bits
    found = suffixes.Anchors(np.frombuffer("".join(COLLIDING).encode(), np.uint8), np.arange(0, 97, 24), 16)
    upper = (found.around() >> np.uint64(32)).tolist()
    assert found.at.tolist() == [8, 32, 56, 80] and len(set(found.grams.tolist())) == 1
    assert upper[0] == upper[1] and upper[2] == upper[3] and len(set(found.around().tolist())) == 4
    rows = list(enumerate(COLLIDING))
    assert result(spark, rows, 16) == brute(rows, 16)
    assert not any(r[2] for r in result(spark, rows, 16))


def test_copies_of_one_text_are_reduced_before_the_shuffle(spark):
    rng = random.Random(4)
    text, other = ("".join(rng.choices("abcdefgh", k=300)) for _ in range(2))
    rows = [(i, text) for i in range(400)] + [(400, other), (401, "short"), (402, "short")]
    keyed = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("xxhash64(text) AS key", "text").repartition(3)
    single = len(suffixes.Anchors(np.frombuffer(text.encode(), np.uint8), np.array([0, 300]), 24).at)
    alone = len(suffixes.Anchors(np.frombuffer(other.encode(), np.uint8), np.array([0, 300]), 24).at)
    sent = suffixes.send_anchors(keyed, 24, 2)
    assert sum(len(r.members) // 4 for r in sent.collect()) <= 2 * 3 * single + alone
    for parts in (1, 5):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = sorted((*tuple(r)[:4], bytes(r.kept)) for r in suffixes.remove_repeats(frame, 24).collect())
        assert got == sorted(brute(rows, 24))


@pytest.mark.parametrize("windows", [200, 1 << 20])
def test_suffixes_of_a_common_passage_do_not_meet_in_one_merge(spark, monkeypatch, windows):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choices("abcdefgh", k=n))
    short, long, after = word(18), word(33), [word(9) for _ in range(6)]
    rows = [(i, word(40) + (short if i % 2 else long) + (rng.choice(after) if i % 3 else "") + word(40)) for i in range(240)]
    rows += [(300 + i, (long + word(3)) * 4) for i in range(8)] + [(400, rows[0][1]), (401, rows[1][1]), (402, long), (403, short)]
    seen = []
    real = suffixes.merge_and_judge

    def watched(runs, *args):
        per_bucket = runs.selectExpr("bucket", "windows IS NOT NULL AS hot", "length(ordinals) / 4 AS n")
        seen.extend(per_bucket.groupBy("bucket", "hot").agg({"n": "sum"}).collect())
        return real(runs, *args)

    monkeypatch.setattr(suffixes, "RUN_SUFFIXES", 20)
    monkeypatch.setattr(suffixes, "HOT_WINDOWS", windows)
    monkeypatch.setattr(suffixes, "merge_and_judge", watched)
    assert result(spark, rows, 24) == brute(rows, 24)
    assert max((r["sum(n)"] for r in seen if not r.hot), default=0) < 100
    hot = [r["sum(n)"] for r in seen if r.hot]
    assert sum(hot) > 1000 and (windows > 200 or max(hot) < sum(hot) / 4)


def test_empty_table(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6) | st.text("ab", max_size=9).map(str.encode), max_size=12), min_size=1, max_size=9))
def test_merge_of_runs(groups):
    runs = [suffixes.front_code(sorted(g)) for g in groups]
    merged = list(suffixes.merge_runs(runs))
    strings = [sorted(groups[r])[i] for r, i, _ in merged]
    assert strings == sorted(x for g in groups for x in g)
    for (x, y), (_, _, n) in zip(zip(strings, strings[1:]), merged[1:]):
        assert x[:n] == y[:n] and (n == min(len(x), len(y)) or x[n] != y[n])


def test_known_prefixes_are_not_compared_again(monkeypatch):
    calls = []
    real = suffixes.common
    rng = random.Random(1)
    runs = [suffixes.front_code(sorted(b"p" * 500 + bytes(rng.choices(b"abcd", k=40)) for _ in range(50))) for _ in range(8)]
    monkeypatch.setattr(suffixes, "common", lambda x, y, known: calls.append((n := real(x, y, known)) - known) or n)
    assert len(list(suffixes.merge_runs(runs))) == 400
    # each string's characters are looked at about once: the shared 500 once per first round
    assert sum(calls) < 8 * 500 + 400 * 40


@pytest.mark.parametrize("length", [16, 40])
def test_equal_windows_have_equal_anchors(length):
    rng = random.Random(3)
    data = "".join(rng.choices("ab", k=3000)).encode()
    data += data[500:900]
    found = suffixes.Anchors(np.frombuffer(data, np.uint8), np.array([0, len(data)]), length)
    gram = length // 2
    places = {}
    for p in range(len(data) - length + 1):
        inside = {a - p for a in found.at.tolist() if p <= a <= p + length - gram}
        places.setdefault(data[p : p + length], []).append(inside)
    repeated = [v for v in places.values() if len(v) > 1]
    assert repeated and all(set.intersection(*v) for v in repeated)
    assert all(v[0] for v in places.values())


def test_query_on_a_small_table(spark, tmp_path):
    from vicinity.llm.queries import QUERIES

    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join(word() for _ in range(30)) + (passage if i % 3 == 0 else "") + word()) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op2_suffix_runs"](spark, str(tmp_path)).collect())
    assert got == sorted((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows, 200))
    assert any(r[2] for r in got)


def test_strings_made_to_agree_in_sums_stay_apart(spark):
    """Thue-Morse strings and their swapped twins agree in many bits of power sums."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one), (2, two), (3, "<" + one[:300] + ">"), (4, one[100:400])]
    assert result(spark, rows, 200) == brute(rows, 200)
    ends = np.array([0, 512, 1024])
    around = suffixes.Anchors(np.frombuffer((one[:512] + two[:512]).encode(), np.uint8), ends, 512).around()
    assert len(set((around & np.uint64(0xFFFFFFFF)).tolist())) == len(around) == 2
