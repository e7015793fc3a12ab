import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vicinity.llm import jaccard
from vicinity.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, percent=75):
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def result(spark, rows):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, component_id string")
    return sorted((tuple(r) for r in jaccard.groups_of(frame).collect()), key=str)


def mutated(rng, words, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in words)


@pytest.mark.parametrize("fragment,cell", [(1 << 21, 20_000), (300, 7)])
def test_groups_of_near_copies(spark, monkeypatch, fragment, cell):
    monkeypatch.setattr(jaccard, "FRAGMENT", fragment)
    monkeypatch.setattr(jaccard, "CELL", cell)
    rng = random.Random(9)
    rows = [(3, None), (4, ""), (5, " \n"), (6, "one"), (7, "ONE"), (8, "a b c d"), (9, "a b c d e"), (10, "a b c d e"), (None, "a b c d")]
    rows += [(None, None), (2, "shared by nobody else at all"), (None, "known to nulls only, twice or so"), (None, "known to nulls only, twice or so")]
    at = 100
    for _ in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(6, 160))]
        for _ in range(rng.randrange(1, 12)):
            rows.append((at, mutated(rng, words, rng.choice([0, 0.01, 0.03, 0.05]))))
            at += rng.randrange(1, 3)
    passage = " ".join(f"p{i}" for i in range(60))
    for _ in range(15):
        rows.append((at, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60)))))
        at += 1
    rows.append((101, "an id that is there already"))
    rng.shuffle(rows)
    assert result(spark, rows) == brute(rows)


def test_a_large_group_of_one_text(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, mutated(rng, words, 0.02)) for i in range(150)] + [(200 + i, " ".join(words)) for i in range(100)]
    assert result(spark, rows) == brute(rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcXé"), max_size=9).map(" ".join), max_size=14))
def test_any_texts(spark, texts):
    rows = list(enumerate(texts))
    if rows:
        assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert jaccard.groups_of(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 199), (200, 199)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {199: 199, 200: 199}


def test_partners_of_a_class_are_spread_whichever_side_it_is_on(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL", 50)
    stars = [(i, 10_000, 9, 9) for i in range(1000)] + [(-1, i, 9, 9) for i in range(1000)]
    block = [(20_000 + i, 30_000 + j, 9, 9) for i in range(60) for j in range(60)]  # many partners on both sides
    for rows in (stars, block):
        pairs = spark.createDataFrame(rows, "a long, b long, size_a int, size_b int")
        cells = -(-len(rows) // 50)
        placed = jaccard.in_cells(pairs, cells).collect()
        assert sorted((r.a, r.b, r.size_a, r.size_b) for r in placed) == sorted(rows)
        held = Counter(r.cell for r in placed)
        assert set(held) <= set(range(cells)) and max(held.values()) <= len(rows) // 4 and len(held) > cells // 2


@pytest.mark.parametrize("fragments", [1, 4, 128, 1 << 16, 1 << 20])
def test_overlap_is_counted_in_several_parts(fragments):
    rng = np.random.default_rng(1)
    whole = rng.integers(0, 1 << 64, 4000, np.uint64)
    number = (whole >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
    tokens = np.array([jaccard.with_fragment(t & jaccard.LOW, int(f), fragments) for t, f in zip(whole, number)])
    if fragments >= 1 << 16:
        assert (tokens == whole).all()
    tokens = np.sort(tokens)
    held = np.diff([0, *np.searchsorted(tokens, jaccard.borders_of(fragments)).tolist(), len(tokens)])
    assert len(held) == jaccard.PARTS and held.min() > 500


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_made_to_agree_in_sums_stay_apart(spark):
    """Sums of byte values times powers of a number agree for these pairs."""
    swap = str.maketrans("ab", "ba")
    pairs = [(thue_morse(n), thue_morse(n).translate(swap)) for n in (1024, 2048)]
    # bytes whose numbers differ by a multiple of a high power of two
    from vicinity.llm.hashing import BYTE_VALUES

    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    x, y = max(
        ((a, b) for a in letters for b in letters if a < b),
        key=lambda p: (int(BYTE_VALUES[ord(p[0])]) ^ int(BYTE_VALUES[ord(p[1])])) & -(int(BYTE_VALUES[ord(p[0])]) ^ int(BYTE_VALUES[ord(p[1])])),
    )
    one = thue_morse(512).translate(str.maketrans("ab", x + y))
    pairs.append((one, one.translate(str.maketrans(x + y, y + x))))
    rows = [(i, t) for i, t in enumerate(t for pair in pairs for t in pair)] + [(9, "a third text")]
    assert result(spark, rows) == [(i, 1, i) for i, _ in rows]
