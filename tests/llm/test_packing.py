import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vicinity.llm import packing
from vicinity.llm.common import written

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_pieces(docs, capacity):
    library, out = Tokenizer.from_file(PATH), []
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((d.doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=str)


def check(rows, docs, capacity):
    assert sorted((tuple(r)[:5] for r in rows), key=str) == brute_pieces(docs, capacity)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r.length for r in rows) // capacity)


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_odd_rows(odd_docs, capacity):
    pieces = packing.cut_pieces(odd_docs, PATH, capacity, 0)
    got, least = check(packing.pack(pieces, capacity).collect(), odd_docs.collect(), capacity)
    assert got <= least + 1


def test_empty_table(odd_docs):
    pieces = packing.cut_pieces(odd_docs.limit(0), PATH, 8, 0)
    assert packing.pack(pieces, 8).collect() == []


def test_regions_are_packed_together_in_the_end(spark, monkeypatch):
    monkeypatch.setattr(packing, "REGION", 16)
    monkeypatch.setattr(packing, "FAN_IN", 3)
    rng = random.Random(3)
    rows = [(i, 0, 0, rng.randrange(1, 90), 5) for i in range(400)]
    pieces = written(spark.createDataFrame(rows, packing.PIECE), "pieces")
    out = packing.pack(pieces, 100).collect()
    assert sorted(r.doc_id for r in out) == list(range(400))
    loads = defaultdict(int)
    for r in out:
        loads[r.sequence_id] += r.length
    assert max(loads.values()) <= 100
    alone = packing.Island([r[3] for r in rows], 100, 0)
    assert len(loads) <= 1.1 * len(alone.loads(alone.fresh(0.0)))


def test_crossover_keeps_every_piece_and_the_capacity():
    rng = random.Random(1)
    island = packing.Island([rng.randrange(1, 100) for _ in range(300)], 100, 7)
    a, b = island.fresh(0.5), island.fresh(0.8)
    for _ in range(50):
        child = island.cross(a, b)
        assert (child >= 0).all() and island.loads(child).max() <= 100 and (island.loads(child) > 0).all()
        a, b = child, a


def test_evolution_beats_best_fit():
    # triples that fill a bin exactly, which best fit does not find
    rng = random.Random(2)
    lengths = []
    for _ in range(40):
        a, b = rng.randrange(260, 480), rng.randrange(260, 480)
        lengths += [a, b, 1000 - a - b]
    island = packing.Island(lengths, 1000, 3)
    start = island.cost(island.fresh(0.0))
    best = island.evolve([])
    for _ in range(5):
        best = island.evolve(best)
    assert island.cost(best[0]) < start


def test_query_on_the_test_table(spark, sf):
    from vicinity.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got, least = check(QUERIES["op6_genetic_packing"](spark, sf).collect(), docs, 2048)
    assert got <= least + 1
