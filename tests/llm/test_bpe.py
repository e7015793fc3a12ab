import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vicinity.llm import bpe
from vicinity.llm.words import WordEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def ids_of(packed):
    return memoryview(packed).cast("I").tolist()


def test_odd_rows_encode_and_decode_as_the_library_does(odd_docs, library):
    got = bpe.decode(bpe.encode(odd_docs, PATH), PATH).collect()
    want = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in odd_docs.collect()]
    key = lambda x: (x[0] is None, x[0], x[1])
    assert sorted([(r.doc_id, list(r.ids)) for r in got], key=key) == sorted(want, key=key)
    assert all(r.decoded == library.decode(list(r.ids), skip_special_tokens=False) for r in got)


def test_empty_table(spark, odd_docs):
    assert bpe.decode(bpe.encode(odd_docs.limit(0), PATH), PATH).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x2FFF), max_size=80))
def test_any_text(text):
    assert ids_of(bpe.bpe(PATH).packed(text)) == LIBRARY.encode(text, add_special_tokens=False).ids


LETTERS = " \t\n\r  'stabTHE019éßÀİΣς世<|>***%%\U0001f600\u0301\xa0"


def random_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choices(LETTERS, k=rng.randrange(60))) for _ in range(n)] + [
        "Wörter " * 30 + "x" * 500 + "<|endoftext|>a<|startoftext|>", "I'LL it'S 'd''t", "a\x85b\x1cc\u2003d  e",
    ]


def test_many_texts():
    texts = random_texts(4000)
    packed = bpe.ForcedBoundaryBPE(PATH).packed_all(texts)
    for text, got in zip(texts, packed, strict=True):
        assert ids_of(got) == LIBRARY.encode(text, add_special_tokens=False).ids, text


def test_many_texts_in_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, texts = Tokenizer.from_file(path), random_texts(4000)
    for text, got in zip(texts, WordEncoder(path).packed_all(texts), strict=True):
        assert ids_of(got) == library.encode(text, add_special_tokens=False).ids, text


def test_forced_cuts_join_no_token():
    encoder = bpe.bpe(PATH).table
    for text in ("ZQjxqz", "éÿÿ", "thing", "x" * 100):
        data = np.frombuffer(text.encode(), np.uint8)
        starts = encoder.cut(data, np.array([len(data)]))
        for at in starts[1:]:
            assert not any(bytes(data[at - 1 : at + 1]) in t for t in encoder.token_bytes)
        assert starts[0] == 0 and (len(starts) > 1) == (text in ("ZQjxqz", "éÿÿ"))


def test_decoding_of_torn_characters(spark):
    ids = [LIBRARY.encode(t, add_special_tokens=False).ids for t in ("é世", "\U0001f600", "")]
    torn = [ids[0][:-1], ids[1][1:], ids[1][:1], [], ids[0]]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(torn)], "n long, ids array<int>")
    got = {r.n: r.decoded for r in bpe.decode(frame, PATH).collect()}
    assert got == {i: LIBRARY.decode(t, skip_special_tokens=False) for i, t in enumerate(torn)}


def test_query_on_the_test_table(spark, sf, library):
    from vicinity.llm.queries import QUERIES

    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op1_bpe_roundtrip"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id] == (len(ids), sha, hashlib.sha256((d.text or "").encode()).hexdigest())
