import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vicinity.llm import codes
from vicinity.llm.common import shared_folder, written

PATH = public_tokenizers.path("byte_bpe_50k.json")


def in_memory(docs, sizes, ids, bits=8):
    data = b"".join(codes.file_parts(docs, np.array(sizes, np.int64), np.array(ids, np.uint32), bits))
    return codes.CodeFile(io.BytesIO(data), len(data))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.integers(1, 16), st.data())
def test_any_ids_come_back_from_any_place(ids, bits, data):
    file = in_memory([7], [len(ids)], ids, bits)
    assert file.tokens(0, len(ids)).tolist() == ids
    if ids:
        a = data.draw(st.integers(0, len(ids) - 1))
        b = data.draw(st.integers(a, len(ids)))
        assert file.token(a) == ids[a] and file.tokens(a, b).tolist() == ids[a:b]


def test_long_run_across_rank_blocks():
    ids = [(i * 7919) % 60000 for i in range(20_000)]
    file = in_memory([1, None], [19_999, 1], ids)
    assert [file.token(i) for i in (0, 511, 512, 513, 8191, 19_999)] == [ids[i] for i in (0, 511, 512, 513, 8191, 19_999)]
    assert file.documents()[0] == [1, None]


def test_damaged_file():
    with pytest.raises(ValueError):
        codes.CodeFile(io.BytesIO(bytes(40)), 40)


def brute(docs):
    library = Tokenizer.from_file(PATH)
    at, out = 0, []
    for r in sorted(docs, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode())):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        out.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=str)


def rows_of(frame):
    cols = ["doc_id", "start", (F.octet_length("ids") / 4).cast("long"), F.crc32("ids")]
    return sorted((tuple(r) for r in frame.select(*cols).collect()), key=str)


@pytest.mark.parametrize("most", [1, 50, 1 << 22])
def test_odd_rows(spark, odd_docs, most):
    manifest = codes.write_codes(odd_docs, PATH, shared_folder(spark, "codes"), 2, tokens_per_file=most)
    assert rows_of(codes.read_codes(written(manifest, "manifest"))) == brute(odd_docs.collect())


def test_rows_of_one_id_fill_several_tasks(spark):
    rows = [(None, f"text {i}") for i in range(300)] + [(5, f"{i} text") for i in range(300)] + [(i, "x") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = written(codes.write_codes(docs, PATH, shared_folder(spark, "codes"), 2), "manifest")
    assert manifest.agg(F.max("documents")).first()[0] < 300
    assert rows_of(codes.read_codes(manifest)) == brute(docs.collect())


def test_empty_table(spark, odd_docs):
    manifest = codes.write_codes(odd_docs.limit(0), PATH, shared_folder(spark, "codes"), 2)
    assert codes.read_codes(written(manifest, "manifest")).count() == 0


def test_query_on_the_test_table(spark, sf):
    from vicinity.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert sorted((tuple(r) for r in QUERIES["op9_token_files"](spark, sf).collect()), key=str) == brute(docs)
