import zlib

from pyspark.sql import functions as F

from vicinity.llm import shards
from vicinity.llm.queries import QUERIES


def brute(docs, n):
    rows = [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1]))
    total, at, out, slots = sum(r[1] for r in rows), 0, [], [0] * n
    for doc, size, crc in rows:
        shard = (2 * at + size) * n // (2 * total)
        out.append((doc, size, crc, shard, slots[shard]))
        slots[shard] += 1
        at += size
    return sorted(out, key=str)


def test_odd_rows(odd_docs):
    for n in (1, 3, 16):
        got = sorted((tuple(r) for r in shards.shard_by_bytes(odd_docs, n).collect()), key=str)
        assert got == brute(odd_docs.collect(), n)


def test_hot_and_null_ids_are_cut_further(spark):
    ids = [None] * 700 + [5] * 900 + [6] * 3 + list(range(400)) + [(1 << 60) + i % 3 for i in range(300)]
    docs = spark.createDataFrame([(d, f"text {i % 1900}") for i, d in enumerate(ids)], "doc_id long, text string")
    got = sorted((tuple(r) for r in shards.shard_by_bytes(docs, 16).collect()), key=str)
    assert got == brute(docs.collect(), 16)
    sized = docs.select("doc_id", F.lit(1).alias("size"), F.crc32("text").alias("text_crc32"))
    ranges = shards.cut_into_ranges(sized, 20).groupBy("_range").count()
    # neither of the hot ids, nor the null ones, are in one range
    assert ranges.agg(F.max("count")).first()[0] < 450
    ordered = shards.cut_into_ranges(sized, 20).orderBy(F.asc_nulls_last("doc_id"), "text_crc32").select("_range")
    found = [r[0] for r in ordered.collect()]
    assert found == sorted(found)


def test_empty_table(odd_docs):
    assert shards.shard_by_bytes(odd_docs.limit(0), 16).collect() == []


def test_query_on_the_test_table(spark, sf):
    frame = QUERIES["op3_byte_shards"](spark, sf)
    rows = frame.collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in rows), key=str)
    assert got == brute(docs, 16)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(16)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
