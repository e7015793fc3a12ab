"""The registered corpus queries; SQL twins stand beside those SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinity.llm import (
    archives,
    balltree,
    bpe,
    codes,
    exact,
    jaccard,
    packing,
    pages,
    quality,
    repetitions,
    shards,
    spellings,
    suffixes,
)
from vicinity.llm.common import read, shared_folder, written
from vicinity.session import ship

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        @wraps(plan)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return plan(spark, sf_dir)

        QUERIES[plan.__name__] = shipped
        if sql is not None:
            ORACLES[plan.__name__] = sql
        return plan

    return add


@query()
def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = bpe.decode(bpe.encode(read(spark, sf_dir, "documents"), path), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op2_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffixes.remove_repeats(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op3_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_by_bytes(read(spark, sf_dir, "documents"), 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(quality.ORACLE)
def op4_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.apply(quality.ledger(read(spark, sf_dir, "documents")), quality.PROSE)
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *measures, quality.rejected(quality.BASE).alias("base_failed"), "kept")


@query(
    """
    WITH d AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    k AS (SELECT page_id, strlen(html) AS n, sha256(html) AS digest FROM d),
    f AS (SELECT digest, min(page_id) AS first FROM k GROUP BY digest)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
    FROM k JOIN f USING (digest)
    """
)
def op5_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = archives.with_revisits(read(spark, sf_dir, "pages"))
    manifest = written(archives.write_archives(marked, shared_folder(spark, "packages")), "package-manifest")
    found = archives.read_archives(manifest)
    whole = F.col("payload")
    return found.select(
        "page_id",
        F.coalesce(F.octet_length(whole).cast("long"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2(whole, 256), "payload_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


@query()
def op6_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.cut_pieces(docs, path, 2048, end_id=0), 2048)


@query()
def op7_page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = pages.extract(read(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query(
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
    ),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """
)
def op8_ball_tree_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = codes.write_codes(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        shared_folder(spark, "token-files"),
        end_id=2,
    )
    back = codes.read_codes(written(manifest, "token-manifest"))
    return back.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query(
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    s AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM w)
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
    e AS (SELECT a, b FROM o JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * k >= 75 * (p.n + q.n - k)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
    SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
    FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM r GROUP BY a) USING (doc_id)
    """
)
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups_of(read(spark, sf_dir, "documents"))


@query(
    r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
        FROM documents
    ),
    g AS (
        SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS place,
               first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id
        FROM d
    )
    SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
    """
)
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.group_copies(read(spark, sf_dir, "documents"), every_digest=True)
    return groups.withColumnRenamed("digest", "text_sha256")


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    edit = spellings.drop_by_checksum(31)
    words = spellings.count_words(read(spark, sf_dir, "documents"), "doc_id", "text", least_chars=7, least_times=2, edit=edit)
    return spellings.variants(words, factor=10)


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetitions.find_runs(
        read(spark, sf_dir, "documents"), edit=repetitions.repeat_by_checksum, finish=lambda b: hashlib.sha256(b).digest()
    )
    order = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    best = found.withColumn("_best", F.array_max(order.cast("array<struct<length: long, start: long, period: long>>")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.lower(F.hex("collapsed")).alias("collapsed_sha256"),
    )
