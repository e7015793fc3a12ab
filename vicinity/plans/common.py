"""The embedded catalogue the plans run on, and SQL fragments for the checks.

``documents`` supplies the texts, ``embeddings`` the vectors (many documents have
none), ``labels`` the upkeep state: a document of quality 1 carries the hash of
its text, one of quality 0 the hash of a draft, the others none; non-toxic ones
have an embedding time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinity.functions.text import text_hash
from vicinity.session import table

EMBEDDED_AT = "2024-01-01 00:00:00"
AS_OF = "2024-06-01 12:00:00"
QUESTION = "that and the with under our words"


def as_of(moment: str = AS_OF):
    return F.lit(moment).cast("timestamp")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    vectors = table(spark, sf_dir, "embeddings")
    labels = table(spark, sf_dir, "labels")
    joined = documents.join(vectors, F.col("doc_id") == F.col("vec_id"), "left").join(
        labels, "doc_id", "left"
    )
    stored = F.when(F.col("quality") == 1, text_hash(F.col("text"))).when(
        F.col("quality") == 0, text_hash(F.concat("text", F.lit(" (draft)")))
    )
    return joined.select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("beer_name"),
        F.col("source").alias("brewery"),
        F.col("lang").alias("style"),
        F.col("n_chars"),
        F.col("label"),
        F.col("text").alias("info"),
        stored.alias("text_hash"),
        "embedding",
        F.when(F.col("toxic") == 0, as_of(EMBEDDED_AT)).alias("embedded_at"),
    )


CATALOG = f"""catalog AS (
  SELECT d.doc_id AS id, 'doc-' || d.doc_id AS beer_name, d.source AS brewery, d.lang AS style,
         d.n_chars, e.label, d.text AS info, e.embedding,
         CASE l.quality WHEN 1 THEN sha256(d.text) WHEN 0 THEN sha256(d.text || ' (draft)') END AS text_hash,
         CASE WHEN l.toxic = 0 THEN TIMESTAMP '{EMBEDDED_AT}' END AS embedded_at
  FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

STALE = """(info <> '' AND (embedding IS NULL OR embedded_at IS NULL
  OR text_hash IS DISTINCT FROM sha256(info)))"""


def cosine(a: str, b: str) -> str:
    return f"greatest(0.0, least(2.0, list_cosine_distance({a}::DOUBLE[], {b}::DOUBLE[])))"


def words(source: str, name: str, id_col: str = "id", text_col: str = "info", prefix: str = "") -> str:
    """CTEs with the sparse word counts and norms of a table of texts."""
    text = f"'{prefix}' || {text_col}" if prefix else text_col
    return f"""{name}_words AS (
  SELECT {id_col} AS id, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source}
), {name} AS (
  SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 384 AS dim, count(*)::DOUBLE AS c
  FROM {name}_words GROUP BY ALL
), {name}_norm AS (SELECT id, sqrt(sum(c * c)) AS norm FROM {name} GROUP BY id)"""


def text_distance(queries: str, corpus: str) -> str:
    """SELECT of qid, id, distance between two sparse tables made by ``words``."""
    return f"""SELECT q.id AS qid, n.id,
    greatest(0.0, 1.0 - coalesce(any_value(d.dot), 0.0) / (any_value(q.norm) * any_value(n.norm))) AS distance
  FROM {queries}_norm q CROSS JOIN {corpus}_norm n
  LEFT JOIN (SELECT a.id AS qid, b.id, sum(a.c * b.c) AS dot
             FROM {queries} a JOIN {corpus} b ON a.dim = b.dim GROUP BY a.id, b.id) d
    ON d.qid = q.id AND d.id = n.id
  GROUP BY q.id, n.id"""
