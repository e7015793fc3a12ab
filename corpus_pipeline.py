"""The corpus pipeline: quality rules, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written to the
shared folder and read back as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinity.llm import jaccard, packing, quality, suffixes
from vicinity.llm.common import free_name, read, written
from vicinity.llm.queries import ORACLES, QUERIES, query
from vicinity.session import ship

TOKENS_PER_SEQUENCE = 2048


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, of repeated
    rows any one. A group all of whose ids are null keeps one row as well."""
    ship(spark)
    columns = docs.columns
    # ids may repeat or be null: a row is known by a number that is written once
    row = free_name("_row", columns)
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = jaccard.groups_of(numbered, id_col=row)
    # the smallest row number of a group names it; ids decide which row stays
    known = numbered.select(F.col(row).alias("doc_id"), F.col("doc_id").alias("id"))
    member = known.join(groups.hint("merge"), "doc_id")
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("doc_id"))
    first = written(member.groupBy("component_id").agg(F.min(rank)["doc_id"].alias(row)).select(row), "kept-rows")
    return numbered.join(first.hint("merge"), row, "left_semi").select(*[F.col(f"`{c}`") for c in columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 200 bytes that occur twice. A character cut
    in two goes as a whole; a null text stays null; n_chars follows the text."""
    ship(spark)
    columns = docs.columns
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col("text").alias("_body"))
    cleaned = suffixes.remove_repeats(carried, id_col="_row", text_col="_body", as_text=True)
    whole = F.col("n_removed") == 0
    text = F.when(whole, F.col("doc_id.text")).otherwise(F.col("kept"))
    out = cleaned.withColumn("_text", text)
    renewed = {"text": F.col("_text")}
    if "n_chars" in columns:
        renewed["n_chars"] = F.when(whole, F.col("doc_id.n_chars")).otherwise(
            F.length("_text").cast(docs.schema["n_chars"].dataType)
        )
    return out.select(*[renewed.get(c, F.col("doc_id").getField(c)).alias(c) for c in columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, and its place in a sequence."""
    ship(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.cut_pieces(docs, path, TOKENS_PER_SEQUENCE, end_id=0), TOKENS_PER_SEQUENCE)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", best_fit_packing),
]

#: Tokens and genetic packing are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    table = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        table = written(stage(spark, table, sf_dir), "stage")
    return STAGES[-1][1](spark, table, sf_dir)


@query(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
