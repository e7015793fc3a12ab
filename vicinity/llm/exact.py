"""Groups of equal texts by progressive refinement: length, head, whole text.

Texts are equal when identical after blanks (``[\\x20\\x09-\\x0D]``) are deleted. Each
level only looks at what the level before has left:

1. lengths (bytes without blanks) that several rows have,
2. among those, hashes of the first ``HEAD`` characters that several rows have,
3. among those, the SHA-256 of the whole text; equal ones are a group.

A level hands the next one a bitmap of the keys that survive, ``BITS`` bits in blocks of
4 KB and thus at most 16 MB whatever the table, so that rows meet it by broadcast and no
text is ever shuffled. A bit may be set for another key too; such a row is hashed in
vain and the last level, which compares lengths, heads and digests, parts it again.
Groups that hold a thousandth of the rows or more (at most 1,000 groups) reach their
rows by broadcast as well; no other group is large enough to fill a task. Everything is
DataFrame functions.

The row with the most characters stays, of these the smallest id, of rows alike in both
any one, but exactly one. A null text counts as empty; a null id comes after all others.
Rows with equal ids are rows of their own. An empty table gives no rows. Only the two
named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vicinity.llm.common import written

BLANKS = r"[\x20\x09-\x0D]+"
HEAD = 64  # characters of the second level
BITS = 1 << 27
BLOCK = 1 << 15  # bits of a row of the bitmap, fixed by the aggregate function
HEAVY = 1_000  # groups of this part of all rows, or more, are broadcast


def bit_of(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BITS))


def survivors(counted: DataFrame, *key: str) -> DataFrame:
    """A bitmap (block, bits) of the keys of several rows; at most BITS / BLOCK rows."""
    bit = counted.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(bit_of(*key).alias("bit"))
    return bit.groupBy(F.expr(f"bit div {BLOCK}").alias("_block")).agg(
        F.bitmap_construct_agg(F.col("bit") % BLOCK).alias("_bits")
    )


def marked(rows: DataFrame, bitmap: DataFrame, *key: str) -> DataFrame:
    """Add ``survives``: whether the bit of the row's key is set."""
    placed = rows.withColumn("_bit", bit_of(*key)).withColumn("_block", F.expr(f"_bit div {BLOCK}"))
    byte = F.expr(f"cast(conv(hex(substring(_bits, cast(_bit % {BLOCK} div 8 as int) + 1, 1)), 16, 10) as int)")
    is_set = F.getbit(byte, F.col("_bit").cast("int") % 8) == 1
    held = placed.join(F.broadcast(bitmap), "_block", "left").withColumn("survives", F.coalesce(is_set, F.lit(False)))
    return held.drop("_block", "_bit", "_bits")


def group_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every_digest: bool = False
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and ``digest`` of every row. The digest is that of
    the text without blanks; it is null where no other row can be equal, unless
    ``every_digest`` asks for a report of all."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.length("text").alias("chars"), F.regexp_replace("text", BLANKS, "").alias("plain")
    )
    sized = read.withColumn("length", F.octet_length("plain"))
    first = written(sized.select("length", F.substring("plain", 1, HEAD).alias("start")), "lengths")
    by_length = written(survivors(first, "length"), "length-bits")
    second = marked(first, by_length, "length").filter("survives")
    by_head = written(survivors(second.select("length", F.xxhash64("start").alias("head")), "length", "head"), "head-bits")

    headed = sized.withColumn("head", F.xxhash64(F.substring("plain", 1, HEAD)))
    digest = F.sha2("plain", 256)
    rows = marked(headed, by_head, "length", "head").select(
        "doc_id",
        "chars",
        "length",
        "head",
        F.col("survives").alias("open"),
        (digest if every_digest else F.when(F.col("survives"), digest)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows, "digests")  # row numbers are read back from here everywhere
    key = ["length", "head", "digest"]
    order = F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    groups = rows.filter("open").groupBy(*key).agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    best = [F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")]
    groups = written(groups.filter("group_size > 1").select(*key, "group_size", *best), "groups")
    total = rows.count()
    heavy = groups.filter(F.col("group_size") * HEAVY >= total)
    light = groups.filter(F.col("group_size") * HEAVY < total)

    asking = rows.filter("open")
    hot = asking.join(F.broadcast(heavy), key)
    # a digest of several rows that isn't in a heavy group is in a light one or alone
    rest = asking.join(F.broadcast(heavy), key, "left_anti").join(light.hint("merge"), key, "left")
    nothing = F.lit(None).cast("long")
    alone = rows.filter("not open").select("*", *[nothing.alias(c) for c in ("group_size", "keep_id", "keep_row")])
    every = hot.unionByName(rest).unionByName(alone)
    single = F.col("group_size").isNull()
    return every.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "digest",
    )
