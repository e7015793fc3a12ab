"""Quality rules kept as a ledger of bits.

Every rule is evaluated once per document; the ledger stores a bit per failed rule
and the measurements behind them. Policies are versioned sets of rules: applying one
is a mask, and what each of its rules alone costs (an ablation) comes from counting
the few distinct bit patterns, without reading a text again.

Only DataFrame functions are used and nothing of a text is shuffled. Words are runs
of characters other than U+0020 and U+0009 to U+000D. Null and empty texts measure 0
everywhere and fail ``few_words``. Repeated rows are judged each for itself, null ids
are kept, an empty table gives an empty ledger. Windows of three words are compared
by 64-bit hashes of their words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Rule names in bit order, and what fails them. New rules go to the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbol_noise": "10 * n_symbols > n_words",
    "exclamations": "2 * n_exclamations > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_exclamations", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Policy:
    """A named version of the rules that reject."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in set(self.rules))


BASE = Policy("base", 1, ("few_words", "repeated_words"))
PROSE = Policy("prose", 1, (*BASE.rules, "symbol_noise", "exclamations"))
STRICT = Policy("prose", 2, tuple(RULES))


def occurrences(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measurements, as long."""
    text = F.col("_text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    inner = F.btrim(text, F.lit(BLANKS))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    split = rows.select(
        "doc_id",
        F.when(inner != "", F.split(inner, BETWEEN_WORDS)).otherwise(F.array().cast("array<string>")).alias("_words"),
        lines.alias("_lines"),
        (F.length(text) - occurrences(text, BLANKS)).alias("word_chars"),
        occurrences(text, SYMBOLS).alias("n_symbols"),
        occurrences(text, "!").alias("n_exclamations"),
    )
    words = F.col("_words")
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    hashed = split.select(
        "doc_id",
        "word_chars",
        "n_symbols",
        "n_exclamations",
        F.size("_words").alias("n_words"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.when(F.size(words) > 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)).alias("_windows"),
    )
    # most texts repeat no window and are done here; the others sort theirs by hash
    repeats = F.size("_windows") > F.size(F.array_distinct("_windows"))
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    ordered = hashed.withColumn("_ordered", F.when(repeats, F.sort_array(placed))).drop("_windows")
    same = lambda e, i: F.coalesce(F.get("_ordered", i)["h"] == e["h"], F.lit(False))
    found = F.filter("_ordered", lambda e, i: F.when(i > 0, same(e, i - 1)).otherwise(False) | same(e, i + 1))
    starts = ordered.withColumn("_starts", F.sort_array(F.transform(found, lambda e: e["at"]))).drop("_ordered")
    # windows cover three words each, or those since the last window
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("words"), F.lit(-3).alias("last")),
        lambda seen, at: F.struct(
            (seen["words"] + F.least(F.lit(3), at - seen["last"])).alias("words"), at.alias("last")
        ),
        lambda seen: seen["words"],
    )
    counted = starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)))
    return counted.select("doc_id", *[F.col(m).cast("long").alias(m) for m in MEASURES])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements and ``failed``, bit n set if rule n fails."""
    bits = [F.when(F.expr(fails), F.lit(1 << n)).otherwise(F.lit(0)) for n, fails in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs, id_col, text_col).withColumn("failed", failed.cast("long"))


def rejected(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply(entries: DataFrame, policy: Policy) -> DataFrame:
    """Ledger entries with ``kept`` under a policy."""
    return entries.withColumn("kept", ~rejected(policy))


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, fail it alone, and are kept
    without it. The documents are first counted by bit pattern (at most one row per
    set of rules), all else is bit arithmetic on those rows."""
    patterns = entries.groupBy("failed").agg(F.count("*").alias("docs"))
    rules = [(r, 1 << list(RULES).index(r)) for r in sorted(set(policy.rules), key=list(RULES).index)]
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(b).cast("long").alias("bit")) for r, b in rules]))
    counted = patterns.select("failed", "docs", each.alias("r")).select("failed", "docs", "r.*")
    own = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long"))
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("docs"))), F.lit(0))
    return counted.groupBy("rule", "bit").agg(
        total(own.bitwiseAND(F.col("bit")) != 0).alias("fail"),
        total(own == F.col("bit")).alias("fail_alone"),
        total(own.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("kept_without"),
    )


def keep_good(docs: DataFrame, policy: Policy = PROSE) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, all columns as they are."""
    # the verdict rides along as a column computed from the row itself; no join
    columns = docs.columns
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col("text").alias("_body"))
    judged = apply(ledger(carried, "_row", "_body"), policy)
    # a filter on a row's number stays above the measurements; moved below them it would
    # repeat each of them wherever a rule names it
    placed = judged.withColumn("_at", F.monotonically_increasing_id())
    return placed.filter("kept and _at >= 0").select(*[F.col("doc_id").getField(c).alias(c) for c in columns])


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
    SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM t
),
g AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3
),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times FROM g),
c AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM h WHERE times > 1) GROUP BY doc_id
),
m AS (
    SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (length(text) - length(replace(text, '!', '')))::BIGINT AS n_exclamations,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN c USING (doc_id)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND 2 * n_exclamations <= n_words AS kept
FROM b
"""
