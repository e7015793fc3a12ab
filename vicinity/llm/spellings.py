"""Spelling variants of words, found among sorted permuterm rotations.

Two words are near if they differ by exactly one inserted, deleted or replaced
character. A word is marked with a terminator and rotated to every place. The rotation
that ends in the edited character, without that character, is the same for both words
of a replacement; and it is a whole rotation of the shorter word of an insertion. So every
word gives, per character, a key with that character left out, and, per rotation, a key
with nothing left out. All keys are sorted over the whole cluster, and words with a key
in common stand together:

* words that left a character out are near each other (a replacement),
* the one word that left nothing out is near those (an insertion), counted only
  where the character is the first of a run of equal ones, so that each pair comes once.

A key tells the place of the edit, so a group has one word per character at most: no
group grows with the table, whatever is frequent in it. Keys of more than ``PLAIN``
characters travel as 127-bit hashes, whose sums are carried along a word, so that a word
of a million letters costs a million steps.

A word's form is its most frequent near word (ties: smallest in code-point order) if
that has ``factor`` times its occurrences or more; its root follows forms to the last.
Occurrences grow by the factor at each step, so chains are short; they are halved by
joins until nothing moves.

Words are runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of the whole texts, A-Z in
lower case. Null and empty texts have none. ``edits`` may change the runs of a document
before they are counted. An empty table gives no rows. Only the two named columns are
read; equal and null ids are allowed.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vicinity.llm.common import written

#: For a document's id (or None): what changes a run, both in Latin-1, before it is counted.
Edit = Callable[[int | None], Callable[[bytes], bytes]]

TERMINATOR = "$"
PLAIN = 128  # characters of a key that travels as it is
HELD_WORDS, HELD_BYTES = 1 << 17, 1 << 24  # counts that a task holds before it hands them on
_MODULUS = (1 << 127) - 1
_BASE = 0x5DEECE66D1CE4E5B9BF58476D1CE4E5B

# one byte per character: letters in lower case (A-Z only), all else blank
_LETTERS = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b) if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)


def runs_of(text: str) -> list[bytes]:
    """Runs of letters, in lower case, in Latin-1; characters beyond it become '?'."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def drop_by_checksum(divisor: int) -> Edit:
    """Deletes a character of the runs whose checksum with the document's id ``divisor``
    divides: the crc32 of ``<id>:<run>`` in UTF-8 gives both. A null id is written as an
    empty string."""

    def of(doc: int | None) -> Callable[[bytes], bytes]:
        begun = zlib.crc32(f"{'' if doc is None else doc}:".encode())

        def edit(run: bytes) -> bytes:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), begun)
            if h % divisor:
                return run
            at = h % len(run)
            return run[:at] + run[at + 1 :]

        return edit

    return of


def count_words(
    docs: DataFrame, id_col: str, text_col: str, least_chars: int, least_times: int, edit: Edit | None = None
) -> DataFrame:
    """word, n of words of ``least_chars`` and ``least_times`` or more. Each task counts
    what it reads before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        size = 0

        def handed() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                found = Counter(w for w in runs_of(text.as_py() or "") if len(w) >= least_chars)
                change = edit(doc.as_py()) if edit else None
                for word, n in found.items():
                    word = change(word) if change else word
                    if len(word) >= least_chars:
                        if word not in held:
                            size += len(word)
                        held[word] += n
                if len(held) > HELD_WORDS or size > HELD_BYTES:
                    yield handed()
                    held, size = Counter(), 0
        yield handed()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_times)


def rotations(word: str) -> Iterator[tuple[str, bool, bool]]:
    """(key, whether nothing is left out, whether the character left out opens a run of
    equal ones) of every rotation of a marked word."""
    n = len(word)
    for i in range(n):
        yield word[i + 1 :] + TERMINATOR + word[:i], False, i == 0 or word[i] != word[i - 1]
    for i in range(n + 1):
        yield word[i:] + TERMINATOR + word[:i], True, False


def hashed_rotations(word: str) -> Iterator[tuple[str, bool, bool]]:
    """``rotations`` with keys hashed: the sum of characters times powers of a base, from
    running sums of the word. The place of the terminator goes with it."""
    n = len(word)
    power, sums = [1] * (n + 2), [0] * (n + 1)
    for i, c in enumerate(word):
        sums[i + 1] = (sums[i] * _BASE + ord(c)) % _MODULUS
        power[i + 1] = power[i] * _BASE % _MODULUS
    power[n + 1] = power[n] * _BASE % _MODULUS
    end = ord(TERMINATOR)

    def key(start: int, stop: int) -> str:  # word[start:] + terminator + word[:stop]
        behind = (sums[n] - sums[start] * power[n - start]) % _MODULUS
        whole = ((behind * _BASE + end) * power[stop] + sums[stop]) % _MODULUS
        return f"{TERMINATOR}{n - start + 1 + stop}:{n - start}:{whole:x}"

    for i in range(n):
        yield key(i + 1, i), False, i == 0 or word[i] != word[i - 1]
    for i in range(n + 1):
        yield key(i, i), True, False


def rotated(words: DataFrame) -> DataFrame:
    """(id, n, word) to a row per key of each word. Keys of a word are one as long as the
    word or one longer, so words near each other always agree on the form of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "whole", "first", "id", "n"]
        for batch in batches:
            rows: list[tuple] = []
            for i, n, word in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                plain = rotations(word) if len(word) <= PLAIN else ()
                hashed = hashed_rotations(word) if len(word) >= PLAIN else ()
                # a key of PLAIN characters or fewer is plain: left out by words of that
                # many characters, whole in words of one less
                rows += [(k, w, f, i, n) for k, w, f in plain if len(k) <= PLAIN]
                for k, w, f in hashed:
                    if len(word) + w > PLAIN:
                        rows.append((k, w, f, i, n))
                    if len(rows) >= 1 << 16:
                        yield _batch(rows, names)
                        rows = []
                if len(rows) >= 1 << 16:
                    yield _batch(rows, names)
                    rows = []
            if rows:
                yield _batch(rows, names)

    return words.select("id", "n", "word").mapInArrow(run, "key string, whole boolean, first boolean, id long, n long")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n, word) to id, n_near, best (the id of the most frequent near word, of those
    the smallest), best_n; words without a near word don't appear. Ids rise with words."""
    keys = rotated(words)
    # sorted by key over all tasks; equal keys are in one task, a word per character at most
    together = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "id", "whole", "first")))
    groups = keys.repartitionByRange("key").groupBy("key").agg(together.alias("m")).filter("size(m) > 1")

    def near(a, b):
        return (~a["whole"] & ~b["whole"] & (a["id"] != b["id"])) | (a["whole"] & b["first"]) | (b["whole"] & a["first"])

    each = groups.select(
        F.explode(
            F.transform(
                "m", lambda a: F.struct(a["id"].alias("id"), F.filter("m", lambda b: near(a, b)).alias("others"))
            )
        ).alias("e")
    ).select("e.id", F.size("e.others").alias("k"), F.get("e.others", F.lit(0)).alias("o"))
    best = F.min(F.struct("o.less", "o.id"))
    found = each.filter("k > 0").groupBy("id").agg(F.sum("k").alias("n_near"), best.alias("best"))
    return found.select("id", "n_near", F.col("best.id").alias("best"), (-F.col("best.less")).alias("best_n"))


def variants(words: DataFrame, factor: int = 10) -> DataFrame:
    """(word, n), words distinct, to word, n, n_near, form, form_n, root."""
    # ids rise with the words' order by code points, and are written once
    numbered = words.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n")
    numbered = written(numbered, "words")
    near = written(neighbours(numbered), "near-words")
    has_form = F.col("best_n") >= factor * F.col("n")
    linked = numbered.join(near, "id", "left").select(
        "id",
        "n",
        "word",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(has_form, F.col("best")).alias("form_id"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    linked = written(linked, "linked-words")
    # few words have a form; joins on null keys would meet in one task
    formed = linked.filter("form_id is not null").select("id", "form_id", "form_n")
    last = follow(formed.select("id", F.col("form_id").alias("to")))
    form, root = (numbered.select(F.col("id").alias(i), F.col("word").alias(w)) for i, w in (("form_id", "form"), ("to", "root")))
    named = formed.join(form, "form_id").join(last, "id").join(root, "to").select("id", "form", "form_n", "root")
    every = linked.select("id", "word", "n", "n_near").join(named, "id", "left")
    return every.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def follow(steps: DataFrame) -> DataFrame:
    """(id, to) to (id, last): each round every step skips to where its end leads."""
    now = written(steps, "steps")
    while True:
        then = now.select(F.col("id").alias("to"), F.col("to").alias("further"))
        led = now.join(then, "to", "left").withColumn("moved", F.col("further").isNotNull())
        led = written(led.select("id", F.coalesce("further", "to").alias("to"), "moved"), "steps")
        now = led.select("id", "to")
        if led.filter("moved").isEmpty():
            return now
