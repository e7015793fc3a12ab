"""Periodic stretches of words, solved in tiles of the scale of their period.

A run is a stretch of words with smallest period q, of ``LEAST_WORDS`` words and
``LEAST_TURNS`` periods or more, that no neighbouring word extends with that period.

1. Tiles. Per octave of periods [s, 2s) a document is cut at every s-th word. Around such
   a border lie 2s words before and 4s words behind it, so tiles overlap, and a run of
   the octave holds two neighbouring borders or more whose next s words recur one period
   on. All other tiles are dropped by comparing hashes, and so are those that lie in a run
   already found whose period divides theirs; the rest are solved by themselves. Two Z-functions from the border give, for every period of the octave, how
   far the words around it repeat after one period, forward and back.
2. Fragments. Each solved tile hands on (document, period, part that repeats). They are
   shuffled by document and period and stitched where they overlap; a stretch with several
   periods keeps the smallest.
3. Runs meet the words of their documents again, which only documents with a fragment
   have sent.

A fragment is left out where its words also have a smaller period that divides its own;
then all of the run has it. Words are compared as they are; hashes only pick tiles.

Null and empty texts have no words and no runs. Rows with equal or null ids are documents
of their own. An empty table gives no rows. Only the two named columns are read. One
document's words are held by one task, its fragments and runs by none.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vicinity.llm.common import pieces, written
from vicinity.llm.hashing import mix

LEAST_WORDS = 6
LEAST_TURNS = 4
PIECE_BYTES = 1 << 20  # text that is tiled at once

#: Changes a document's words before they are searched: (id or None, words) to words.
Edit = Callable[[int | None, list[bytes]], list[bytes]]
#: What is handed on of a document's collapsed words, such as a digest of them.
Finish = Callable[[bytes], bytes]


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, as UTF-8."""
    return text.encode().split() if text else []


# --- 1. tiles ----------------------------------------------------------------------


def z_function(s: list[int]) -> list[int]:
    """Length of the common prefix of ``s`` and each of its suffixes."""
    n = len(s)
    z = [0] * n
    if not n:
        return z
    z[0], left, right = n, 0, 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] if n > 1 else found


def solve_tile(words: list[int], border: int, scale: int, periods: list[int]) -> Iterator[tuple[int, int, int]]:
    """(period, start, end): from start to end each word equals that one period on."""
    low = max(0, border - 2 * scale)
    ahead = z_function(words[border : border + 4 * scale])
    before = words[low:border][::-1]
    around = words[low : border + 2 * scale][::-1]
    behind = z_function([*before, -1, *around])[len(before) + 1 :]
    # ``around`` starts where the tile ends, which may be the end of the document
    reach = len(around) - len(before)

    def back(q: int) -> int:
        return behind[reach - q] if q <= reach else 0

    for q in periods:
        forth, to_back = ahead[q], back(q)
        if forth + to_back < q:
            continue
        divided = False
        for f in prime_factors(q):
            p = q // f
            if back(p) >= to_back and ahead[p] >= forth + q - p:
                divided = True
                break
        if not divided:
            yield q, border - to_back, border + forth


def busy_tiles(ids: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """Per octave: its scale, the borders whose next ``scale`` words recur at a period of
    the octave, beside another such border, and these periods. ``ids``: words of documents
    one after another, a value of its own between them."""
    scale, blocks = 1, mix(ids.view(np.uint64))
    while LEAST_TURNS * scale <= longest and len(blocks):
        # blocks[i] stands for the ``scale`` words from i on
        rows = -(-len(blocks) // scale)
        padded = np.arange(rows * scale, dtype=np.uint64)  # unlike any block, but by chance
        padded[: len(blocks)] = blocks
        table = padded.reshape(rows, scale)
        same = table[1:] == table[:-1, :1]
        # a run repeats at least three periods, so two borders side by side or more
        beside = np.zeros_like(same)
        beside[:-1] |= same[1:]
        beside[1:] |= same[:-1]
        row, period = np.nonzero(same & beside)
        if len(row):
            edges = np.flatnonzero(np.diff(row, prepend=-1))
            yield scale, row[edges] * scale, np.split(period + scale, edges[1:])
        a, b = blocks[: max(0, len(blocks) - scale)], blocks[scale:]
        blocks = mix(a * np.uint64(0xD6E8FEB86659FD93) + mix(b ^ np.uint64(0x9E3779B97F4A7C15)))
        scale *= 2


def fragments_of(docs: list[list[bytes]]) -> dict[int, list[tuple[int, int, int]]]:
    """Fragments (period, start, end) by document number."""
    sizes = np.array([len(d) for d in docs], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ids = np.empty(int((sizes + 1).sum()), np.int64)
    for start, words in zip(starts.tolist(), docs, strict=True):
        ids[start : start + len(words)] = np.fromiter(map(hash, words), np.int64, len(words))
    ends = starts + sizes
    ids[ends] = mix(np.arange(len(docs), dtype=np.uint64)).view(np.int64)
    numbered: dict[int, list[int]] = {}
    found: dict[int, list[tuple[int, int, int]]] = {}
    spans: dict[int, list[list[int]]] = {}
    for scale, borders, periods_at in busy_tiles(ids, int(sizes.max(initial=0))):
        owners = np.searchsorted(starts, borders, "right") - 1
        places = (borders - starts[owners]).tolist()
        for doc, at, size, periods in zip(owners.tolist(), places, sizes[owners].tolist(), periods_at, strict=True):
            if LEAST_TURNS * scale > size:
                continue
            low, high = max(0, at - 2 * scale), min(size, at + 4 * scale)
            inside = [p for p, start, stop in spans.get(doc, ()) if start <= low and high <= stop + p]
            asked = [q for q in periods.tolist() if q < size - at and not any(q % p == 0 and q > p for p in inside)]
            if not asked:
                continue
            if doc not in numbered:
                known: dict[bytes, int] = {}
                numbered[doc] = [known.setdefault(w, len(known)) for w in docs[doc]]
            for fragment in solve_tile(numbered[doc], at, scale, asked):
                found.setdefault(doc, []).append(fragment)
                extend(spans.setdefault(doc, []), *fragment)
    return {doc: kept for doc, f in found.items() if (kept := likely(f))}


def extend(spans: list[list[int]], period: int, start: int, stop: int) -> None:
    """Join a fragment to the last one of its period, if they overlap."""
    for span in reversed(spans):
        if span[0] == period:
            if start <= span[2]:
                span[2] = max(span[2], stop)
                return
            break
    spans.append([period, start, stop])


def likely(fragments: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those whose period has fragments that reach far enough for a run."""
    low: dict[int, int] = {}
    high: dict[int, int] = {}
    for q, start, stop in fragments:
        low[q], high[q] = min(start, low.get(q, start)), max(stop, high.get(q, stop))
    far = {q for q in low if high[q] - low[q] >= max(LEAST_WORDS, LEAST_TURNS * q) - q}
    return [f for f in fragments if f[0] in far]


SOLVED = (
    "doc long, doc_id long, n_words long, plain binary, words binary, "
    "fragments array<struct<period: long, start: long, stop: long>>"
)


def solve(docs: DataFrame, edit: Edit | None, finish: Finish) -> DataFrame:
    """(doc, doc_id, text): the words joined by one space, finished, as ``plain`` where no
    fragment was found, else as ``words`` with the fragments."""
    fragment = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            ids = batch.column(1).to_pylist()
            docs = [words_of(t) for t in batch.column(2).to_pylist()]
            if edit:
                docs = [edit(i, w) for i, w in zip(ids, docs, strict=True)]
            found = fragments_of(docs)
            joined = [b" ".join(w) for w in docs]
            kept = [found.get(i) for i in range(len(docs))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(w) for w in docs], pa.int64()),
                    pa.array([None if f else finish(j) for f, j in zip(kept, joined, strict=True)], pa.binary()),
                    pa.array([j if f else None for f, j in zip(kept, joined, strict=True)], pa.binary()),
                    pa.array([f and [dict(zip(("period", "start", "stop"), x)) for x in f] for f in kept], fragment),
                ],
                names=["doc", "doc_id", "n_words", "plain", "words", "fragments"],
            )

    return docs.mapInArrow(run, SOLVED)


# --- 2. fragments ------------------------------------------------------------------


def stitch(fragments: DataFrame) -> DataFrame:
    """(doc, period, start, stop) to the runs (doc, start, length, period)."""
    order = Window.partitionBy("doc", "period").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > before, F.lit(True)).cast("int")
    pieces_of = fragments.withColumn("opens", opens).withColumn("part", F.sum("opens").over(order))
    stretch = pieces_of.groupBy("doc", "period", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    sized = stretch.withColumn("length", F.col("stop") - F.col("start") + F.col("period"))
    long_enough = (F.col("length") >= LEAST_WORDS) & (F.col("length") >= LEAST_TURNS * F.col("period"))
    return sized.filter(long_enough).groupBy("doc", "start", "length").agg(F.min("period").alias("period"))


# --- 3. documents ------------------------------------------------------------------


def repeat_by_checksum(doc: int | None, words: list[bytes]) -> list[bytes]:
    """Makes the rest of some documents periodic, from a place and with a period that the
    crc32 of the id in decimals gives; documents without an id stay as they are."""
    n = len(words)
    g, last = divmod(zlib.crc32(str(doc).encode()), 10)
    if doc is None or last or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    turns = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * turns)[: n - a]


def collapse(words: list[bytes], runs: list[dict]) -> bytes:
    """The words, each run with its first period only."""
    gone = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        gone[r["start"] + r["period"]] += 1
        gone[r["start"] + r["length"]] -= 1
    dropped = np.cumsum(gone[:-1]) > 0
    return b" ".join([w for w, d in zip(words, dropped.tolist(), strict=True) if not d])


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Edit | None = None, finish: Finish = bytes
) -> DataFrame:
    """doc_id, n_words, runs (array of start, period, length by start, then period) and
    collapsed (the words that stay, joined by one space, UTF-8, finished) of every row."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("doc"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    )
    solved = written(solve(numbered, edit, finish), "solved-tiles")
    each = solved.filter("fragments is not null").select("doc", F.explode("fragments").alias("f"))
    runs = stitch(each.select("doc", "f.period", "f.start", "f.stop"))
    per_doc = runs.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    busy = solved.filter("words is not null").select("doc", "doc_id", "n_words", "words")
    kind = "array<struct<start: long, period: long, length: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, found = batch.column(2), batch.column(3)
            out = [
                finish(collapse(w.as_py().split(), r.as_py()) if r.is_valid else w.as_py())
                for w, r in zip(words, found, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), found, pa.array(out, pa.binary())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    held = busy.join(per_doc.hint("merge"), "doc", "left").select("doc_id", "n_words", "words", "runs")
    collapsed = held.mapInArrow(run, f"doc_id long, n_words long, runs {kind}, collapsed binary")
    plain = solved.filter("words is null").select(
        "doc_id", "n_words", F.lit(None).cast(kind).alias("runs"), F.col("plain").alias("collapsed")
    )
    return plain.unionByName(collapsed).withColumn("runs", F.coalesce("runs", F.array().cast(kind)))
