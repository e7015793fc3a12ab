"""Removal of long byte strings that occur twice, by merging sorted suffix runs.

A string of ``length`` bytes is repeated if it also starts anywhere else in the table,
the same text included; every byte under a repeated string is removed. Strings never
cross texts.

1. Anchors. Of the grams of ``length // 2`` bytes in each window of ``length`` bytes the
   one of smallest hash is an anchor, so equal windows have anchors at equal places.
   An anchor whose gram occurs once has no repeated window. One whose whole
   surroundings occur twice (all windows that hold its gram) has only repeated ones.
2. Suffixes. The anchors in between, and one of each kind they could match, send the
   suffix that starts there. Every task sorts its suffixes and sends front-coded runs;
   the receiver merges the runs with a loser tree that compares strings only beyond
   the prefixes known to be common, and gets each suffix with its common prefix.
3. Windows. From common prefixes of the suffixes, and of the bytes to their left read
   backwards, the repeated windows of each anchor follow.

A gram with more suffixes than one merge should take sends no suffixes. Each of its
anchors sends the 64-bit hashes of the windows around it, dealt by their values, and
those that occur twice are repeated.

Null and empty texts and those shorter than ``length`` lose nothing; equal long texts
lose all. Rows with equal or null ids are texts of their own. An empty table gives no
rows. Texts are known by a 64-bit hash; grams by 48 to 64 bits, which only say what is to be
looked at; surroundings and windows of hot grams by 64 bits of a hash of their bytes that
is unrelated to the grams'. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from vicinity.llm.common import pieces, text_bytes, text_sizes, written
from vicinity.llm.hashing import Substrings, mix, ragged
from vicinity.llm.jaccard import joined, pack, unpack

BUCKET_BYTES = 32 << 20  # text behind the anchors of a bucket
PIECE_BYTES = 1 << 19  # text that a task hashes at once
RUN_SUFFIXES = 1 << 16  # suffixes that are merged together, about
HOT_WINDOWS = 1 << 20  # windows that are counted together, about
ONCE, SURE, OPEN, SAMPLE = range(4)  # what is known of an anchor
HOT = 4  # added to OPEN and SAMPLE of a gram with more suffixes than one merge takes


class Anchors:
    """Anchors of texts that stand one after another."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int) -> None:
        gram, wide = length // 2, length - length // 2 + 1
        self.data, self.offsets, self.length, self.gram, self.reach = data, offsets, length, gram, wide - 1
        self.hashes = Substrings(data)
        grams = mix(self.hashes.windows(gram))
        self.at = np.zeros(0, np.int64)
        if len(grams) >= wide:
            bits = np.uint64(max(24, len(grams).bit_length()))
            # equal hashes (of the upper bits) are told apart by place: the leftmost wins
            ranked = grams >> bits << bits | np.arange(len(grams), dtype=np.uint64)
            least = sliding_min(ranked, wide)
            whole = np.zeros(len(least), bool)
            sizes = np.diff(offsets)
            whole[ragged(offsets[:-1][sizes >= length], sizes[sizes >= length] - length + 1)] = True
            self.at = np.unique(least[whole] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        self.text = np.searchsorted(offsets, self.at, "right") - 1
        first = np.searchsorted(self.at, offsets)
        self.ordinal = np.arange(len(self.at)) - first[self.text]
        self.first = first
        self.grams = grams[self.at]

    def surroundings(self, some: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left end, place and right end of the bytes of all windows around anchors."""
        at, text = self.at[some], self.text[some]
        left = np.maximum(self.offsets[text], at - self.reach)
        return left, at, np.minimum(self.offsets[text + 1], at + self.length)

    def around(self) -> np.ndarray:
        """Hash of the surroundings, and of where the gram lies in them. It reads the
        bytes and has nothing in common with the sums that name the gram."""
        left, at, right = self.surroundings()
        body = memoryview(self.data)
        read = (xxhash.xxh3_64_intdigest(body[a:b]) for a, b in zip(left.tolist(), right.tolist(), strict=True))
        found = np.fromiter(read, np.uint64, len(at))
        return mix(found + np.uint64(0x9E3779B97F4A7C15) * (at - left).astype(np.uint64) + (right - at).astype(np.uint64))


def sliding_min(values: np.ndarray, wide: int) -> np.ndarray:
    """The least of each ``wide`` neighbours, by running minima of blocks."""
    n = len(values)
    rows = -(-n // wide)
    padded = np.full(rows * wide, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    block = padded.reshape(rows, wide)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - wide + 1], ahead[wide - 1 : n])


def packed_rows(key: np.ndarray, columns: list[np.ndarray | list], names: list[str]) -> pa.Table:
    """One row per value of ``key`` (sorted), with the packed values of its entries."""
    starts = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(key)) if len(starts) else starts
    out = [pa.array(key[starts], pa.int32())]
    for values in columns:
        out.append(pa.array([values[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()))
    return pa.table(out, names=names)


def binary(*names: str) -> list[StructField]:
    return [StructField(n, BinaryType()) for n in names]


# --- 1. anchors -------------------------------------------------------------------

SENT = StructType([StructField("bucket", IntegerType()), *binary("texts", "members", "ordinals", "grams", "around")])
KNOWN = StructType([StructField("bucket", IntegerType()), *binary("texts", "ordinals", "states")])


def two_copies(keys: np.ndarray, sizes: np.ndarray, length: int, seen: dict[int, int]) -> np.ndarray:
    """Rows that are the first or second copy of their text in this task; ``seen`` counts
    on. Two are enough to make everything in a text repeated. Shorter texts than
    ``length`` have no anchors and aren't counted."""
    some = []
    for i in np.flatnonzero(sizes >= length).tolist():
        times = seen.get(key := int(keys[i]), 0)
        if times < 2:
            seen[key] = times + 1
            some.append(i)
    return np.array(some, np.int64)


def send_anchors(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """Anchors of at most two copies of a text per task, whatever their number, so that
    no bucket grows with the copies of one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in pieces(batches, "text", PIECE_BYTES):
            some = two_copies(batch.column(0).to_numpy(zero_copy_only=False), text_sizes(batch.column(1)), length, seen)
            if not len(some):
                continue
            batch = batch.take(pa.array(some))
            found = Anchors(*text_bytes(batch.column(1)), length)
            if not len(found.at):
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            # anchors have small hashes; only their lower bits are spread evenly
            low = found.grams & np.uint64(0xFFFFFFFF)
            bucket = (low * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            around, rows = found.around(), [[] for _ in SENT.names]
            starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for a, b in zip(starts, np.append(starts[1:], len(order))):
                some = order[a:b]
                held, member = np.unique(found.text[some], return_inverse=True)
                values = (
                    int(bucket[some[0]]),
                    keys[held].astype("<i8").tobytes(),
                    member.astype("<u4").tobytes(),
                    found.ordinal[some].astype("<u4").tobytes(),
                    pack(found.grams[some]),
                    around[some].astype("<u8").tobytes(),
                )
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            kinds = (pa.int32(), *[pa.binary()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=SENT.names)

    return texts.mapInArrow(run, SENT)


def judge_anchors(sent: DataFrame, text_buckets: int, most: int = RUN_SUFFIXES) -> DataFrame:
    """What equal grams and equal surroundings say of each anchor; a gram that more than
    ``most`` anchors ask about is hot."""

    def run(table: pa.Table) -> pa.Table:
        keys, at = [], 0
        members = joined(table, "members", "<u4").astype(np.int64)
        for texts, some in zip(table.column("texts").to_pylist(), table.column("members").to_pylist(), strict=True):
            n = len(some) // 4
            keys.append(np.frombuffer(texts, "<i8")[members[at : at + n]])
            at += n
        key, ordinal = np.concatenate(keys), joined(table, "ordinals", "<u4")
        gram = np.concatenate([unpack(g) for g in table.column("grams").to_pylist()])
        around = joined(table, "around", "<u8")
        order = np.lexsort((around, gram))
        gram, around = gram[order], around[order]
        new_gram = np.ones(len(order), bool)
        new_gram[1:] = gram[1:] != gram[:-1]
        new_kind = new_gram.copy()
        new_kind[1:] |= around[1:] != around[:-1]
        kinds = np.flatnonzero(new_kind)
        alone = np.repeat(np.diff(kinds, append=len(order)) == 1, np.diff(kinds, append=len(order)))
        group = np.cumsum(new_gram) - 1
        size = np.bincount(group)
        some_alone = np.bincount(group, alone) > 0
        state = np.where(alone, OPEN, np.where(new_kind & some_alone[group], SAMPLE, SURE))
        state[size[group] == 1] = ONCE
        asking = state >= OPEN
        state[asking & (np.bincount(group, asking) > most)[group]] += HOT
        keep = np.flatnonzero(state)
        key, ordinal, state = key[order[keep]], ordinal[order[keep]], state[keep].astype(np.uint8)
        bucket = (key.view(np.uint64) % np.uint64(text_buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        return packed_rows(bucket[order], [key[order], ordinal[order], state[order]], KNOWN.names)

    return sent.groupBy("bucket").applyInArrow(run, KNOWN)


TEXTS = StructType([StructField("key", LongType()), *binary("ordinals", "states"), StructField("asks", LongType()), StructField("hot", LongType())])


def per_text(known: DataFrame) -> DataFrame:
    """A row per text: its anchors that aren't unique, and how many send a suffix
    or, of hot grams, windows."""

    def run(table: pa.Table) -> pa.Table:
        key, ordinal, state = joined(table, "texts", "<i8"), joined(table, "ordinals", "<u4"), joined(table, "states", "u1")
        order = np.lexsort((-state.astype(np.int16), ordinal, key))
        key, ordinal, state = key[order], ordinal[order], state[order]
        new = np.ones(len(key), bool)  # copies of a text report alike
        new[1:] = (key[1:] != key[:-1]) | (ordinal[1:] != ordinal[:-1])
        key, ordinal, state = key[new], ordinal[new], state[new]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(key)) if len(starts) else starts
        asks = np.concatenate([[0], np.cumsum((state >= OPEN) & (state < HOT))])
        hot = np.concatenate([[0], np.cumsum(state >= HOT)])
        return pa.table(
            [
                pa.array(key[starts]),
                pa.array([ordinal[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                pa.array([state[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                pa.array(asks[ends] - asks[starts], pa.int64()),
                pa.array(hot[ends] - hot[starts], pa.int64()),
            ],
            names=TEXTS.names,
        )

    return known.groupBy("bucket").applyInArrow(run, TEXTS)


# --- 2. runs of suffixes ----------------------------------------------------------


def common(x: bytes, y: bytes, known: int) -> int:
    """Length of the common prefix; the first ``known`` bytes are known to be equal."""
    n = min(len(x), len(y))
    differ = int.from_bytes(x[known:n], "big") ^ int.from_bytes(y[known:n], "big")
    return n if not differ else n - (differ.bit_length() + 7) // 8


def front_code(ordered: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Common prefix with the string before, and what follows it."""
    shared = [0, *(common(x, y, 0) for x, y in zip(ordered, ordered[1:]))][: len(ordered)]
    return shared, [s[n:] for s, n in zip(ordered, shared, strict=True)]


def decode_front(shared: list[int], tails: list[bytes]) -> list[bytes]:
    out, last = [], b""
    for n, tail in zip(shared, tails, strict=True):
        last = last[:n] + tail
        out.append(last)
    return out


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, int]]:
    """Merge front-coded sorted runs: (run, place in it, common prefix with the string
    before) of each string in order.

    A loser tree in which every string carries the length of the prefix it shares with
    the last winner. Unequal lengths decide without looking at the strings; equal ones
    compare them from there on. A run's next string brings its length along."""
    runs_of = [decode_front(*run) for run in runs]
    heads: list[bytes | None] = [r[0] if r else None for r in runs_of]
    shared, place = [0] * len(runs), [0] * len(runs)

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        n = common(x, y, shared[a])
        winner, loser = (a, b) if x[n:] < y[n:] or (x[n:] == y[n:] and a < b) else (b, a)
        shared[loser] = n
        return winner, loser

    size = 1
    while size < len(runs):
        size *= 2
    for _ in range(size - len(runs)):
        heads.append(None)
        shared.append(0)
    losers, winners = [0] * size, [0] * (2 * size)
    for i in range(size):
        winners[size + i] = i
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1]
    while heads[top] is not None:
        yield top, place[top], shared[top]
        place[top] += 1
        ended = place[top] == len(runs_of[top])
        heads[top] = None if ended else runs_of[top][place[top]]
        shared[top] = 0 if ended else runs[top][0][place[top]]
        node = (size + top) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


RUNS = StructType(
    [
        StructField("bucket", IntegerType()),
        *binary("texts", "ordinals", "shared", "sizes", "tails", "left_sizes", "lefts"),
        *binary("backs", "windows"),
    ]
)


def windows_around(found: Anchors, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, bytes before it, and hash of each window around some anchors. The bytes
    before are hashed too: a window is compared by the same of its anchors everywhere."""
    left, at, right = found.surroundings(some)
    back = np.arange(found.reach + 1)
    begin = at[:, None] - back
    row, before = np.nonzero((begin >= left[:, None]) & (begin + found.length <= right[:, None]))
    begin, body, n = begin[row, before], memoryview(found.data), found.length
    read = np.fromiter((xxhash.xxh3_64_intdigest(body[b : b + n]) for b in begin.tolist()), np.uint64, len(begin))
    return some[row], before, mix(read + np.uint64(0x9E3779B97F4A7C15) * before.astype(np.uint64))


def send_runs(asking: DataFrame, length: int, buckets: int, hot_buckets: int = 0) -> DataFrame:
    """(key, text, ordinals, states) to sorted front-coded runs, one per bucket, and to
    the windows of hot grams in the ``hot_buckets`` that follow."""

    def hot_rows(found: Anchors, names: np.ndarray, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(hot), 4096):
            anchor, before, window = windows_around(found, hot[low : low + 4096])
            bucket = ((window >> np.uint64(32)) * np.uint64(hot_buckets) >> np.uint64(32)).astype(np.int32) + buckets
            order = np.argsort(bucket, kind="stable")
            anchor, before, window, bucket = anchor[order], before[order], window[order], bucket[order]
            values = (names[found.text[anchor]], found.ordinal[anchor].astype("<u4"), before.astype("<u4"), window)
            held = packed_rows(bucket, list(values), ["bucket", "texts", "ordinals", "backs", "windows"])
            nothing = pa.nulls(held.num_rows, pa.binary())
            columns = [held.column(n) if n in held.column_names else nothing for n in RUNS.names]
            yield from pa.table(columns, names=RUNS.names).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in pieces(batches, "text", PIECE_BYTES):
            keys = batch.column(0).to_pylist()
            # the join has sorted by key: copies of a text stand together, one will do
            some = [i for i, k in enumerate(keys) if k != (keys[i - 1] if i else last)]
            last = keys[-1]
            if not some:
                continue
            batch = batch.take(pa.array(some))
            data, offsets = text_bytes(batch.column(1))
            found = Anchors(data, offsets, length)
            ordinals = [np.frombuffer(o, "<u4") for o in batch.column(2).to_pylist()]
            states = [np.frombuffer(s, "u1") for s in batch.column(3).to_pylist()]
            chosen = np.concatenate([found.first[i] + o[(s >= OPEN) & (s < HOT)] for i, (o, s) in enumerate(zip(ordinals, states, strict=True))])
            hot = np.concatenate([found.first[i] + o[s >= HOT] for i, (o, s) in enumerate(zip(ordinals, states, strict=True))])
            yield from hot_rows(found, np.array(batch.column(0).to_pylist(), "<i8"), hot)
            left, at, right = found.surroundings(chosen)
            body = data.tobytes()
            suffixes = [body[a:b] for a, b in zip(at.tolist(), right.tolist(), strict=True)]
            lefts = [body[a:b] for a, b in zip(left.tolist(), at.tolist(), strict=True)]
            bucket = (found.grams[chosen] % np.uint64(buckets)).astype(np.int64).tolist()
            order = sorted(range(len(chosen)), key=lambda i: (bucket[i], suffixes[i]))
            names = np.array(batch.column(0).to_pylist(), "<i8")[found.text[chosen]]
            rows: list[list] = [[] for _ in RUNS.names]
            edges = np.flatnonzero(np.diff([bucket[i] for i in order], prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(order))):
                mine = order[a:b]
                shared, tails = front_code([suffixes[i] for i in mine])
                values = (
                    bucket[mine[0]],
                    names[mine].tobytes(),
                    found.ordinal[chosen[mine]].astype("<u4").tobytes(),
                    np.array(shared, "<u4").tobytes(),
                    np.array([len(t) for t in tails], "<u4").tobytes(),
                    b"".join(tails),
                    np.array([len(lefts[i]) for i in mine], "<u4").tobytes(),
                    b"".join(lefts[i] for i in mine),
                    None,
                    None,
                )
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            kinds = (pa.int32(), *[pa.binary()] * 9)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=RUNS.names)

    return asking.mapInArrow(run, RUNS)


def strings(sizes: bytes, data: bytes) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(sizes, "<u4")).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


# --- 3. windows -------------------------------------------------------------------


def repeated_windows(
    shared: np.ndarray, right_sizes: np.ndarray, lefts: list[bytes], length: int, reach: int
) -> np.ndarray:
    """Row i, column l: whether the window that starts l bytes before suffix i is
    repeated. ``shared``: common prefix with the suffix before, in sorted order."""
    n = len(lefts)
    back = [s[::-1] for s in lefts]
    left_sizes = np.array([len(s) for s in lefts], np.int64)
    order = np.array(sorted(range(n), key=back.__getitem__), np.int64)
    chars = np.zeros((n, reach + 1), np.uint8)
    for k, i in enumerate(order):
        chars[k, : len(back[i])] = np.frombuffer(back[i], np.uint8)
    differ = np.ones((n, reach + 1), bool)
    differ[1:, :reach] = chars[1:, :reach] != chars[:-1, :reach]
    same = differ.argmax(axis=1)
    same[1:] = np.minimum(same[1:], np.minimum(left_sizes[order[1:]], left_sizes[order[:-1]]))
    same[:1] = -1
    shared = shared.copy()
    shared[:1] = -1
    out = np.zeros((n, reach + 1), bool)
    for l in range(reach + 1):  # noqa: E741
        valid = np.flatnonzero((left_sizes >= l) & (right_sizes >= length - l))
        if len(valid) < 2:
            continue
        ahead = np.cumsum(shared < length - l)
        behind = np.empty(n, np.int64)
        behind[order] = np.cumsum(same < l)
        _, number, times = np.unique(ahead[valid] * (n + 1) + behind[valid], return_inverse=True, return_counts=True)
        out[valid, l] = times[number] > 1
    return out


MARKS = StructType([StructField("bucket", IntegerType()), *binary("texts", "ordinals", "masks")])


def or_masks(key: np.ndarray, ordinal: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One mask per anchor, sorted by text and anchor."""
    if not len(key):
        return key, ordinal, masks
    order = np.lexsort((ordinal, key))
    key, ordinal, masks = key[order], ordinal[order], masks[order]
    new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (ordinal[1:] != ordinal[:-1])))
    return key[new], ordinal[new], np.bitwise_or.reduceat(masks, new, axis=0)


def merge_and_judge(runs: DataFrame, length: int, text_buckets: int, run_buckets: int) -> DataFrame:
    """Repeated windows per anchor, of runs and, in the buckets after them, of hot grams."""
    reach = length - length // 2
    wide = (reach + 1 + 7) // 8

    def count(table: pa.Table) -> pa.Table:
        window = joined(table, "windows", "<u8")
        order = np.argsort(window)
        same = window[order][1:] == window[order][:-1]
        some = order[np.append(same, False) | np.append(False, same)]
        key, ordinal = joined(table, "texts", "<i8")[some], joined(table, "ordinals", "<u4")[some]
        back = joined(table, "backs", "<u4")[some]
        masks = np.zeros((len(some), wide), np.uint8)
        masks[np.arange(len(some)), back >> 3] = 1 << (back & 7)
        key, ordinal, masks = or_masks(key, ordinal, masks)
        bucket = (key.view(np.uint64) % np.uint64(text_buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        return packed_rows(bucket[order], [key[order], ordinal[order], masks[order]], MARKS.names)

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() >= run_buckets:
            return count(table)
        rows = table.to_pylist()
        coded = [(np.frombuffer(r["shared"], "<u4").tolist(), strings(r["sizes"], r["tails"])) for r in rows]
        merged = np.array(list(merge_runs(coded)), np.int64).reshape(-1, 3)
        sizes = np.array([len(r["ordinals"]) // 4 for r in rows], np.int64)
        place = (np.cumsum(sizes) - sizes)[merged[:, 0]] + merged[:, 1]
        key = np.frombuffer(b"".join(r["texts"] for r in rows), "<i8")[place]
        ordinal = np.frombuffer(b"".join(r["ordinals"] for r in rows), "<u4")[place]
        right = np.concatenate([np.array(s, np.int64) + [len(t) for t in tails] for s, tails in coded])[place]
        lefts = [x for r in rows for x in strings(r["left_sizes"], r["lefts"])]
        windows = repeated_windows(merged[:, 2], right, [lefts[i] for i in place], length, reach)
        some = np.flatnonzero(windows.any(axis=1))
        bucket = (key[some].view(np.uint64) % np.uint64(text_buckets)).astype(np.int32)
        some = some[np.argsort(bucket, kind="stable")]
        masks = np.packbits(windows[some], axis=1, bitorder="little")
        return packed_rows(np.sort(bucket, kind="stable"), [key[some], ordinal[some], masks], MARKS.names)

    return runs.groupBy("bucket").applyInArrow(run, MARKS)


MARKED = StructType([StructField("key", LongType()), *binary("ordinals", "masks")])


def marks_of(texts: DataFrame, marks: DataFrame, length: int, text_buckets: int) -> DataFrame:
    """A row per text: anchors with repeated windows, and which. ``texts`` bring the
    anchors all of whose windows are repeated."""
    wide = (length - length // 2 + 1 + 7) // 8

    def sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in MARKS.names]
            for key, ordinals, states in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                state = np.frombuffer(states, "u1") % HOT
                chosen = np.frombuffer(ordinals, "<u4")[(state == SURE) | (state == SAMPLE)]
                if len(chosen):
                    for column, value in zip(
                        rows,
                        (
                            int(np.uint64(key & (2**64 - 1)) % np.uint64(text_buckets)),
                            np.full(len(chosen), key, "<i8").tobytes(),
                            chosen.tobytes(),
                            b"\xff" * (wide * len(chosen)),
                        ),
                        strict=True,
                    ):
                        column.append(value)
            kinds = (pa.int32(), *[pa.binary()] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=MARKS.names)

    def run(table: pa.Table) -> pa.Table:
        key, ordinal = joined(table, "texts", "<i8"), joined(table, "ordinals", "<u4")
        key, ordinal, masks = or_masks(key, ordinal, joined(table, "masks", "u1").reshape(-1, wide))
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(key)) if len(starts) else starts
        return pa.table(
            [
                pa.array(key[starts]),
                pa.array([ordinal[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                pa.array([masks[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
            ],
            names=MARKED.names,
        )

    both = texts.mapInArrow(sure, MARKS).unionByName(marks)
    return both.groupBy("bucket").applyInArrow(run, MARKED)


def removed_bytes(found: Anchors, ordinals: list[bytes | None], masks: list[bytes | None]) -> np.ndarray:
    """Which bytes of the texts lie under a repeated window."""
    edges = np.zeros(len(found.data) + 1, np.int64)
    wide = (found.reach + 1 + 7) // 8
    for i, (o, m) in enumerate(zip(ordinals, masks, strict=True)):
        if not o:
            continue
        at = found.at[found.first[i] + np.frombuffer(o, "<u4")]
        bits = np.unpackbits(np.frombuffer(m, np.uint8).reshape(-1, wide), axis=1, bitorder="little")[:, : found.reach + 1]
        row, back = np.nonzero(bits)
        starts = np.unique(at[row] - back)
        starts = starts[(starts >= found.offsets[i]) & (starts + found.length <= found.offsets[i + 1])]
        edges[starts] += 1
        edges[starts + found.length] -= 1
    return np.cumsum(edges[:-1]) > 0


def remove_repeats(
    docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept`` (the remaining bytes; ``as_text``:
    as text, without the parts of characters that a cut has left) of every row; ``id_col``
    may also be a struct of columns to carry along."""
    if length < 16:
        raise ValueError("strings must have 16 bytes or more")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    keyed = rows.select("key", "text")
    texts = written(per_text(judge_anchors(send_anchors(keyed, length, buckets), buckets, RUN_SUFFIXES)), "anchored-texts")
    asking = texts.filter("asks + hot > 0")
    asked, hot = (n or 0 for n in asking.agg(F.sum("asks"), F.sum("hot")).first())
    run_buckets = max(1, -(-asked // RUN_SUFFIXES))
    hot_buckets = -(-hot * (length - length // 2 + 1) // HOT_WINDOWS)
    runs = send_runs(
        keyed.join(asking.hint("merge"), "key").select("key", "text", "ordinals", "states"), length, run_buckets, hot_buckets
    )
    marks = written(merge_and_judge(runs, length, buckets, run_buckets), "window-marks")
    marked = written(marks_of(texts, marks, length, buckets), "marked-texts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            data, offsets = text_bytes(batch.column(1))
            ordinals, masks = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            if any(ordinals):
                gone = removed_bytes(Anchors(data, offsets, length), ordinals, masks)
            else:
                gone = np.zeros(len(data), bool)
            ends = np.concatenate([[0], np.cumsum(gone)])
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = offsets[1:-1][offsets[1:-1] < len(gone)]
            opens[inner] = gone[inner]
            spans = np.concatenate([[0], np.cumsum(opens)])
            removed = ends[offsets[1:]] - ends[offsets[:-1]]
            left = data[~gone].tobytes()
            stops = (offsets - ends[offsets]).tolist()
            kept = [left[a:b] for a, b in zip(stops, stops[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(offsets)),
                    pa.array(removed),
                    pa.array(spans[offsets[1:]] - spans[offsets[:-1]]),
                    pa.array([k.decode("utf-8", "ignore") for k in kept]) if as_text else pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    out = StructType(
        [
            StructField("doc_id", rows.schema["doc_id"].dataType),
            StructField("n_bytes", LongType()),
            StructField("n_removed", LongType()),
            StructField("n_spans", LongType()),
            StructField("kept", StringType() if as_text else BinaryType()),
        ]
    )
    return rows.join(marked.hint("merge"), "key", "left").select("doc_id", "text", "ordinals", "masks").mapInArrow(cut, out)
