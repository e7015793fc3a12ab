"""Byte-level BPE encoding and decoding with forced-boundary splitting.

A pair of bytes that occurs side by side in no token of the vocabulary is a certain
cut: no merge can ever join its two sides. Each pre-token is cut there and the
fragments are encoded independently and concatenated.

Results are those of the tokenizers library for a byte-level BPE file without
normalizer and post-processor: strings of special tokens in a text become their ids,
no special token is added. Null and empty texts give no ids; decoding no ids gives an
empty text. Rows are kept as they come, repeated ids included; the columns asked for
are the only ones read, so others may bear any name.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from vicinity.llm.common import pieces
from vicinity.llm.encoding import Memo, split_leading

# Fixed value: the pre-token pattern of byte-level BPE files with use_regex.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ID_BITS = 20
NO_MERGE = 1 << 62
SHORT = 48  # bytes up to which fragments are merged side by side; longer ones use a heap


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1
    stands for itself, every other byte for the next letter from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """The merges of a BPE file, applied to many fragments side by side."""

    def __init__(self, spec: dict, special: dict[str, int]) -> None:
        vocab = spec["model"]["vocab"]
        if 1 + max([*vocab.values(), *special.values()]) > 1 << ID_BITS:
            raise ValueError("the vocabulary has more ids than the merge table can hold")
        end = spec["model"]["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.token_bytes = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in vocab.items():
            if token not in special:
                self.token_bytes[i] = bytes(letters[c] for c in (token.removesuffix(end) if end else token))
        for token, i in special.items():
            self.token_bytes[i] = token.encode()
        in_order = [c for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.byte_ids = np.array([vocab[c] for c in in_order], np.int64)
        self.last_ids = np.array([vocab[c + end] for c in in_order], np.int64)
        self.merges: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges.setdefault((vocab[left], vocab[right]), rank << ID_BITS | vocab[left + right])
        pairs = sorted((a << ID_BITS | b, m) for (a, b), m in self.merges.items())
        self.pair_keys = np.array([k for k, _ in pairs] + [NO_MERGE], np.int64)
        self.pair_merges = np.array([m for _, m in pairs] + [NO_MERGE], np.int64)
        joined = {a << 8 | b for i, t in enumerate(self.token_bytes) for a, b in zip(t, t[1:])}
        self.may_join = np.zeros(1 << 16, bool)
        self.may_join[list(joined)] = True

    def cut(self, data: np.ndarray, token_ends: np.ndarray) -> np.ndarray:
        """Where fragments start: at each pre-token and at each forced boundary."""
        opens = np.zeros(len(data), bool)
        opens[:1] = True
        opens[token_ends[token_ends < len(data)]] = True
        pairs = data[:-1].astype(np.int32) << 8 | data[1:]
        opens[1:] |= ~self.may_join[pairs]
        return np.flatnonzero(opens)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and result of joining two ids, or NO_MERGE; an id below 0 joins none."""
        keys = left << ID_BITS | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = len(self.pair_keys) - 1
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_merges[at], NO_MERGE)

    def merge(self, first: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all fragments in order, and how many stand up to each one's end.

        ``first`` holds the id of each byte. Fragments of similar length are merged
        side by side, one join each per step."""
        sizes = np.diff(np.append(starts, len(first)))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # fragments, ids, counts
        lower = 0
        for width in (1, 2, 4, 6, 8, 10, 12, 16, 24, SHORT):
            chosen = np.flatnonzero((sizes > lower) & (sizes <= width))
            lower = width
            if len(chosen):
                places = starts[chosen][:, None] + np.arange(width)
                inside = np.arange(width) < sizes[chosen][:, None]
                ids = np.where(inside, first[np.minimum(places, len(first) - 1)], -1)
                found.append((chosen, *self._merge_short(ids, sizes[chosen].copy())))
        for i in np.flatnonzero(sizes > SHORT):
            ids = np.array([self._merge_long(first[starts[i] : starts[i] + sizes[i]].tolist())], np.int64)
            found.append((np.array([i]), ids, np.array([ids.shape[1]])))
        counts = np.zeros(len(starts), np.int64)
        for chosen, _, n in found:
            counts[chosen] = n
        ends = np.cumsum(counts)
        out = np.empty(int(counts.sum()), np.int64)
        for chosen, ids, n in found:
            places = (ends[chosen] - n)[:, None] + np.arange(ids.shape[1])
            held = np.arange(ids.shape[1]) < n[:, None]
            out[places[held]] = ids[held]
        return out, ends

    def _merge_short(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join the pair of lowest rank, the leftmost of equals, until none is left."""
        n, width = ids.shape
        if width < 2:
            return ids, counts
        ranks = np.full(ids.shape, NO_MERGE)
        ranks[:, :-1] = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        out = ids.copy()
        rows, steps = np.arange(n), np.arange(width)
        while len(rows):
            line = np.arange(len(rows))
            at = ranks.argmin(axis=1)
            best = ranks[line, at]
            going = best != NO_MERGE
            if not going.all():  # set aside those that are done
                out[rows[~going]] = ids[~going]
                rows, ids, ranks, at, best = rows[going], ids[going], ranks[going], at[going], best[going]
                line = np.arange(len(rows))
                if not len(rows):
                    break
            # close the gap of the joined pair, then look at its new neighbours
            beyond = steps[:-1] >= at[:, None]
            ranks[:, :-1] = np.where(beyond, ranks[:, 1:], ranks[:, :-1])
            beyond[line, at] = False
            ids[:, :-1] = np.where(beyond, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            new = best & ((1 << ID_BITS) - 1)
            ids[line, at] = new
            ranks[line, at] = self.rank(new, ids[line, np.minimum(at + 1, width - 1)])
            left = at > 0
            ranks[line[left], at[left] - 1] = self.rank(ids[line[left], at[left] - 1], new[left])
            counts[rows] -= 1
        return out, counts

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, merges = len(ids), self.merges
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(m, i) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1]), NO_MERGE)) != NO_MERGE]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or merges.get((ids[i], ids[j])) != m:
                continue
            ids[i] = m & ((1 << ID_BITS) - 1)
            ids[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := merges.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (m, i))
            h = before[i]
            if h >= 0 and (m := merges.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (m, h))
        return [i for i in ids if i >= 0]


class ForcedBoundaryBPE(Memo):
    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table = MergeTable(spec, self.special)
        self.tokens = pa.array(self.table.token_bytes, pa.large_binary())
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        escaped = map(regex.escape, sorted(self.special, key=len, reverse=True))
        self.at_special = regex.compile(f"({'|'.join(escaped)})").split

    def split(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return split_leading(text)
        parts = self.at_special(text)
        return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else split_leading(part))]

    def encode_new(self, parts):
        ordinary = []
        for part in parts:
            if part in self.special:
                yield part, np.array([self.special[part]], "<u4").tobytes()
            else:
                ordinary.append(part)
        # a part from a blank to a non-blank may follow another: a pre-token starts there
        chained = [p for p in ordinary if p[0] in " \t\r\n" and not p[-1].isspace()]
        for start in range(0, len(chained), 1 << 15):
            some = chained[start : start + (1 << 15)]
            yield from self._encode(some, self.pre_tokens("".join(some)))
        alone = set(ordinary).difference(chained)
        if alone:
            yield from self._encode(list(alone), [t for p in alone for t in self.pre_tokens(p)])

    def _encode(self, parts: list[str], tokens: list[str]):
        """``tokens`` are the pre-tokens of all parts, one after another."""
        data = np.frombuffer("".join(parts).encode(), np.uint8)
        # places of characters among the bytes turn lengths of texts into ends in bytes
        places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        starts = self.table.cut(data, places[np.cumsum(np.fromiter(map(len, tokens), np.int64))])
        ids, ends = self.table.merge(self.table.byte_ids[data], starts)
        part_ends = places[np.cumsum(np.fromiter(map(len, parts), np.int64))]
        packed, at = ids.astype("<u4").tobytes(), 0
        for part, to in zip(parts, (4 * ends[np.searchsorted(starts, part_ends) - 1]).tolist(), strict=True):
            yield part, packed[at:to]
            at = to

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of ids; bytes that are no UTF-8 become replacement characters."""
        starts = np.asarray(ids.offsets)
        flat = self.tokens.take(ids.values.slice(starts[0], starts[-1] - starts[0]))
        ends = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset :][starts - starts[0]]
        data = flat.buffers()[2]
        whole = data.to_pybytes()[ends[0] : ends[-1]] if data is not None else b""
        ends = ends - ends[0]
        try:
            whole.decode()
            torn = any(0x80 <= whole[e] < 0xC0 for e in ends.tolist() if e < len(whole))
        except UnicodeDecodeError:
            torn = True
        texts = [whole[a:b] for a, b in zip(ends, ends[1:])]
        if torn:
            texts = [t.decode("utf-8", "replace").encode() for t in texts]
        return pa.array(texts, pa.binary()).cast(pa.string())


@functools.lru_cache(maxsize=2)
def bpe(path: str) -> ForcedBoundaryBPE:
    """One per worker process and file."""
    return ForcedBoundaryBPE(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of every whole text; ``path`` is a
    byte-level BPE file that every executor can open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe(path)
        for batch in pieces(batches, "text"):
            packed = encoder.packed_all(batch.column(1).to_pylist())
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    out = StructType([docs.schema[id_col], StructField("ids", ArrayType(IntegerType()))])
    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(run, out)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns of ``tokens`` (none may be called ``name``) and the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = bpe(path)
        for batch in batches:
            place = batch.schema.get_field_index(ids_col)
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, decoder.decode(some.column(place))], names=[*some.schema.names, name]
                )

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField(name, StringType())]))
