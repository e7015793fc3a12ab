"""Near-duplicate groups by a Jaccard join of word n-grams, partitioned vertically.

The global order of all n-grams is cut into fragments. Each fragment finds, for its
part of every distinct set, which n-grams other sets have too and how many sets those
are; the partial counts are summed per set, and sets that share too few n-grams with
all others together are done. The others are joined on the rarest of their n-grams
(prefix filter), and the overlap of a candidate pair is counted fragment by fragment
and summed per pair.

Equal sets are one class and are compared once. Candidates start as stars around one
class of each posting list; after the components of these links are known, only pairs
across components are left to compare, all of them, so a large group of near copies
never makes all its pairs.

Joins of this module are sorted ones at every size: what is small here is not small
elsewhere. Broadcast are only the classes with very many partners, if they are at most
``BROADCAST_ROWS``, and keys that hold a thousandth of the rows or more.

Two texts link when 100 * intersection >= 75 * union (``percent``) of their distinct
n-grams, words in A-Z lower case. A text of fewer words has one n-gram, its whole
sequence; null, empty and blank texts have none and stay alone. N-grams and sets are
known by 64-bit hashes. Rows with equal ids are linked by their own texts, rows with a
null id take part and get the smallest id of their group (null if there is none). An
empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from vicinity.llm.common import pieces, text_bytes, with_values, written
from vicinity.llm.components import components
from vicinity.llm.hashing import mix, ragged, segment_sums, shingle_sets

FRAGMENT = 1 << 21  # n-grams of a fragment, about
PIECE_BYTES = 1 << 20  # text that a task hashes at once
PARTS = 4  # fragments in which a pair's overlap is counted
CELL = 4_000  # pairs of a cell, about
BROADCAST_ROWS = 1 << 19  # of 16 bytes; more are joined by sorting


def text_sets(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of a batch's texts, their ends per text, and a class id per text."""
    tokens, ends = shingle_sets(*text_bytes(batch.column(1)), length)
    sizes = np.diff(ends, prepend=0).astype(np.uint64)
    sums = segment_sums(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), ends)
    others = segment_sums(mix(tokens ^ np.uint64(0x14057B7EF767814F)), ends)
    return tokens, ends, mix(sums ^ mix(others + sizes)).view(np.int64)


def sets_of(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, text) to doc_id, n_shingles, class; no class without n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            _, ends, classes = text_sets(batch, length)
            sizes = np.diff(ends, prepend=0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, mask=sizes == 0)],
                names=["doc_id", "n_shingles", "class"],
            )

    out = StructType([docs.schema["doc_id"], StructField("n_shingles", LongType()), StructField("class", LongType())])
    return docs.mapInArrow(run, out)


# --- n-grams that several sets have ----------------------------------------------

# n-grams travel without their upper 16 bits, which the fragment's number makes up for
LOW = np.uint64((1 << 48) - 1)


def fragments_for(total: int) -> int:
    """A power of two, so that a fragment's number is the n-grams' upper bits."""
    return 1 << max(0, -(-total // FRAGMENT) - 1).bit_length()


def with_fragment(low: np.ndarray, fragment: int, fragments: int) -> np.ndarray:
    """The fragment's number above the lower 48 bits, which it overlaps if there are more
    than 2**16 fragments."""
    bits = max(16, fragments.bit_length() - 1)
    return low & np.uint64((1 << (64 - bits)) - 1) | np.uint64(fragment << (64 - bits))


def pack(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def pack_counts(counts: np.ndarray) -> bytes:
    """Two bytes each where that is enough; ``counts_of`` tells by the length."""
    return counts.astype("<u2" if counts.max() < 1 << 16 else "<u4").tobytes()


def counts_of(table: pa.Table) -> np.ndarray:
    parts = []
    for counts, classes in zip(table.column("counts").to_pylist(), table.column("classes").to_pylist(), strict=True):
        parts.append(np.frombuffer(counts, "<u2" if 4 * len(counts) == len(classes) else "<u4").astype(np.int64))
    return np.concatenate(parts)


FRAGMENTS = StructType(
    [
        StructField("fragment", IntegerType()),
        StructField("classes", BinaryType()),
        StructField("sizes", BinaryType()),
        StructField("counts", BinaryType()),
        StructField("tokens", BinaryType()),
    ]
)


def to_fragments(docs: DataFrame, length: int, fragments: int) -> DataFrame:
    """Each batch's distinct sets, cut at the fragments' borders: a row per fragment.
    A set's whole size goes with its first fragment, 0 with the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            tokens, ends, classes = text_sets(batch, length)
            sizes = np.diff(ends, prepend=0)
            _, first = np.unique(classes, return_index=True)
            first = first[sizes[first] > 0]
            if not len(first):
                continue
            tokens = tokens[ragged(ends[first] - sizes[first], sizes[first])]
            owner = np.repeat(np.arange(len(first)), sizes[first])
            fragment = ((tokens >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(fragment, kind="stable")
            cell = fragment[order] * len(first) + owner[order]
            starts = np.flatnonzero(np.diff(cell, prepend=-1))
            counts = np.diff(starts, append=len(cell))
            number, member = np.divmod(cell[starts], len(first))
            rows = np.flatnonzero(np.diff(number, prepend=-1))
            sorted_tokens, known = tokens[order], classes[first]
            _, opening = np.unique(member, return_index=True)
            wide = np.zeros(len(member), np.int32)
            wide[opening] = sizes[first]
            columns: list[list] = [[], [], [], [], []]
            for a, b in zip(rows, np.append(rows[1:], len(number))):
                stop = starts[b] if b < len(starts) else len(cell)
                values = (
                    int(number[a]),
                    known[member[a:b]].tobytes(),
                    wide[a:b].tobytes(),
                    pack_counts(counts[a:b]),
                    pack(sorted_tokens[starts[a] : stop]),
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            kinds = (pa.int32(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=FRAGMENTS.names)

    return docs.mapInArrow(run, FRAGMENTS)


SHARED = StructType(
    [
        StructField("bucket", IntegerType()),
        StructField("classes", BinaryType()),
        StructField("sizes", BinaryType()),
        StructField("counts", BinaryType()),
        StructField("tokens", BinaryType()),
        StructField("spread", BinaryType()),
    ]
)


def joined(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def shared_tokens(rows: DataFrame, fragments: int) -> DataFrame:
    """Per fragment: the n-grams that two sets or more have, with a code that rises
    with their number, handed on to the sets' buckets."""

    def run(table: pa.Table) -> pa.Table:
        fragment = table.column("fragment")[0].as_py()
        classes, sizes = joined(table, "classes", "<i8"), joined(table, "sizes", "<i4")
        counts = counts_of(table)
        tokens = np.concatenate([unpack(t) for t in table.column("tokens").to_pylist()])
        # a set seen by several tasks counts once
        begins = np.cumsum(counts) - counts
        _, first = np.unique(classes, return_index=True)
        tokens = tokens[ragged(begins[first], counts[first])]
        classes, sizes, counts = classes[first], sizes[first], counts[first]
        order = np.argsort(tokens, kind="stable")
        starts = np.flatnonzero(np.diff(tokens[order], prepend=~tokens[order[:1]]))
        runs = np.diff(starts, append=len(tokens))
        times = np.empty(len(tokens), np.int64)
        times[order] = np.repeat(runs, runs)
        shared = times > 1
        owner = np.repeat(np.arange(len(classes)), counts)[shared]
        tokens, times = with_fragment(tokens[shared] & LOW, fragment, fragments), times[shared]
        counts = np.bincount(owner, minlength=len(classes))
        code = np.minimum(8 * np.log2(times), 255).astype(np.uint8)
        begins = np.cumsum(counts) - counts
        bucket = (classes.view(np.uint64) % np.uint64(fragments)).astype(np.int64)
        out: list[tuple] = []
        have = np.flatnonzero((counts > 0) | (sizes > 0))
        have = have[np.argsort(bucket[have], kind="stable")]
        edges = np.flatnonzero(np.diff(bucket[have], prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(have))):
            mine = have[a:b]
            places = ragged(begins[mine], counts[mine])
            out.append(
                (
                    int(bucket[mine[0]]),
                    classes[mine].tobytes(),
                    sizes[mine].tobytes(),
                    pack_counts(counts[mine]),
                    tokens[places].tobytes(),
                    code[places].tobytes(),
                )
            )
        columns = list(zip(*out, strict=True)) if out else [()] * 6
        kinds = (pa.int32(), *[pa.binary()] * 5)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=SHARED.names)

    return rows.groupBy("fragment").applyInArrow(run, SHARED)


SETS = StructType(
    [
        StructField("class", LongType()),
        StructField("size", IntegerType()),
        StructField("alone", IntegerType()),
        StructField("tokens", BinaryType()),
        StructField("prefix", ArrayType(LongType())),
    ]
)


def sets_to_join(shared: DataFrame, percent: int) -> DataFrame:
    """Sets that share enough n-grams with all others together: size, number of n-grams
    that no other set has, shared n-grams in order, and the prefix on which the sets are
    joined, rarest first."""

    def run(table: pa.Table) -> pa.Table:
        classes, sizes = joined(table, "classes", "<i8"), joined(table, "sizes", "<i4")
        known, number = np.unique(classes, return_inverse=True)
        size = np.zeros(len(known), np.int64)
        np.maximum.at(size, number, sizes)
        owner = np.repeat(number, counts_of(table))
        tokens, code = joined(table, "tokens", "<u8"), joined(table, "spread", "u1")
        shared = np.bincount(owner, minlength=len(known))
        # overlap >= percent of the larger set; the n-grams no other has lead the order
        needed = -(-percent * size // 100)
        keep = shared >= needed
        length = np.where(keep, shared - needed + 1, 0)
        rare = np.lexsort((tokens, code, owner))
        begins = np.cumsum(shared) - shared
        first = rare[ragged(begins, length)]
        plain = np.lexsort((tokens, owner))
        kept = np.flatnonzero(keep)
        prefix_ends = np.concatenate([[0], np.cumsum(length[kept])]).astype(np.int32)
        return pa.table(
            [
                pa.array(known[kept]),
                pa.array(size[kept], pa.int32()),
                pa.array((size - shared)[kept], pa.int32()),
                pa.array([tokens[plain[b : b + n]].tobytes() for b, n in zip(begins[kept], shared[kept])], pa.binary()),
                pa.ListArray.from_arrays(pa.array(prefix_ends), pa.array(tokens[first].view(np.int64))),
            ],
            names=SETS.names,
        )

    return shared.groupBy("bucket").applyInArrow(run, SETS)


# --- pairs ------------------------------------------------------------------------


def may_link(one: str, other: str, percent: int):
    """Whether two sets can be similar enough that have an n-gram in common and nothing
    before it in the order: the overlap is at most what is left of either set."""
    sizes = F.col(f"size{one}").cast("long") + F.col(f"size{other}")
    return (100 + percent) * F.least(f"rest{one}", f"rest{other}").cast("long") >= percent * sizes


PAIR_PARTS = StructType([StructField("a", LongType()), StructField("b", LongType()), StructField("part", LongType())])


def borders_of(fragments: int) -> np.ndarray:
    """Where the tokens of ``shared_tokens`` are cut into parts."""
    top = fragments << (64 - max(16, fragments.bit_length() - 1))
    return np.array([top * k // PARTS for k in range(1, PARTS)], np.uint64)


def in_cells(pairs: DataFrame, cells: int) -> DataFrame:
    """Pairs with their cell: by the class that has fewer partners, so that a class with
    many is copied to cells at most and its partners are spread over them. Where both have
    many, the partners of the lesser one are dealt over as many cells as they fill."""
    both = pairs.select(F.explode(F.array("a", "b")).alias("class"))
    # at most two classes per cell on average
    heavy = written(both.groupBy("class").agg(F.count("*").alias("n")).filter(F.col("n") > CELL), "heavy-classes")
    way = "broadcast" if heavy.count() <= BROADCAST_ROWS else "merge"
    placed = pairs
    for side in ("a", "b"):
        partners = heavy.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"))
        placed = placed.join(partners.hint(way), side, "left")
    n_a, n_b = (F.coalesce(f"n_{side}", F.lit(0)) for side in ("a", "b"))
    light, other = (F.when(n_b > n_a, F.col(x)).otherwise(F.col(y)) for x, y in (("a", "b"), ("b", "a")))
    share = F.pmod(F.xxhash64(other), F.greatest(F.lit(1), F.ceil(F.least(n_a, n_b) / F.lit(CELL))))
    cell = F.pmod(F.xxhash64(light, share), F.lit(cells)).cast("int")
    return placed.select(*pairs.columns, cell.alias("cell"))


def linked(pairs: DataFrame, sets: DataFrame, percent: int, fragments: int) -> DataFrame:
    """The pairs (a, b, size_a, size_b; written) whose sets are similar enough. Their
    overlap is counted cell by cell and, in each, for parts of the n-gram order."""
    cells = max(1, -(-pairs.count() // CELL))
    placed = in_cells(pairs, cells)
    needed = placed.select(F.col("a").alias("class"), "cell").union(placed.select("b", "cell")).distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = borders_of(fragments)
        for batch in batches:
            rows: list[tuple] = []
            for cell, name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = np.frombuffer(data, "<u8")
                ends = [0, *np.searchsorted(tokens, borders).tolist(), len(tokens)]
                rows += [(cell, k, name, data[8 * a : 8 * b]) for k, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["cell", "fragment", "class", "tokens"]
            )

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = right.column("a").to_numpy(), right.column("b").to_numpy()
        if not left.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=PAIR_PARTS.names)
        classes = left.column("class").to_numpy()
        order = np.argsort(classes)
        parts = left.column("tokens").to_pylist()
        parts = [parts[i] for i in order]
        classes = classes[order]
        sizes = np.array([len(p) // 8 for p in parts], np.int64)
        begins = np.cumsum(sizes) - sizes
        distinct, tokens = np.unique(np.frombuffer(b"".join(parts), "<u8"), return_inverse=True)
        keys = np.repeat(np.arange(len(classes)), sizes) * len(distinct) + tokens
        at_a, at_b = (np.minimum(np.searchsorted(classes, x), len(classes) - 1) for x in (a, b))
        there = (classes[at_a] == a) & (classes[at_b] == b)  # a class may have nothing here
        a, b, at_a, at_b = a[there], b[there], at_a[there], at_b[there]
        flip = sizes[at_a] < sizes[at_b]
        large, small = np.where(flip, at_b, at_a), np.where(flip, at_a, at_b)
        order = np.lexsort((small, large))
        a, b, large, small = a[order], b[order], large[order], small[order]
        total = np.zeros(len(a), np.int64)
        ends = np.cumsum(sizes[small])
        low = 0
        while low < len(a):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + (1 << 21), "right")))
            some = small[low:high]
            wanted = np.repeat(large[low:high], sizes[some]) * len(distinct) + tokens[ragged(begins[some], sizes[some])]
            places = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hits = np.concatenate([[0], np.cumsum(keys[places] == wanted)])
            stops = np.cumsum(sizes[some])
            total[low:high] = hits[stops] - hits[stops - sizes[some]]
            low = high
        return pa.table([pa.array(a), pa.array(b), pa.array(total)], names=PAIR_PARTS.names)

    pieces_of = sets.join(needed.hint("merge"), "class").select("cell", "class", "tokens").mapInArrow(
        cut,
        StructType(
            [
                StructField("cell", IntegerType()),
                StructField("fragment", IntegerType()),
                StructField("class", LongType()),
                StructField("tokens", BinaryType()),
            ]
        ),
    )
    asked = placed.select("cell", F.explode(F.array(*map(F.lit, range(PARTS)))).alias("fragment"), "a", "b")
    counted = pieces_of.groupBy("cell", "fragment").cogroup(asked.groupBy("cell", "fragment")).applyInArrow(count, PAIR_PARTS)
    overlap = counted.groupBy("a", "b").agg(F.sum("part").alias("overlap"))
    sizes = F.col("size_a").cast("long") + F.col("size_b")
    enough = (100 + percent) * F.col("overlap") >= percent * sizes
    return pairs.join(overlap, ["a", "b"]).filter(enough).select("a", "b")


def posting_lists(sets: DataFrame) -> DataFrame:
    """token, class, size, and ``rest``: the set's n-grams from this one on."""
    at = F.posexplode("prefix").alias("at", "token")
    return sets.select(at, "class", "size", "alone").select(
        "token", "class", "size", (F.col("size") - F.col("alone") - F.col("at")).alias("rest")
    )


def star_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Each class with one class of its posting lists: the one with the fewest n-grams
    of its own, which is most like an original."""
    own = F.floor(1000 * F.col("rest") / F.col("size"))
    hub = F.max(F.struct(own.alias("own"), "class", "size", "rest")).alias("hub")
    lists = postings.groupBy("token").agg(hub, F.count("*").alias("n")).filter("n > 1")
    pairs = postings.join(lists.hint("merge"), "token").select(
        "class", "size", "rest", *[F.col(f"hub.{c}").alias(f"{c}_hub") for c in ("class", "size", "rest")]
    )
    near = pairs.filter((F.col("class") != F.col("class_hub")) & may_link("", "_hub", percent))
    return ordered(near, "", "_hub")


def ordered(pairs: DataFrame, one: str, other: str) -> DataFrame:
    """Distinct pairs (a, b, size_a, size_b), a below b."""
    first = F.col(f"class{one}") < F.col(f"class{other}")
    pick = lambda c, x, y: F.when(first, F.col(f"{c}{x}")).otherwise(F.col(f"{c}{y}"))
    return pairs.select(
        pick("class", one, other).alias("a"),
        pick("class", other, one).alias("b"),
        pick("size", one, other).alias("size_a"),
        pick("size", other, one).alias("size_b"),
    ).distinct()


def cross_pairs(postings: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """All pairs of a posting list across components that may still link. The classes
    outside a list's largest component meet all others; those inside it don't meet
    each other."""
    labelled = postings.join(groups.withColumnRenamed("node", "class").hint("merge"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    by_component = labelled.groupBy("token", "component").agg(F.count("*").alias("n"))
    lists = by_component.groupBy("token").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("k")
    )
    members = labelled.join(lists.filter("k > 1").hint("merge"), "token")
    names = ("class", "size", "rest", "component")
    outside = members.filter("component != main").select("token", *[F.col(c).alias(f"{c}_x") for c in names])
    everyone = members.select("token", "main", *[F.col(c).alias(f"{c}_y") for c in names])
    pairs = outside.join(everyone, "token").filter(
        (F.col("component_x") != F.col("component_y"))
        & ((F.col("component_y") == F.col("main")) | (F.col("class_x") < F.col("class_y")))
        & may_link("_x", "_y", percent)
    )
    return ordered(pairs, "_x", "_y")


def groups_of(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 5, percent: int = 75
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(sets_of(texts, length), "sets")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    fragments = fragments_for(total)
    shared = shared_tokens(to_fragments(texts, length, fragments), fragments)
    sets = written(sets_to_join(shared, percent), "sets-to-join")
    postings = written(posting_lists(sets), "postings")
    stars = written(star_pairs(postings, percent), "star-pairs")
    links = written(linked(stars, sets, percent, fragments), "links")
    first = components(links)
    rest = written(cross_pairs(postings, first, percent).join(stars, ["a", "b"], "left_anti"), "cross-pairs")
    if rest.isEmpty():
        groups = first
    else:
        groups = components(written(links.unionByName(linked(rest, sets, percent, fragments)), "links"))
    # the smallest id of each class, and of each component
    own = written(rows.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("own"), F.count("*").alias("n")), "classes")
    in_group = groups.withColumnRenamed("node", "class").join(own.hint("merge"), "class")
    least = written(in_group.groupBy("component").agg(F.min("own").alias("least"), F.count("*").alias("n")), "components")
    named = with_values(in_group.select("class", "component"), least, "component").select("class", F.col("least").alias("component_id"))
    of_class = own.join(named.hint("merge"), "class", "left").withColumn("component_id", F.coalesce("component_id", "own"))
    of_class = written(of_class.select("class", "component_id", "n"), "ids-of-classes")
    columns = ("doc_id", "n_shingles", "component_id")
    together = with_values(rows.filter("class is not null"), of_class, "class")
    alone = rows.filter("class is null").withColumn("component_id", F.col("doc_id"))
    return together.select(*columns).unionByName(alone.select(*columns))
