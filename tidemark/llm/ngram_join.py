"""Jaccard join of documents on word n-grams by signature trees."""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import components, kept
from tidemark.llm.groups import Sets, contiguous, smallest_member
from tidemark.llm.text import mix, shingle_sets, text_bytes, words
from tidemark.session import staged

# Documents of one tree.
TILE = 2000
FANOUT = 8
# Most bits of a bitmap. Up to here every token that two documents of a tile have gets a
# bit of its own, beyond it tokens share bits.
MOST_BITS = 1 << 16
# Chance that two documents right at the threshold are never brought together.
MISSED = 1e-10
SEED = 4


@dataclass(frozen=True)
class Threshold:
    """Sets link when ``den * |both| >= num * |either|``."""

    num: int
    den: int

    def shared(self, total):
        """Tokens that two sets with ``total`` tokens together must share to link."""
        return -(-self.num * total // (self.num + self.den))

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        need = self.shared(len(a) + len(b))
        if need > min(len(a), len(b)):
            return False
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        return int(np.count_nonzero(b[at] == a)) >= need

    @property
    def similarity(self) -> float:
        return self.num / self.den


@dataclass(frozen=True)
class Bands:
    """Keys by which sets that may link are brought to the same tree.

    A key is made of ``rows`` min-hashes, so two sets share one with chance
    similarity ** rows. There are as many keys as make it that a link at the very threshold
    goes unmet with a chance of `MISSED` at most, and closer sets with less.
    """

    rows: int
    bands: int

    @classmethod
    def of(cls, limit: Threshold, rows: int) -> Bands:
        met = limit.similarity**rows
        return cls(rows, max(1, math.ceil(math.log(MISSED) / math.log(1 - met))) if met < 1 else 1)

    def functions(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(SEED)
        n = self.rows * self.bands
        flips, factors = rng.integers(0, 1 << 32, (2, n), dtype=np.uint64).astype(np.uint32)
        return flips, factors | np.uint32(1)

    def keys(self, tokens: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
        least = np.full(len(flips), np.iinfo(np.uint32).max, dtype=np.uint32)
        short = (tokens >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(short), 512):
            block = short[a : a + 512, None] ^ flips
            block *= factors
            np.minimum(least, block.min(axis=0), out=least)
        band = least.reshape(self.bands, self.rows).astype(np.uint64)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for r in range(self.rows):
            key = mix(key + band[:, r])
        return key


def bitmaps(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per set its bitmap and how many of its tokens hide behind another's bit.

    Tokens that only one set has are in no overlap and get no bit.
    """
    flat = np.concatenate(sets)
    _, token, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = seen > 1
    rank = np.cumsum(shared) - 1
    bits = max(64, -(-int(shared.sum()) // 64) * 64)
    bits = min(bits, MOST_BITS)
    maps = np.empty((len(sets), bits // 8), dtype=np.uint8)
    hidden = np.zeros(len(sets), dtype=np.int64)
    ends = np.cumsum([len(s) for s in sets])
    for i, own in enumerate(np.split(token, ends[:-1])):
        own = rank[own[shared[own]]] % bits
        flags = np.zeros(bits, dtype=bool)
        flags[own] = True
        maps[i] = np.packbits(flags)
        hidden[i] = len(own) - np.count_nonzero(flags)
    return maps.view(np.uint64), hidden


class Tree:
    """A signature tree: nodes hold the OR of their documents' token bitmaps, the range of
    their sizes, and how many tokens at most hide behind another's bit in one document.

    ``levels[0]`` are the documents in an order that brings similar ones together; a node of
    the next level stands for `FANOUT` nodes below it.
    """

    def __init__(self, sets: list[np.ndarray], maps: np.ndarray, hidden: np.ndarray):
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.levels = [(maps, sizes, sizes, hidden)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, hidden = self.levels[-1]
            at = np.arange(0, len(maps), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(hidden, at),
                )
            )

    def groups(self, labels: np.ndarray) -> list[np.ndarray]:
        """Per level, the label that all documents of a node have, or -1."""
        out = [labels]
        for _ in self.levels[1:]:
            below = out[-1]
            at = np.arange(0, len(below), FANOUT)
            low, high = np.minimum.reduceat(below, at), np.maximum.reduceat(below, at)
            out.append(np.where(low == high, low, -1))
        return out


def traverse(
    x: Tree, y: Tree, limit: Threshold, x_labels: np.ndarray, y_labels: np.ndarray, itself: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of documents of two trees (or of one with ``itself``, i < j) that may link.

    Goes down both trees at once. A pair of nodes is left when their size ranges cannot
    meet, when all their documents have one label already, or when the largest possible
    overlap is below what the smallest of them would need: two documents share at most
    as many tokens as their nodes' bitmaps share bits, and those that hide behind a bit.
    If none hides, a pair of documents that is left does link.
    """
    depth = max(len(x.levels), len(y.levels)) - 1
    xg, yg = x.groups(x_labels), y.groups(y_labels)
    todo = [(depth, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while todo:
        level, i, j = todo.pop()
        if len(i) > 50_000:
            half = len(i) // 2
            todo.append((level, i[half:], j[half:]))
            i, j = i[:half], j[:half]
        kx, ky = min(level, len(x.levels) - 1), min(level, len(y.levels) - 1)
        i, j = _possible(x.levels[kx], y.levels[ky], xg[kx], yg[ky], i, j, limit)
        if not len(i):
            continue
        if level == 0:
            if itself:
                i, j = i[i < j], j[i < j]
            yield i, j
            continue
        a, b = _children(i, x, level)[:, :, None], _children(j, y, level)[:, None, :]
        a, b = (side.ravel() for side in np.broadcast_arrays(a, b))
        ok = (a >= 0) & (b >= 0) & ((a <= b) if itself else True)
        todo.append((level - 1, a[ok], b[ok]))


def _children(nodes: np.ndarray, tree: Tree, level: int) -> np.ndarray:
    if level >= len(tree.levels):  # the tree is lower than the other: its root waits
        return nodes[:, None]
    below = nodes[:, None] * FANOUT + np.arange(FANOUT)
    return np.where(below < len(tree.levels[level - 1][0]), below, -1)


def _possible(xs, ys, xg, yg, i, j, limit: Threshold) -> tuple[np.ndarray, np.ndarray]:
    keep = (xg[i] < 0) | (xg[i] != yg[j])
    i, j = i[keep], j[keep]
    (xm, xl, xh, xc), (ym, yl, yh, yc) = xs, ys
    keep = (xh[i] * limit.den >= yl[j] * limit.num) & (yh[j] * limit.den >= xl[i] * limit.num)
    i, j = i[keep], j[keep]
    keep = np.zeros(len(i), dtype=bool)
    for a in range(0, len(i), 4096):
        p, q = i[a : a + 4096], j[a : a + 4096]
        both = np.bitwise_count(xm[p] & ym[q]).sum(axis=1, dtype=np.int64)
        most = np.minimum(both + np.minimum(xc[p], yc[q]), np.minimum(xh[p], yh[q]))
        keep[a : a + 4096] = most >= limit.shared(xl[p] + yl[q])
    return i[keep], j[keep]


def _ordered(sets: list[np.ndarray]) -> list[int]:
    """By the least token hash, which similar sets tend to have in common."""
    return sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i])))


def join_within(sets: list[np.ndarray], limit: Threshold) -> list[tuple[int, int]]:
    """Links that tie together all that any links tie together, among up to `TILE` sets."""
    order = _ordered(sets)
    own = [sets[i] for i in order]
    found, joined = [], Sets(len(own))
    for i in range(1, len(own)):  # neighbours first: what they tie need not be asked again
        if limit.links(own[i - 1], own[i]):
            joined.join(i - 1, i)
            found.append((order[i - 1], order[i]))
    if len(own) > 2:
        maps, hidden = bitmaps(own)
        tree, labels, sure = Tree(own, maps, hidden), joined.labels(), not hidden.any()
        for left, right in traverse(tree, tree, limit, labels, labels, itself=True):
            for i, j in zip(left.tolist(), right.tolist(), strict=True):
                if joined.root(i) != joined.root(j) and (sure or limit.links(own[i], own[j])):
                    joined.join(i, j)
                    found.append((order[i], order[j]))
    return found


def join_across(
    a: list[np.ndarray], a_labels: list[int], b: list[np.ndarray], b_labels: list[int], limit: Threshold
) -> list[tuple[int, int]]:
    """Links between two tiles that tie sets of different labels."""
    names = {label: k for k, label in enumerate(dict.fromkeys([*a_labels, *b_labels]))}
    oa, ob = _ordered(a), _ordered(b)
    own = [*(a[i] for i in oa), *(b[i] for i in ob)]
    label = np.array([*(names[a_labels[i]] for i in oa), *(names[b_labels[i]] for i in ob)], dtype=np.int64)
    maps, hidden = bitmaps(own)
    n, sure = len(a), not hidden.any()
    x, y = Tree(own[:n], maps[:n], hidden[:n]), Tree(own[n:], maps[n:], hidden[n:])
    joined, found = Sets(len(names)), []
    for left, right in traverse(x, y, limit, label[:n], label[n:], itself=False):
        for i, j in zip(left.tolist(), (right + n).tolist(), strict=True):
            p, q = int(label[i]), int(label[j])
            if joined.root(p) != joined.root(q) and (sure or limit.links(own[i], own[j])):
                joined.join(p, q)
                found.append((oa[i], ob[j - n]))
    return found


def _sets_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    flat = column.combine_chunks()
    values = flat.values.to_numpy(zero_copy_only=False).view(np.uint64)
    at = flat.offsets.to_numpy()
    return [values[at[i] : at[i + 1]] for i in range(len(flat))]


def _edges(a: list[int] | np.ndarray, b: list[int] | np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _free(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of what is written and read back by now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ngram_components(
    docs: DataFrame,
    threshold: Threshold,
    size: int,
    rows: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, the smallest id that links reach.

    A document's set are the distinct runs of ``size`` words of its whole text, A-Z in
    lower case, as 64-bit hashes; one with fewer words has its whole sequence as the only
    run, and a null, empty or wordless text an empty set that links with nothing.

    Equal sets are one node from the start, so copies cost nothing. Which documents come
    together is told by `Bands` of ``rows`` min-hashes: documents with a key in common are in
    one block. In a block, signature trees are joined by a dual traversal (`traverse`)
    and pairs that remain are compared exactly. A block of more than `TILE` documents is
    dealt to tiles: trees within each, then trees over one document per component found,
    then those outside the block's largest component against all tiles, so a group of
    near copies, which falls together at once, is not compared pair by pair.

    A row with a null id has a null component and links with nothing; repeated rows repeat
    their result, and two texts of one id are two nodes. Empty tables give no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    bands = Bands.of(threshold, rows)
    functions = bands.functions()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(words(*text_bytes(batch.column(1))), size)
            marks = [mix(mix(s).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s)))[0] for s in sets]
            keys = [bands.keys(s, *functions) for s in sets if len(s)]
            at = np.cumsum([0, *(bands.bands if len(s) else 0 for s in sets)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(marks, dtype=np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64))),
                ],
                names=["doc_id", "print", "n", "mark", "keys"],
            )

    own = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("print")
    )
    signed = staged(
        own.mapInArrow(sign, "doc_id long, print long, n long, mark long, keys array<long>"), "ngram-signed"
    )
    named = signed.filter("doc_id IS NOT NULL AND n > 0")

    # Blocks: documents that hold a key in common, and what those hold in common with others.
    held = named.select("mark", F.explode("keys").alias("key"))
    shared = held.groupBy("key").agg(F.min("mark").alias("least"), F.max("mark").alias("most"))
    shared = staged(
        shared.filter("least <> most").select(F.col("key").alias("k"), "least"), "ngram-shared"
    )
    _free(spark)
    near = held.join(shared, F.col("key") == F.col("k")).filter("mark <> least")
    near = staged(near.select(F.col("mark").alias("a"), F.col("least").alias("b")).distinct(), "ngram-near")
    _free(spark)
    blocks = kept(components(near, "ngram-blocks").toDF("mark", "block"), "ngram-members")

    # One document per distinct set, with its tokens, of those that are in a block. An id
    # does not tell its text, as it may have several.
    firsts = named.groupBy("mark").agg(
        F.min("doc_id").alias("first"), F.min_by("print", "doc_id").alias("first_print")
    )
    firsts = staged(firsts, "ngram-firsts")
    sizes = blocks.groupBy("block").agg(F.count("*").alias("held"))
    sizes = kept(sizes.withColumnRenamed("block", "b"), "ngram-sizes")
    members = kept(
        blocks.join(firsts, "mark")
        .join(sizes, F.col("block") == F.col("b"))
        .select("mark", "first", "first_print", "block", "held"),
        "ngram-members",
    )

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(words(*text_bytes(batch.column("text"))), size)
            at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
            tokens = pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("mark"), batch.column("block"), batch.column("held"), tokens],
                names=["mark", "block", "held", "tokens"],
            )

    # The members are as many as the corpus makes them, so they are not for broadcasting.
    same = (F.col("doc_id") == F.col("first")) & (F.col("print") == F.col("first_print"))
    texts = own.join(members.hint("merge"), same)
    texts = texts.select("mark", "block", "held", "text")
    full = texts.mapInArrow(tokens, "mark long, block long, held long, tokens array<long>")
    full = staged(full, "ngram-tokens")
    _free(spark)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in contiguous(batches, ["block", "tile"]):
            once = _distinct(rows)
            marks = once.column("mark").to_numpy()
            joined = Sets(len(marks))
            for i, j in join_within(_sets_of(once.column("tokens")), threshold):
                joined.join(i, j)
            part = joined.labels()
            least = marks.copy()
            np.minimum.at(least, part, marks)
            led = np.flatnonzero(marks != least[part])
            yield _edges(marks[led], least[part][led])

    def tiled(rows: DataFrame) -> DataFrame:
        many = F.ceil(F.col("held") / TILE)
        tile = F.pmod(F.xxhash64("mark"), many)
        return rows.withColumn("tile", tile)

    def joined(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition("block", "tile").sortWithinPartitions("block", "tile")
        return dealt.mapInArrow(within, "a long, b long")

    edges = staged(joined(tiled(full)), "ngram-links")
    large = full.filter(F.col("held") > TILE)
    if not large.isEmpty():
        edges = _across(large, edges, joined, tiled, threshold)

    linked = kept(components(edges, "ngram-parts"), "ngram-parts")
    smallest = kept(
        smallest_member(firsts.withColumnRenamed("mark", "node"), linked, "ngram"), "ngram-smallest"
    )
    told = signed.join(smallest, (F.col("mark") == F.col("node")) & (F.col("n") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id"))
    return told.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _distinct(rows: pa.Table) -> pa.Table:
    """One row per mark: repeated rows of one id and text have met the same member."""
    marks = rows.column("mark").to_numpy()
    _, first = np.unique(marks, return_index=True)
    return rows if len(first) == len(marks) else rows.take(pa.array(np.sort(first)))


def _across(large: DataFrame, edges: DataFrame, joined, tiled, threshold: Threshold) -> DataFrame:
    """All links of blocks with several tiles, given those within the tiles."""

    def labelled(links: DataFrame, label: str) -> DataFrame:
        parts = kept(components(links, label), label)
        return large.join(parts, F.col("mark") == F.col("node"), "left").withColumn(
            "part", F.coalesce("component", "mark")
        )

    # One document of each component in a block, in tiles of their own.
    rows = labelled(edges, "ngram-tile-parts").filter("mark = part").drop("held")
    counts = rows.groupBy("block").agg(F.count("*").alias("held"))
    counts = kept(counts.withColumnRenamed("block", "b"), "ngram-part-counts")
    rows = rows.join(counts, F.col("block") == F.col("b")).select("mark", "block", "held", "tokens")
    edges = staged(edges.unionByName(joined(tiled(rows))), "ngram-links")

    # What is outside a block's largest component, against the whole block.
    rows = labelled(edges, "ngram-block-parts").select("mark", "block", "held", "tokens", "part")
    rows = staged(rows, "ngram-large")
    counts = rows.groupBy("block", "part").agg(F.count("*").alias("n"))
    most = counts.groupBy("block").agg(
        F.max_by("part", F.struct("n", "part")).alias("main"),
        (F.sum("n") - F.max("n")).alias("others"),
    )
    most = kept(most.filter("others > 0").withColumnRenamed("block", "b"), "ngram-main-parts")
    open_rows = rows.join(most, F.col("block") == F.col("b"))
    tiles = F.ceil(F.col("held") / TILE).cast("int")
    chunks = F.ceil(F.col("others") / TILE).cast("int")
    mark = F.xxhash64("mark")
    columns = ("mark", "block", "tokens", "part", "tile", "chunk", "small")
    right = (
        open_rows.withColumn("tile", F.pmod(mark, tiles))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .withColumn("small", F.lit(0))
        .select(*columns)
    )
    left = (
        open_rows.filter("part <> main")
        .withColumn("chunk", F.pmod(mark, chunks).cast("int"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), tiles.cast("long") - 1)))
        .withColumn("small", F.lit(1))
        .select(*columns)
    )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in contiguous(batches, ["block", "tile", "chunk"]):
            sides = []
            for small in (1, 0):
                side = group.filter(pa.compute.equal(group.column("small"), small))
                sides.append(
                    (side.column("mark").to_pylist(), side.column("part").to_pylist(), _sets_of(side.column("tokens")))
                )
            (am, al, a), (bm, bl, b) = sides
            pairs = join_across(a, al, b, bl, threshold) if a and b else []
            yield _edges([am[i] for i, _ in pairs], [bm[j] for _, j in pairs])

    dealt = right.unionByName(left).repartition("block", "tile", "chunk")
    dealt = dealt.sortWithinPartitions("block", "tile", "chunk")
    return staged(edges.unionByName(dealt.mapInArrow(across, "a long, b long")), "ngram-links")
