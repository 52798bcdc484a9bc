"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, kept
from tidemark.llm.groups import contiguous, smallest_member
from tidemark.llm.text import mix
from tidemark.session import staged

# Width of a bucket of a projection, in distances between vectors of length 1.
WIDTH = 1.2
# Chance that a pair right at the threshold meets in some table.
RECALL = 0.998
# Vectors of one bucket compared at once.
TILE = 2000
SEED = 6


def _meet(distance: float) -> float:
    """Chance that two vectors at a distance fall in the same bucket of one projection
    (Datar et al., 2004, for the normal distribution)."""
    r = WIDTH / distance
    normal = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class Hashing:
    """``tables`` tables of buckets, each told by ``projections`` quantised projections."""

    projections: int
    tables: int

    @classmethod
    def for_rows(cls, rows: int, cosine: float) -> Hashing:
        """Enough projections that unrelated vectors rarely meet however many there are
        (about eight of them per bucket), and then enough tables for `RECALL`."""
        near, far = _meet(math.sqrt(2 - 2 * cosine)), _meet(math.sqrt(2))
        k = max(2, math.ceil(math.log(max(rows, 16) / 8) / -math.log(far)))
        tables = math.ceil(math.log(1 - RECALL) / math.log(1 - near**k))
        return cls(k, tables)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """(vectors, tables), int32."""
        rng = np.random.default_rng(SEED)
        n, d = vectors.shape
        if not n:
            return np.zeros((0, self.tables), dtype=np.int32)
        lines = rng.standard_normal((d, self.tables * self.projections))
        shift = rng.uniform(0, WIDTH, self.tables * self.projections)
        cells = np.floor((vectors @ lines + shift) / WIDTH).astype(np.int64).view(np.uint64)
        cells = cells.reshape(n, self.tables, self.projections)
        out = np.zeros((n, self.tables), dtype=np.uint64)
        for k in range(self.projections):
            out = mix(out + cells[:, :, k] + np.uint64(k + 1))
        return (out & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def unit(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors at length 1 in double precision, and which of them have a direction."""
    rows = [v.values for v in column]
    size = max((len(v) for v in rows if v is not None), default=0)
    out = np.zeros((len(rows), size))
    good = np.zeros(len(rows), dtype=bool)
    for i, v in enumerate(rows):
        if v is None or len(v) != size or v.null_count:
            continue
        x = v.to_numpy(zero_copy_only=False).astype(np.float64)
        most = np.abs(x).max(initial=0.0)
        if np.isfinite(most) and most > 0:
            x = x / most
            out[i] = x / np.sqrt(x @ x)
            good[i] = True
    return out, good


def linked_pairs(vectors: np.ndarray, cosine: float, other: np.ndarray | None = None) -> Iterator[tuple]:
    """Pairs (i, j) at or above the cosine; i < j within ``vectors`` if there is no ``other``."""
    y = vectors if other is None else other
    for a in range(0, len(vectors), 500):
        near = vectors[a : a + 500] @ y.T >= cosine
        if other is None:
            near &= np.arange(a, a + len(near))[:, None] < np.arange(len(y))[None, :]
        i, j = np.nonzero(near)
        if len(i):
            yield i + a, j


def _labels(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    label = np.arange(n)
    changed = bool(pairs)
    while changed:
        changed = False
        for i, j in pairs:
            least = np.minimum(label[i], label[j])
            if (label[i] != least).any() or (label[j] != least).any():
                np.minimum.at(label, i, least)
                np.minimum.at(label, j, least)
                changed = True
        label = label[label]
    return label


def vector_links(
    vectors: DataFrame, cosine: float, vec_id: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors are scaled to length 1 and hashed into the buckets of several tables; the
    vectors of a bucket are compared by their cosine in double precision. A pair counts in
    the first table where it meets, so ``n_links`` is the number of other rows that a row was
    found to link with directly. ``component_id`` is the smallest id that links reach,
    ``kept`` says whether it is the row's own. The number of
    projections follows the number of rows, the number of tables the wanted recall
    (`RECALL` at the threshold itself, nearer pairs more).

    Equal vectors are one node that counts its rows, so they are never paired. A bucket of more
    than `TILE` nodes is dealt to tiles that are compared two by two; a task holds two
    tiles, and hands on counts and a few links, not pairs. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing (n_links 0, component_id their own id). Vectors of different
    dimensions do not link: each is compared with all of its own dimension. Null ids: null component, not kept, links counted. Rows that repeat an
    id are rows of their own. Empty tables give no rows; other columns are ignored.
    """
    kind = "array<float>" if dict(vectors.dtypes)[column] == "array<float>" else "array<double>"
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(column).cast(kind).alias("v"))
    sound = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    sound &= F.exists("v", lambda x: x != 0)
    marked = staged(
        own.withColumn("node", F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("v"))), "vector-rows"
    )
    valid = marked.filter("node IS NOT NULL")
    firsts = valid.groupBy("node").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("v").alias("v"))
    firsts = staged(firsts, "vector-nodes")
    hashing = Hashing.for_rows(firsts.count(), cosine)

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            sizes = pa.compute.list_value_length(vectors).to_numpy()
            found = np.zeros((len(vectors), hashing.tables), dtype=np.int32)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                found[own] = hashing.buckets(unit(vectors.take(pa.array(own)))[0])
            at = np.arange(0, found.size + 1, hashing.tables, dtype=np.int32)
            cells = pa.ListArray.from_arrays(pa.array(at), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=["node", "copies", "v", "cells"])

    hashed = firsts.select("node", "copies", "v").mapInArrow(
        bucket, f"node long, copies long, v {kind}, cells array<int>"
    )
    hashed = staged(hashed, "vector-buckets")
    places = hashed.select("node", F.size("v").alias("d"), F.posexplode("cells").alias("t", "cell"))
    held = places.groupBy("d", "t", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    held = held.select(F.col("d").alias("d_"), F.col("t").alias("t_"), F.col("cell").alias("cell_"), "n")
    held = staged(held, "vector-held")
    same = (F.col("d") == F.col("d_")) & (F.col("t") == F.col("t_")) & (F.col("cell") == F.col("cell_"))
    met = places.join(held, same)
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    mine = F.pmod(F.xxhash64("node"), tiles).cast("int")
    sides = (
        met.withColumns({"mine": mine, "other": F.explode(F.sequence(F.lit(0), tiles - 1))})
        .withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
        .select(F.col("node").alias("node_"), "d", "t", "cell", "low", "high", "mine")
    )
    dealt = (
        sides.join(hashed, F.col("node_") == F.col("node"))
        .select("d", "t", "cell", "low", "high", "mine", "node", "copies", "v", "cells")
        .repartition("d", "t", "cell", "low", "high")
        .sortWithinPartitions("d", "t", "cell", "low", "high")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Links of a node are summed over a task's buckets before they are handed on.
        out: dict[int, int] = {}
        a_side: list[int] = []
        b_side: list[int] = []
        for (_, t, _, low, high), group in contiguous(batches, ["d", "t", "cell", "low", "high"]):
            if group.num_rows < 2:
                continue
            node = group.column("node").to_numpy()
            copies = group.column("copies").to_numpy()
            cells = group.column("cells").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
            x, _ = unit(group.column("v").combine_chunks())
            if low == high:
                found = linked_pairs(x, cosine)
            else:
                first = np.flatnonzero(group.column("mine").to_numpy() == low)
                rest = np.flatnonzero(group.column("mine").to_numpy() == high)
                found = ((first[i], rest[j]) for i, j in linked_pairs(x[first], cosine, x[rest]))
            pairs, links = [], np.zeros(len(node), dtype=np.int64)
            for i, j in found:
                for s in range(0, len(i), 100_000):
                    p, q = i[s : s + 100_000], j[s : s + 100_000]
                    new = (cells[p] == cells[q]).argmax(axis=1) == t
                    p, q = p[new], q[new]
                    if len(p):
                        np.add.at(links, p, copies[q])
                        np.add.at(links, q, copies[p])
                        pairs.append((p, q))
            label = _labels(len(node), pairs)
            for i in np.flatnonzero(links).tolist():
                out[int(node[i])] = out.get(int(node[i]), 0) + int(links[i])
            for i in np.flatnonzero(label != np.arange(len(node))).tolist():
                a_side.append(int(node[i]))
                b_side.append(int(node[label[i]]))
            if len(out) + len(a_side) > 200_000:
                yield _found(out, a_side, b_side)
                out, a_side, b_side = {}, [], []
        yield _found(out, a_side, b_side)

    found = staged(dealt.mapInArrow(compare, "a long, b long, links long"), "vector-links")
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    linked = kept(components(found.filter("b IS NOT NULL").select("a", "b"), "vector"), "vector-parts")
    nodes = (
        smallest_member(firsts.select("node", "first"), linked, "vector")
        .join(firsts.select("node", "copies"), "node")
        .join(counts.withColumnRenamed("a", "node"), "node", "left")
        .select(F.col("node").alias("n"), "smallest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    told = marked.join(staged(nodes, "vector-results"), F.col("node") == F.col("n"), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("smallest", "vec_id"))
    return told.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _found(counts: dict[int, int], a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*counts, *a], pa.int64()),
            pa.array([*[None] * len(counts), *b], pa.int64()),
            pa.array([*counts.values(), *[None] * len(a)], pa.int64()),
        ],
        names=["a", "b", "links"],
    )
