"""Hard negatives of anchor vectors: one-bit codes bound inner products, integers decide."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import share
from tidemark.session import scratch_path, staged

SEED = 11
# Bits of a component of an anchor: its code's planes.
PLANES = 6
# Bytes of the anchors (as doubles) that go through the rows in one pass.
PASS_BYTES = 16 << 20
# Rows of a task that are compared at once with so many anchors.
ROWS, ANCHORS = 4096, 512
# From this share of a block's pairs on, all of the block is scored by one product.
DENSE = 0.02
# A row with a square norm beyond this has scores that no long holds.
MOST_SQUARES = 2.0**62
# Rounding of the bounds, relative to the product of the norms: far above what doubles lose.
SLACK = 1e-9

_NO_SCORE = np.iinfo(np.int64).min


def rotation(size: int) -> np.ndarray:
    """The same random orthogonal matrix in every task."""
    raw = np.random.default_rng(SEED).standard_normal((size, size))
    q, r = np.linalg.qr(raw)
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Booleans of the last axis as 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    wide = np.zeros((*packed.shape[:-1], -(-max(packed.shape[-1], 1) // 8) * 8), dtype=np.uint8)
    wide[..., : packed.shape[-1]] = packed
    return wide.view(np.uint64)


@dataclass(frozen=True)
class Codes:
    """Rows as the signs of their rotated components, with what the signs leave open.

    A row is norm * u; u is ``aligned`` * c + the rest, where c is the vector of signs over the
    square root of the dimension and the rest is orthogonal to c.
    """

    signs: np.ndarray  # (rows, words)
    norm: np.ndarray
    aligned: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, turn: np.ndarray) -> Codes:
        turned = x.astype(np.float64) @ turn.T
        norm = np.sqrt((turned * turned).sum(axis=1))
        ones = np.abs(turned).sum(axis=1) / np.sqrt(max(x.shape[1], 1))
        aligned = np.divide(ones, norm, out=np.zeros_like(norm), where=norm > 0)
        return cls(_words(turned > 0), norm, np.minimum(aligned, 1.0))


@dataclass(frozen=True)
class Questions:
    """Anchors as planes of bits of their rotated components, rounded to steps."""

    planes: np.ndarray  # (anchors, PLANES, words)
    least: np.ndarray
    step: np.ndarray
    total: np.ndarray  # sum of the rounded components
    lost: np.ndarray  # length of what the rounding left out
    norm: np.ndarray
    size: int

    @classmethod
    def of(cls, x: np.ndarray, turn: np.ndarray) -> Questions:
        turned = x.astype(np.float64) @ turn.T
        least = turned.min(axis=1, initial=0.0)
        step = (turned.max(axis=1, initial=0.0) - least) / (2**PLANES - 1)
        units = np.divide(turned - least[:, None], step[:, None], out=np.zeros_like(turned), where=step[:, None] > 0)
        units = np.clip(np.rint(units), 0, 2**PLANES - 1)
        rounded = least[:, None] + step[:, None] * units
        levels = units.astype(np.uint8)
        planes = np.stack([_words((levels >> k & 1).astype(bool)) for k in range(PLANES)], axis=1)
        lost = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
        norm = np.sqrt((turned * turned).sum(axis=1))
        return cls(planes, least, step, rounded.sum(axis=1), lost, norm, x.shape[1])

    def take(self, at: np.ndarray) -> Questions:
        held = (self.planes, self.least, self.step, self.total, self.lost, self.norm)
        return Questions(*(v[at] for v in held), self.size)

    def bounds(self, rows: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Least and most inner product of every anchor with every row.

        Popcounts of the rows' signs under the planes give the product t of rounded anchor and
        c; that of the anchor itself lies within ``lost`` of it. The rest of u, of length
        sqrt(1 - aligned^2), meets only the part of the anchor orthogonal to c, of length
        sqrt(norm^2 - t^2): by Cauchy and Schwarz it moves the product by no more than both.
        """
        weighed = np.zeros((len(self.norm), len(rows.norm)))
        for k in range(PLANES):
            both = self.planes[:, None, k, :] & rows.signs[None, :, :]
            weighed += np.bitwise_count(both).sum(axis=2, dtype=np.int32) * float(1 << k)
        ups = np.bitwise_count(rows.signs).sum(axis=1, dtype=np.int32)
        t = 2 * (self.least[:, None] * ups + self.step[:, None] * weighed) - self.total[:, None]
        t /= np.sqrt(max(self.size, 1))
        lost = self.lost[:, None]
        across = np.sqrt(np.maximum(self.norm[:, None] ** 2 - np.maximum(np.abs(t) - lost, 0) ** 2, 0))
        open_ = np.sqrt(1 - rows.aligned**2) * across + SLACK * self.norm[:, None]
        return rows.norm * (rows.aligned * (t - lost) - open_), rows.norm * (rows.aligned * (t + lost) + open_)


def integer_scores(x: np.ndarray, y: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Exact inner products where wanted, `_NO_SCORE` elsewhere.

    Products of doubles are exact while no partial sum passes 2^53, which the norms tell;
    beyond, 64-bit integers are, as the final sums fit them.
    """
    out = np.full(wanted.shape, _NO_SCORE, dtype=np.int64)
    n = np.count_nonzero(wanted)
    if not n:
        return out
    if n < DENSE * wanted.size:
        i, j = np.nonzero(wanted)
        out[i, j] = np.einsum("ij,ij->i", x[i], y[j])
        return out
    longest = [np.sqrt((v.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)) for v in (x, y)]
    if longest[0] * longest[1] < 2.0**52:
        product = (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    else:
        product = x @ y.T
    np.copyto(out, product, where=wanted)
    return out


@dataclass
class Best:
    """The ``most`` best (score, then smaller id) rows of every slot seen so far."""

    slots: int
    most: int
    slot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ident: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    row: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __post_init__(self) -> None:
        # A score below this is not among a slot's best; `_NO_SCORE` while there are fewer.
        self.bar = np.full(self.slots, _NO_SCORE, dtype=np.int64)

    def offer(self, slots: np.ndarray, scores: np.ndarray, ident: np.ndarray, row: np.ndarray) -> None:
        """Scores of some slots (rows) with some rows (columns); `_NO_SCORE` is none."""
        if not scores.size:
            return
        bar = self.bar[slots]
        if scores.shape[1] > self.most:
            bar = np.maximum(bar, np.partition(scores, -self.most, axis=1)[:, -self.most])
        i, j = np.nonzero((scores >= bar[:, None]) & (scores != _NO_SCORE))
        if not len(i):
            return
        self.slot = np.concatenate([self.slot, slots[i]])
        self.score = np.concatenate([self.score, scores[i, j]])
        self.ident = np.concatenate([self.ident, ident[j]])
        self.row = np.concatenate([self.row, row[j]])
        order = np.lexsort((self.row, self.ident, -self.score, self.slot))
        slot = self.slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order = order[rank < self.most]
        self.slot, self.score, self.ident, self.row = (
            v[order] for v in (self.slot, self.score, self.ident, self.row)
        )
        full = np.flatnonzero(rank[rank < self.most] == self.most - 1)
        self.bar[self.slot[full]] = self.score[full]


_NULL_ID = np.iinfo(np.int64).max

_STORED = "row long, ident long, label long, v array<long>, signs array<long>, norm double, aligned double"


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with its code; batches may mix dimensions."""
    turns: dict[int, np.ndarray] = {}
    for batch in batches:
        sizes = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
        for size in np.unique(sizes).tolist():
            own = batch.filter(pa.array(sizes == size))
            turn = turns.setdefault(size, rotation(size))
            numbers = own.column("v").flatten().to_numpy(zero_copy_only=False)
            codes = Codes.of(numbers.reshape(own.num_rows, size), turn)
            words = codes.signs.view(np.int64)
            at = np.arange(0, words.size + 1, words.shape[1], dtype=np.int32)
            signs = pa.ListArray.from_arrays(pa.array(at), pa.array(words.ravel()))
            columns = [*own.columns, signs, pa.array(codes.norm), pa.array(codes.aligned)]
            yield pa.RecordBatch.from_arrays(columns, names=[*own.schema.names, "signs", "norm", "aligned"])


@dataclass(frozen=True)
class Block:
    """Some rows of one dimension, as a task or the driver holds them."""

    row: np.ndarray
    ident: np.ndarray
    label: np.ndarray
    v: np.ndarray
    codes: Codes

    @classmethod
    def of(cls, table: pa.Table, size: int) -> Block:
        table = table.combine_chunks()

        def numbers(name: str) -> np.ndarray:
            return table.column(name).to_numpy()

        def matrix(name: str, kind: type, width: int) -> np.ndarray:
            flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return flat.view(kind).reshape(table.num_rows, width)

        words = max(-(-size // 64), 1)
        codes = Codes(matrix("signs", np.uint64, words), numbers("norm"), numbers("aligned"))
        return cls(numbers("row"), numbers("ident"), numbers("label"), matrix("v", np.int64, size), codes)

    def take(self, at: np.ndarray) -> Block:
        codes = Codes(self.codes.signs[at], self.codes.norm[at], self.codes.aligned[at])
        return Block(self.row[at], self.ident[at], self.label[at], self.v[at], codes)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    parts, held = [], 0
    for batch in batches:
        parts.append(batch)
        held += batch.num_rows
        if held >= ROWS:
            yield Block.of(pa.Table.from_batches(parts), size)
            parts, held = [], 0
    if held:
        yield Block.of(pa.Table.from_batches(parts), size)


Search = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_FOUND = "slot long, score long, ident long, row long"


def _handed(best: Best) -> pa.RecordBatch:
    columns = [pa.array(v) for v in (best.slot, best.score, best.ident, best.row)]
    return pa.RecordBatch.from_arrays(columns, names=["slot", "score", "ident", "row"])


def _positives(anchors: Block, size: int, most: int) -> Search:
    """The best other rows of the anchor's label; a slot is an anchor."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = Questions.of(anchors.v, rotation(size))
        best = Best(len(anchors.row), most)
        order = np.argsort(anchors.label, kind="stable")
        for block in _blocks(batches, size):
            for label in np.intersect1d(anchors.label, block.label).tolist():
                rows = block.take(np.flatnonzero(block.label == label))
                mine = order[np.searchsorted(anchors.label[order], label) :]
                mine = mine[anchors.label[mine] == label]
                for a in range(0, len(mine), ANCHORS):
                    at = mine[a : a + ANCHORS]
                    _, upper = questions.take(at).bounds(rows.codes)
                    wanted = upper >= best.bar[at].astype(np.float64)[:, None]
                    wanted &= anchors.row[at][:, None] != rows.row[None, :]
                    best.offer(at, integer_scores(anchors.v[at], rows.v, wanted), rows.ident, rows.row)
        yield _handed(best)

    return search


def _negatives(anchors: Block, size: int, most: int, low: np.ndarray, high: np.ndarray) -> Search:
    """The best rows of other labels in the windows ``low`` to ``high``, a column per positive of
    the anchor; slot: anchor times columns plus column. A window without a positive is empty."""
    columns = low.shape[1]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = Questions.of(anchors.v, rotation(size))
        best = Best(low.size, most)
        for rows in _blocks(batches, size):
            for a in range(0, len(anchors.row), ANCHORS):
                b = min(a + ANCHORS, len(anchors.row))
                lower, upper = questions.take(np.arange(a, b)).bounds(rows.codes)
                slots = np.arange(a, b)[:, None] * columns + np.arange(columns)
                floor = np.maximum(best.bar[slots], low[a:b]).astype(np.float64)
                wanted = np.zeros(lower.shape, dtype=bool)
                for k in range(columns):
                    wanted |= (upper >= floor[:, k : k + 1]) & (lower <= high[a:b, k : k + 1])
                wanted &= anchors.label[a:b][:, None] != rows.label[None, :]
                scores = integer_scores(anchors.v[a:b], rows.v, wanted)
                for k in range(columns):
                    inside = (scores >= low[a:b, k : k + 1]) & (scores <= high[a:b, k : k + 1])
                    best.offer(slots[:, k], np.where(inside, scores, _NO_SCORE), rows.ident, rows.row)
        yield _handed(best)

    return search


def _first(found: DataFrame, most: int) -> DataFrame:
    """The ``most`` best of each slot over all tasks, with their rank from 1."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "ident", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def prepared(vectors: DataFrame, anchor: Column, vec_id: str, column: str, label: str, scale: int) -> DataFrame:
    """Rows that take part, as integers, with an ``asked`` flag and a number of their own."""
    parts = F.col("__v")
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    raw = vectors.select(
        F.col(vec_id).cast("long").alias("ident"),
        F.col(label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("asked"),
        F.col(column).cast("array<double>").alias("__v"),
    ).filter(F.col("label").isNotNull() & parts.isNotNull() & sound)
    squares = F.aggregate(parts, F.lit(0.0), lambda s, x: s + F.pow(F.abs(x) * scale + 1, F.lit(2.0)))
    return raw.filter(squares < MOST_SQUARES).select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce("ident", F.lit(_NULL_ID)).alias("ident"),
        "label",
        F.transform(parts, lambda x: F.floor(x * scale)).alias("v"),
        "asked",
    )


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = 256,
    vec_id: str = "vec_id",
    column: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per anchor and positive the first negatives: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Components become floor(``scale`` * x), scores are integer inner products, higher first,
    ties by smaller id. The positives of an ``anchor`` row are its best other rows of its label,
    and the negatives of a positive the best rows of other labels whose score is from
    ``window[0]`` to ``window[1]`` percent of the positive's. Anchors without a positive, and
    positives without a negative, give no row.

    All rows are coded once: randomly rotated, each keeps a bit per component, its norm and how
    far the vector of bits points its way. The anchors, a share of the rows, go through all
    rows in passes of `PASS_BYTES`, so what a task gets with its code has a fixed bound
    however many there are. In a pass, popcounts of an anchor's bit planes
    with the codes give an interval that holds the score for certain; a pair whose interval misses what
    can still count is done, all others are scored as integers. A task keeps the best few per slot,
    which a row number then brings together. Nothing is pruned by chance, so results are exact.

    Left out: rows with a null label or vector, with null or non-finite components, or so long that
    scores could pass 64 bits. Vectors of different dimensions do not meet. Null ids are no
    anchors unless ``anchor`` says so, come after all others in ties and stay null. Repeated rows are rows
    of their own: each is an anchor, and another row for its copies. Zero and empty vectors
    score 0. Empty tables give no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    plain = staged(prepared(vectors, anchor, vec_id, column, label, scale), "anchor-rows")
    whole = "row long, ident long, label long, v array<long>, asked boolean, signs array<long>, norm double, aligned double"
    rows = staged(plain.mapInArrow(_coded, whole), "anchor-codes")
    path = scratch_path(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    sizes = {r.size: r.n for r in rows.filter("asked").groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).collect()}
    k = 0
    for size, n in sorted(sizes.items()):
        own = rows.filter(F.size("v") == size)
        passes = -(-n * 8 * max(size, 1) // PASS_BYTES)
        for p in range(passes):
            one = own.filter(F.col("asked") & (F.floor(share("row") * passes) == p)).select(*_names(_STORED))
            anchors = Block.of(one.toArrow(), size)
            if len(anchors.row):
                _pass(own.select(*_names(_STORED)), anchors, size, positives, negatives, window, f"{path}/pass={k}")
            k += 1
    if not k:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/pass=*")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _pass(
    rows: DataFrame, anchors: Block, size: int, positives: int, negatives: int, window: tuple[int, int], path: str
) -> None:
    """Write the negatives of some anchors."""
    spark = rows.sparkSession
    best = _first(rows.mapInArrow(_positives(anchors, size, positives), _FOUND), positives).toArrow()
    slot, rank = best.column("slot").to_numpy(), best.column("rank").to_numpy() - 1
    score = np.zeros((len(anchors.row), positives), dtype=np.int64)
    ident = np.zeros_like(score)
    there = np.zeros(score.shape, dtype=bool)
    score[slot, rank] = best.column("score").to_numpy()
    ident[slot, rank] = best.column("ident").to_numpy()
    # Nothing is between half and nearly all of a number below 0.
    there[slot, rank] = best.column("score").to_numpy() >= 0
    low = np.where(there, _share(score, window[0], up=True), 1)
    high = np.where(there, _share(score, window[1], up=False), 0)
    named = pa.table(
        {
            "slot": np.arange(score.size),
            "anchor_id": np.repeat(anchors.ident, positives),
            "positive_id": ident.ravel(),
            "positive_score": score.ravel(),
        }
    )
    found = _first(rows.mapInArrow(_negatives(anchors, size, negatives, low, high), _FOUND), negatives)
    given = F.broadcast(spark.createDataFrame(named))
    ids = {c: F.nullif(F.col(c), F.lit(_NULL_ID)) for c in ("anchor_id", "positive_id")}
    told = found.join(given, "slot").select(
        ids["anchor_id"].alias("anchor_id"),
        ids["positive_id"].alias("positive_id"),
        F.col("rank").cast("int"),
        F.nullif(F.col("ident"), F.lit(_NULL_ID)).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
    told.write.mode("overwrite").parquet(path)


def _share(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """percent / 100 of whole numbers, rounded up or down, without leaving 64 bits."""
    whole, rest = np.divmod(score, 100)
    return whole * percent + (-(-rest * percent // 100) if up else rest * percent // 100)
