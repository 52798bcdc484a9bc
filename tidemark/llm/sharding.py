"""Balanced shards by sampled splitters, with DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import share, values
from tidemark.session import staged

SCHEMA = (
    "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"
)

# Ranges cut by the sampled splitters; a power of two, for the search below.
RANGES = 256
# Expected size of the key sample.
SAMPLE_ROWS = 50_000
# Cells per shard: what an overfull range is divided into, and the unit that is dealt out.
CELLS = 256
# A group of equal texts is looked at on its own from this part of a shard on.
HEAVY = 64


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the key, by binary search in a literal array."""
    padded = bounds + [2**63 - 1] * (RANGES - 1 - len(bounds))
    held = F.expr("array(" + ",".join(f"{b}L" if b > -(2**63) else "-9223372036854775807L" for b in padded) + ")")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(int(math.log2(RANGES))))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(key >= F.get(held, at + step - 1), at + step).otherwise(at),
    )


def _deal(
    groups: list[tuple[int, int]], cells: dict[int, tuple[int, int, int | None]], shards: int
) -> dict[int, int]:
    """Cell -> shard. ``cells``: cell -> (bytes, rows, key of its group or None).

    Groups that fit are put whole, largest first, into the shard with the least in it; all
    other cells then fill what is left of the shards, in key order.
    """
    total = sum(size for size, _, _ in cells.values())
    room = [total / shards] * shards
    whole: dict[int, int] = {}
    for key, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        to = max(range(shards), key=lambda s: (room[s], -s))
        if size <= room[to]:
            whole[key] = to
            room[to] -= size
    ends, end = [], 0.0
    for r in room:
        end += r
        ends.append(end)
    dealt, filled, at = {}, 0, 0
    for cell in sorted(cells):
        size, _, key = cells[cell]
        if key in whole:
            dealt[cell] = whole[key]
            continue
        while at < shards - 1 and filled + size / 2 > ends[at]:
            at += 1
        dealt[cell] = at
        filled += size
    return dealt


def shard_by_bytes(
    docs: DataFrame,
    shards: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every row with its shard 0 .. ``shards - 1``: sizes near equal, equal texts together.

    A row's size is the UTF-8 bytes of its text (null: none) plus 1. The key is a 64-bit
    hash of the text, so copies are neighbours. A size-weighted sample of `SAMPLE_ROWS`
    expected keys gives quantile splitters for `RANGES` ranges; the exact bytes of each
    range are counted, and a range above 1 / `CELLS` of a shard is subdivided into cells.
    Cells are dealt to shards in key order, so a shard is off by at most half a cell.
    Groups of equal texts above 1 / `HEAVY` of a shard's mean bytes or rows (at most
    ``2 * shards * HEAVY`` of them) are counted on their own and divided into cells by a hash of
    the id, by their rows; one that fits a shard stays whole in it, any other is cut. ``slot`` numbers a shard's rows from 0: the rows of the cells before it plus
    the row's number in its cell, so no task ever holds a shard.

    Columns: doc_id, size, text_crc32 (null text: of no bytes, 0), law ('bytes'), shard,
    slot, grown_shard (null: the law is not by key). Rows with a null id or text are dealt like any other, repeated rows each
    get a slot of their own, an empty table gives no rows, and further columns of the
    input are not looked at.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = staged(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        ),
        "shard-keys",
    )
    total, rows = keyed.agg(F.sum("size"), F.count("*")).first()
    if not rows:
        return spark.createDataFrame([], SCHEMA)

    by_text = keyed.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    large = (F.col("bytes") * (shards * HEAVY) > total) | (F.col("n") * (shards * HEAVY) > rows)
    groups = by_text.filter(large).collect()
    parts = {g.key: max(1, math.ceil(g.n * shards * CELLS / rows)) for g in groups}
    heavy = values(spark, "heavy long, parts int", parts.items())
    tagged = keyed.join(F.broadcast(heavy), keyed.key == heavy.heavy, "left")

    light = tagged.filter("heavy IS NULL")
    drawn = light.filter(share("key", "doc_id") < F.col("size") * (SAMPLE_ROWS / total))
    at = ",".join(str(k / RANGES) for k in range(1, RANGES))
    bounds = drawn.agg(F.expr(f"percentile_approx(key, array({at}), 1000000)")).first()[0]
    bounds = sorted(set(bounds or []))
    ranged = tagged.withColumn("range", _range_of(F.col("key"), bounds))

    filled = dict(
        ranged.filter("heavy IS NULL").groupBy("range").agg(F.sum("size")).collect()
    )
    edges = [-(2.0**63), *map(float, bounds), 2.0**63]
    target = total / (shards * CELLS)
    cuts, first = [], 0
    for r in range(len(bounds) + 1):
        cut = max(1, math.ceil(filled.get(r, 0) / target))
        cuts.append((r, edges[r], max(1.0, edges[r + 1] - edges[r]), cut, first))
        first += cut
    starts = {}
    for key in sorted(parts):
        starts[key] = first
        first += parts[key]
    ranges = values(spark, "range int, low double, width double, cuts int, first int", cuts)
    heavy = values(
        spark, "heavy long, parts int, start int", [(k, n, starts[k]) for k, n in parts.items()]
    )
    part = F.pmod(F.xxhash64("doc_id", "key"), F.col("parts"))
    place = (F.col("key").cast("double") - F.col("low")) * F.col("cuts") / F.col("width")
    celled = staged(
        ranged.drop("parts")
        .join(F.broadcast(ranges), "range")
        .join(F.broadcast(heavy), "heavy", "left")
        .withColumn(
            "cell",
            F.when(F.col("parts").isNotNull(), F.col("start") + part)
            .otherwise(F.col("first") + F.least(F.col("cuts") - 1, F.greatest(F.lit(0), F.floor(place))))
            .cast("int"),
        )
        .select("doc_id", "size", "text_crc32", "key", "cell"),
        "shard-cells",
    )

    owner = {starts[k] + p: k for k, n in parts.items() for p in range(n)}
    counted = celled.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    cells = {c.cell: (c.bytes, c.n, owner.get(c.cell)) for c in counted.collect()}
    dealt = _deal([(g.key, g.bytes) for g in groups], cells, shards)
    offsets, used = [], [0] * shards
    for cell in sorted(cells):
        offsets.append((cell, dealt[cell], used[dealt[cell]]))
        used[dealt[cell]] += cells[cell][1]
    plan = values(spark, "cell int, shard int, offset long", offsets)
    within = Window.partitionBy("cell").orderBy("key", "doc_id", "size")
    return (
        celled.withColumn("number", F.row_number().over(within))
        .join(F.broadcast(plan), "cell")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("number") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
