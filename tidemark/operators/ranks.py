"""Global ranks without a global window.

`ntile(k) OVER (ORDER BY v)` moves every row to one task. Here only the rows that
end a tile are looked up: sort keys are range-partitioned, partitions counted, and
the few partitions holding a wanted rank are numbered. The rest is a comparison of
each row with those few sort keys.
"""

from __future__ import annotations

import functools
import operator
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import staged, staging


def rows_at_ranks(
    df: DataFrame,
    order_by: Sequence[str],
    wanted: Mapping[object, Callable[[int], list[int]]],
    group: str | None = None,
) -> dict[object, dict[int, Row]]:
    """Find the rows standing at given ranks of an ascending order (NULLs first).

    ``order_by`` must be unique per row (within ``group``). ``wanted`` maps each
    group to a function from the group's row count to the 1-based ranks asked for.
    Runs jobs; what reaches the driver is one count per range partition and the
    wanted rows themselves.
    """
    spark = df.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    group_cols = [group] if group else []
    ranged = (
        df.select(*group_cols, *order_by)
        .repartitionByRange(parts, *group_cols, *order_by)
        .withColumn("_part", F.spark_partition_id())
    )
    # The partition number is stored with the rows: a second run could sample
    # other range bounds.
    with staging(ranged, "ranges") as ranges:
        return _rows_in_ranges(ranges, order_by, wanted, group)


def _rows_in_ranges(
    ranges: DataFrame,
    order_by: Sequence[str],
    wanted: Mapping[object, Callable[[int], list[int]]],
    group: str | None,
) -> dict[object, dict[int, Row]]:
    group_cols = [group] if group else []

    def group_of(row: Row) -> object:
        return row[group] if group else None

    sizes: dict[object, dict[int, int]] = defaultdict(dict)
    for row in ranges.groupBy(*group_cols, "_part").count().collect():
        sizes[group_of(row)][row["_part"]] = row["count"]

    # (group, partition, position in it) -> global rank
    picks: dict[tuple[object, int, int], int] = {}
    for name, parts in sizes.items():
        ranks = set(wanted[name](sum(parts.values())))
        before = 0
        for part, rows in sorted(parts.items()):
            for rank in ranks:
                if before < rank <= before + rows:
                    picks[name, part, rank - before] = rank
            before += rows
    found: dict[object, dict[int, Row]] = defaultdict(dict)
    if not picks:
        return found

    def at(name: object, part: int, position: int) -> Column:
        here = (F.col("_part") == part) & (F.col("_position") == position)
        return here & (F.col(group) == name) if group else here

    in_part = Window.partitionBy(*group_cols, "_part").orderBy(*order_by)
    hits = (
        ranges.filter(F.col("_part").isin(sorted({part for _, part, _ in picks})))
        .withColumn("_position", F.row_number().over(in_part))
        .filter(functools.reduce(operator.or_, [at(*pick) for pick in picks]))
    )
    for row in hits.collect():
        name = group_of(row)
        found[name][picks[name, row["_part"], row["_position"]]] = row
    return found


def _tile_ends(rows: int, k: int) -> list[int]:
    """Last rank of each tile but the final one; the first ``rows % k`` tiles get one more."""
    size, larger = divmod(rows, k)
    return [i * size + min(i, larger) for i in range(1, k) if i * size + min(i, larger) > 0]


def _sort_kind(kind: T.DataType) -> str:
    """The type a value is sorted as: wide decimals only where there are decimals."""
    if isinstance(kind, T.IntegralType):
        return "bigint"
    if isinstance(kind, T.DecimalType):
        return kind.simpleString()
    return "double"


def add_ntiles(
    df: DataFrame,
    tie_break: str,
    k: int,
    tiles: Mapping[str, tuple[str, bool]],
) -> DataFrame:
    """Add `ntile(k)` columns, several orders at once.

    ``tiles`` maps each new column to (numeric source column, descending).
    ``tie_break`` is a unique column that settles equal values, ascending; it also
    spreads a value shared by many rows over many range partitions.
    Stages ``df`` and runs jobs; see `rows_at_ranks`.
    """
    base = staged(df, "ntile-input")
    kinds = {name: _sort_kind(base.schema[source].dataType) for name, (source, _) in tiles.items()}
    # One sort column per kind of value, so that all orders go through one shuffle.
    value_cols = {kind: f"_value{i}" for i, kind in enumerate(sorted(set(kinds.values())))}
    order = ["_mark", *value_cols.values(), "_tie"]

    def sort_key(name: str) -> dict[str, Column]:
        """Sorts ascending like the order asked for: NULLs first, or last if descending."""
        source, descending = tiles[name]
        value = F.col(source).cast(kinds[name])
        key = {"_mark": value.isNull() if descending else value.isNotNull()}
        for kind, column in value_cols.items():
            key[column] = F.lit(None).cast(kind)
        key[value_cols[kinds[name]]] = -value if descending else value
        return key | {"_tie": F.col(tie_break)}

    keys = base.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(number).alias("_tile"),
                        *[column.alias(name) for name, column in sort_key(tile).items()],
                    )
                    for number, tile in enumerate(tiles)
                ]
            )
        )
    )
    ends = rows_at_ranks(
        keys,
        order,
        {number: lambda n: _tile_ends(n, k) for number in range(len(tiles))},
        group="_tile",
    )

    columns = {}
    for number, name in enumerate(tiles):
        used = ["_mark", value_cols[kinds[name]], "_tie"]
        key = sort_key(name)
        this = F.struct(*[key[c].alias(c) for c in used])
        passed = [
            this > F.struct(*[F.lit(end[c]).cast(keys.schema[c].dataType).alias(c) for c in used])
            for end in ends[number].values()
        ]
        columns[name] = functools.reduce(operator.add, [p.cast("int") for p in passed], F.lit(1))
    return base.withColumns(columns)
