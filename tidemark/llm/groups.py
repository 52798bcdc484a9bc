"""Work on groups of bounded size: contiguous groups of a stream, union-find, labels."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept


def contiguous(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The groups of a stream whose rows come sorted by ``keys``, one at a time."""
    now, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            key = tuple(c[a].item() for c in columns)
            if key != now and parts:
                yield now, pa.Table.from_batches(parts)
                parts = []
            now = key
            parts.append(batch.slice(a, b - a))
    if parts:
        yield now, pa.Table.from_batches(parts)


class Sets:
    """Disjoint sets of 0 .. n - 1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True

    def labels(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], dtype=np.int64)


def smallest_member(firsts: DataFrame, linked: DataFrame, label: str) -> DataFrame:
    """(node, smallest): the smallest ``first`` of each node's component.

    ``firsts`` has node and first; ``linked`` is node and component for nodes with links.
    """
    labelled = firsts.join(linked, "node", "left").select(
        "node", "first", F.coalesce("component", "node").alias("label")
    )
    labelled = kept(labelled, f"{label}-labels")
    least = kept(
        labelled.groupBy("label").agg(F.min("first").alias("smallest")).withColumnRenamed("label", "l"),
        f"{label}-smallest",
    )
    return labelled.join(least, F.col("label") == F.col("l")).select("node", "smallest")
