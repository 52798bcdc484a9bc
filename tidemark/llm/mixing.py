"""Mixing a corpus to target weights: iterative proportional fitting, then sampling."""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import share, values
from tidemark.session import free, staged

# A sweep adjusts to every marginal once. Where so many do not halve what the weights still move
# by, the targets contradict each other or the bound on the weights, and the fitting ends.
PATIENCE = 10
# Largest relative change of a cell's weight in a sweep at which the fitting ends: far below
# what the sampling itself moves a marginal.
TOLERANCE = 1e-3

# Stands for a null source, language or topic, which is a category like any other.
NONE = "∅"

OTHER_TOPIC = "prose"

Margin = Mapping[str, float] | float


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def topic_of(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The first topic whose pattern the text has, else `OTHER_TOPIC` (so for null)."""
    found: Column = F.lit(OTHER_TOPIC)
    for topic, pattern in reversed(rules):
        found = F.when(text.rlike(pattern), topic).otherwise(found)
    return found


def _targets(cells: DataFrame, column: str, margin: Margin) -> DataFrame:
    """(value, goal): the share of all tokens that each value of a column is to have.

    A number is an exponent: shares go as the present ones to that power. A mapping names
    shares; values it doesn't name divide what it leaves as they stand to each other now.
    """
    spark = cells.sparkSession
    now = cells.groupBy(column).agg(F.sum("tokens").alias("held")).filter("held > 0")
    now = now.withColumnRenamed(column, "value")
    if isinstance(margin, Mapping):
        rows = [(k, float(v)) for k, v in sorted(margin.items())]
        named = values(spark, "value string, named double", rows)
        left = max(0.0, 1.0 - sum(margin.values()))
        joined = now.join(F.broadcast(named), "value", "left")
        rest = joined.filter("named IS NULL").agg(F.sum("held")).first()[0] or 0
        raw = F.coalesce("named", F.col("held") * F.lit(left / rest if rest else 0.0))
        now = joined.withColumn("raw", raw)
    else:
        now = now.withColumn("raw", F.pow("held", F.lit(float(margin))))
    total = now.agg(F.sum("raw")).first()[0]
    goal = F.col("raw") / F.lit(total or 1.0)
    return staged(now.select("value", goal.alias("goal")), "mix-targets")


def rake(cells: DataFrame, margins: Mapping[str, Margin], most: float | None = None) -> DataFrame:
    """``cells`` with a ``weight`` per cell, so that weighted tokens meet every marginal.

    Weights have mean 1 over the tokens, and none is above ``most``: a cell that would be
    stays there, and the others of its marginals make up for it as far as they can. Each
    sweep scales the cells of every value of every column to the value's goal, and is
    written to the shared folder; the fitting ends when no weight moves by more than
    `TOLERANCE`. Where the targets can't all be met the weights come to no rest: once
    `PATIENCE` sweeps make little progress the last ones are returned, with a warning. All of it is
    aggregation and joins of the table of cells, which has a row per combination seen in
    the corpus; the driver gets two numbers per sweep.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    now = cells.withColumn("weight", F.lit(1.0))
    if not total:
        return now
    goals = {column: _targets(cells, column, margin) for column, margin in margins.items()}
    before = float("inf")
    for sweep in itertools.count(1):
        step = now.withColumn("before", F.col("weight"))
        for k, (column, goal) in enumerate(goals.items()):
            held = step.groupBy(column).agg(F.sum(F.col("weight") * F.col("tokens")).alias("held"))
            factor = goal.join(held, F.col("value") == F.col(column)).select(
                F.col("value").alias(f"value{k}"),
                F.when(F.col("held") > 0, F.col("goal") * F.lit(total) / F.col("held"))
                .otherwise(1.0)
                .alias(f"factor{k}"),
            )
            step = step.join(factor, F.col(column) == F.col(f"value{k}"), "left")
            scaled = F.col("weight") * F.coalesce(f"factor{k}", F.lit(1.0))
            capped = scaled if most is None else F.least(scaled, F.lit(float(most)))
            step = step.withColumn("weight", capped)
        last, now = now, staged(step.select(*cells.columns, "weight", "before"), "mix-sweep")
        free(last)
        moved = F.max(F.abs(F.col("weight") / F.col("before") - 1))
        largest = now.filter("tokens > 0 AND before > 0").agg(moved).first()[0] or 0.0
        if largest <= TOLERANCE:
            return now.drop("before")
        if sweep % PATIENCE == 0:
            if largest > before / 2:
                said = f"the targets cannot all be met: weights still move by {largest:.3g} a sweep"
                warnings.warn(said, stacklevel=2)
                return now.drop("before")
            before = largest


def mixed(
    docs: DataFrame,
    margins: Mapping[str, Margin],
    keep: float,
    topics: Sequence[tuple[str, str]] = (),
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 0,
    keep_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Documents with ``__topic``, ``__tokens``, ``__weight``, ``__probability``, ``__kept``.

    ``margins`` maps columns of ``docs``, or "topic" (by `topic_of` with ``topics``), to
    targets (see `_targets`). A document's probability is its cell's raked weight times
    ``keep``, the share of all tokens that is wanted; weights are raked with 1 / ``keep``
    as the most, so no probability passes 1 and the kept tokens meet the marginals in
    expectation, as far as a cell that is kept whole allows.
    The decision is a hash of id and text: it is the same in every run, and repeated rows
    are kept or left together.

    Null marginal values are a category of their own. Null and empty texts have 0 tokens
    and take their cell's probability. Long texts
    are counted whole. An empty table gives no rows. The columns ``keep_columns`` of the
    input stay (none given: all); those of the five names above are replaced.

    The texts are gone through once: topics, word counts and hashes are written to the shared
    folder with the columns that stay, and everything after reads those.
    """
    own = ("__topic", "__tokens", "__weight", "__probability", "__kept")
    stay = [c for c in (docs.columns if keep_columns is None else keep_columns) if c not in own]
    keys = {f"__key{k}": F.col("__topic" if c == "topic" else c) for k, c in enumerate(margins)}
    told = docs.drop(*own).withColumns(
        {
            "__topic": topic_of(F.col(text), topics),
            "__tokens": word_count(F.col(text)),
            "__share": share(doc_id, text, seed=seed + 1),
        }
    )
    named = [F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in keys.items()]
    keyed = staged(told.select(*stay, "__topic", "__tokens", "__share", *named), "mix-rows")
    counted = keyed.groupBy(*keys).agg(F.sum("__tokens").alias("tokens"))
    cells = rake(staged(counted, "mix-cells"), dict(zip(keys, margins.values(), strict=True)), 1.0 / keep)
    weights = cells.select(*[F.col(n).alias(f"{n}_") for n in keys], F.col("weight").alias("__weight"))
    same = [F.col(n) == F.col(f"{n}_") for n in keys]
    probability = F.least(F.lit(1.0), F.col("__weight") * F.lit(keep))
    return (
        keyed.join(weights, same)
        .withColumn("__probability", probability)
        .withColumn("__kept", F.col("__share") < F.col("__probability"))
        .select(*stay, *own)
    )
