"""Token totals by source, language and tokenizer version, kept up to date by deltas."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "version")

Counter = Callable[[Column], Column]


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def classes(text: Column) -> Column:
    """Runs of ASCII letters or digits, and every other character but white space on its own."""
    return F.regexp_count(text, F.lit(r"[A-Za-z]+|[0-9]+|[^\x20\x09-\x0DA-Za-z0-9]"))


def vocabulary(path: str) -> Counter:
    """Tokens by a tokenizer file (``tokenizers`` JSON) that every executor has at ``path``."""

    @F.pandas_udf("long")
    def count(text: pd.Series) -> pd.Series:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        found = [
            len(tokenizer.encode(t, add_special_tokens=False).ids) if t is not None else 0
            for t in text
        ]
        return pd.Series(found, dtype="int64")

    return count


def counted(
    docs: DataFrame,
    counters: Mapping[str, Counter],
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document and tokenizer version: source, lang, version, tokens.

    Columns named by ``keep`` come along.

    A null text has 0 tokens, a null source or language stays a null key, repeated rows
    are counted as often as they come, and other columns of the input are left behind.
    """
    each = [
        F.struct(F.lit(v).alias("version"), F.coalesce(c(F.col(text)), F.lit(0)).cast("long").alias("tokens"))
        for v, c in sorted(counters.items())
    ]
    rows = docs.select(
        *keep, F.col(source).alias("source"), F.col(lang).alias("lang"), F.inline(F.array(*each))
    )
    return rows


def inserts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sign", F.lit(1))


def deletes(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sign", F.lit(-1))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts of the same documents before and after: the old go, the new come."""
    return deletes(before).unionByName(inserts(after))


class TokenTotals:
    """Totals as a table of signed deltas, a folder per batch, in the folder ``path``.

    A batch is known by a number that grows. Committing it sums its changes per key and
    replaces the batch's own folder in one commit, so a batch that is delivered or run
    again leaves the totals as they are. `totals` adds all batches up; a key that comes
    to no documents and no tokens is left out. `compact` writes the sums up to a batch as
    a base, from which readers go on; a batch that the base holds is not taken again.

    Nulls in source, language or version are keys of their own. An empty batch is
    committed with no rows. Rows of 0 tokens count as documents. One writer at a time.
    """

    SCHEMA = "source string, lang string, version string, docs long, tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._base: int | None = None

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Take a batch in; False if the base already has it."""
        if self._base is None:
            self._base = self._bases()
        if batch <= self._base:
            return False
        signed = changes.groupBy(*KEYS).agg(
            F.sum("sign").cast("long").alias("docs"),
            F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"),
        )
        signed.write.mode("overwrite").parquet(f"{self.path}/kind=delta/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        base = self._bases()
        live = self._rows().filter(
            f"(kind = 'base' AND batch = {base}) OR (kind = 'delta' AND batch > {base})"
        )
        summed = live.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.filter("docs <> 0 OR tokens <> 0")

    def compact(self, through: int) -> None:
        base = self._bases()
        if through <= base:
            return
        live = self._rows().filter(
            f"(kind = 'base' AND batch = {base}) OR "
            f"(kind = 'delta' AND batch > {base} AND batch <= {through})"
        )
        summed = live.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        summed.write.mode("overwrite").parquet(f"{self.path}/kind=base/batch={through}")
        self._base = through

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(f"{self.SCHEMA}, kind string, batch long").parquet(self.path)

    def _bases(self) -> int:
        """The newest base, 0 if there is none. Batches count from 1."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/kind=base")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return 0
        found = [str(s.getPath().getName()) for s in fs.listStatus(folder)]
        done = [
            int(name.split("=")[1])
            for name in found
            if name.startswith("batch=")
            and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/_SUCCESS"))
        ]
        return max(done, default=0)
