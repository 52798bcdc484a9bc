"""The stored latest version of every key, moved on by batches of changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import keep_one_by_key
from tidemark.session import remove, staging
from tidemark.sinks.manifest import DATA, Manifest, RunTable, commit, manifest_of
from tidemark.spec import TableSpec

SIGN = "sign"


@dataclass
class CurrentTable(RunTable):
    """Latest rows by key, as runs (see `RunTable`) whose newer rows hide older ones.

    Unless the table is said not to be ``followed``, each commit also leaves a log: the row it put
    in place of every changed key (``sign`` 1) and the one it replaced (-1). Totals that follow
    the table apply the log, signed, and need not read the table. A log that nothing follows
    would be kept for ever.
    """

    keys: Sequence[str] = ()
    schema: T.StructType = field(default_factory=T.StructType)
    spec: TableSpec | None = None
    followed: bool = True

    @classmethod
    def of(cls, spark: SparkSession, path: str, spec: TableSpec, followed: bool = True) -> CurrentTable:
        return cls(spark, path, spec.key, spec.schema, spec, followed)

    def merged(self, runs: Sequence[DataFrame], whole: bool) -> DataFrame:
        if len(runs) == 1:
            return runs[0]
        aged = [run.withColumn("_age", F.lit(k)) for k, run in enumerate(runs[1:])]
        newer = aged[0]
        for run in aged[1:]:
            newer = newer.unionByName(run)
        newest = keep_one_by_key(newer, self.keys, [F.desc("_age")]).drop("_age")
        # The oldest run, nearly all of the table, needs no window: its hidden rows are left out.
        untouched = runs[0].join(newer.select(*self.keys), list(self.keys), "left_anti")
        return untouched.select(self.schema.names).unionByName(newest.select(self.schema.names))

    def apply(self, changes: DataFrame) -> bool:
        """Put the changes in place that are newer than what is stored; tells if any were.

        Newer goes by the table's order; of rows that rank the same the stored one stays. Reads
        the keys and versions stored, and writes as much as changes. Again is as once.
        """
        before = manifest_of(self.spark, self.path)
        latest = keep_one_by_key(changes.select(self.schema.names), self.keys, self.spec.ordering())
        if not before.entries.get("runs"):
            # Nothing stored: every change wins.
            return self._put(before, latest.withColumn(SIGN, F.lit(1)))
        with staging(latest, "changes") as latest:
            return self._put(before, self._signed(latest))

    def _signed(self, latest: DataFrame) -> DataFrame:
        """What the changes put in place and what they replace, signed."""
        columns = self.schema.names
        touched = latest.select(*self.keys)
        stored = self.read().join(touched, list(self.keys), "left_semi").select(columns)
        both = latest.withColumn("_new", F.lit(True)).unionByName(stored.withColumn("_new", F.lit(False)))
        place = Window.partitionBy(*self.keys)
        first = place.orderBy(*self.spec.ordering(), "_new")
        return (
            both.withColumn("_nth", F.row_number().over(first))
            .withColumn("_won", F.max(F.when(F.col("_nth") == 1, F.col("_new"))).over(place))
            .filter("_won")
            .select(*columns, F.when(F.col("_new"), 1).otherwise(-1).alias(SIGN))
        )

    def _put(self, before: Manifest, signed: DataFrame) -> bool:
        """Commit signed rows, with a log if the table is followed; tells if there were any."""
        version = before.version + 1
        if not self.followed:
            folder = self._next_run(before)
            rows = self._write(signed.filter(F.col(SIGN) == 1), folder)
            if rows:
                self._commit_run(before, folder, rows, version)
            else:
                remove(self.spark, f"{self.path}/{DATA}/{folder}")
            return bool(rows)
        seen = Observation()
        folder = f"{self.path}/{DATA}/log/v={version}"
        signed.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(folder)
        if not seen.get["rows"]:
            remove(self.spark, folder)
            return False
        put = self._logged([version]).filter(F.col(SIGN) == 1)
        self.add(put, version, log=[*before.entries.get("log", []), version])
        return True

    def _logged(self, versions: Sequence[int]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(SIGN, T.IntegerType())])
        folders = [f"{self.path}/{DATA}/log/v={v}" for v in versions]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    @property
    def version(self) -> int:
        """Of the last commit that changed rows."""
        return self.position

    def log(self, after: int = 0) -> DataFrame:
        """Signed rows of all commits after a position."""
        held = manifest_of(self.spark, self.path).entries.get("log", [])
        return self._logged([v for v in held if v > after])

    def forget(self, upto: int) -> None:
        """Drop the log up to a position, once everything that follows it has gone past."""
        now = manifest_of(self.spark, self.path)
        gone = [v for v in now.entries.get("log", []) if v <= upto]
        if gone:
            kept = [v for v in now.entries["log"] if v > upto]
            commit(self.spark, self.path, now, {**now.entries, "log": kept}, [f"log/v={v}" for v in gone])
