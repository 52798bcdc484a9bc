"""From raw documents to shards: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language
from tidemark.llm.catalogue import KEEP, MARGINS, SHARDS, TOPICS
from tidemark.llm.common import ready, table
from tidemark.llm.decontamination import contaminated
from tidemark.llm.mixing import mixed
from tidemark.llm.ngram_join import Threshold, ngram_components
from tidemark.llm.sharding import shard_by_bytes
from tidemark.session import free, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# A text that takes more bits than it has is in no language that was learned.
MOST_BITS_PER_BYTE = 8.0


def _ready(spark: SparkSession, sf_dir: str) -> None:
    ready(spark, f"{sf_dir}/documents.parquet")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, which replaces ``lang``. Rejected: texts that are null,
    have no letter, or cost more than `MOST_BITS_PER_BYTE` in every language."""
    _ready(spark, sf_dir)
    docs = docs.select(*COLUMNS)
    model = language.fit(docs)
    told = language.identify(docs, model)
    fits = (F.col("lang_pred") != language.UNKNOWN) & (F.col("bits_per_byte") <= MOST_BITS_PER_BYTE)
    return told.filter(fits).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group that links of 0.8 or more on runs of
    five words tie together. Rows with a null id stay; rows of one id stay or go together."""
    _ready(spark, sf_dir)
    found = ngram_components(docs, Threshold(4, 5), size=5, rows=4)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(staged(gone, "pipeline-copies"), "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget."""
    _ready(spark, sf_dir)
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    gone = staged(found.select("doc_id").distinct(), "pipeline-leaks")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that their words meet the source, language and topic targets."""
    _ready(spark, sf_dir)
    return mixed(docs, MARGINS, KEEP, TOPICS).filter("__kept").select(*COLUMNS)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    _ready(spark, sf_dir)
    return shard_by_bytes(docs, SHARDS)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# Learned models, links and a hashed sample: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        free(before)
    return STAGES[-1][1](spark, docs, sf_dir)
