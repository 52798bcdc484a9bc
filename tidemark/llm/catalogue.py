"""The queries of this subpackage: each runs one operator over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, html_text, language, token_counts, toxicity
from tidemark.llm.common import fold, ready, table
from tidemark.llm.decontamination import contaminated
from tidemark.llm.hard_negatives import hard_negatives
from tidemark.llm.line_dedup import without_common_lines
from tidemark.llm.mixing import mixed
from tidemark.llm.ngram_join import Threshold, ngram_components
from tidemark.llm.periodic_runs import periodic_runs, planted_repeats
from tidemark.llm.sharding import shard_by_bytes
from tidemark.llm.vector_dedup import vector_links
from tidemark.session import scratch_path, staged

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 16

# The mixture: sources evened out, languages and topics as named, half of all tokens.
MARGINS = {
    "source": 0.7,
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
    "topic": {"licence": 0.02, "contact": 0.025},
}
TOPICS = [("licence", r"[Ll]icense"), ("contact", r"[A-Za-z0-9._]@[A-Za-z0-9]")]
KEEP = 0.5

# Ranks of byte-level tokens, and how a text is split before they apply.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

# A word with an at sign in it.
ADDRESS = r"[^\x20\x09-\x0D@]*@[^\x20\x09-\x0D]*"

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(*tables: str) -> Callable[[Query], Query]:
    """Register a query, which runs with shuffle partitions for the tables it reads."""

    def register(run: Query) -> Query:
        @functools.wraps(run)
        def with_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(ready(spark, *[f"{sf_dir}/{t}.parquet" for t in tables]), sf_dir)

        _QUERIES[run.__name__] = with_settings
        return with_settings

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    return dict(_SQL)


@query("documents")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_common_lines(docs)


@query("documents", "labels")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = fold("doc_id", 3) == 1
    net = toxicity.fit(docs, labels.filter(~held_out))
    told = toxicity.score(docs, net)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return told.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"), "windows")


@query("pages")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


@query("documents")
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), Threshold(90, 100), size=3)


@query("documents")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals after five deliveries: two tokenizer versions of all documents, the
    deletion of copies, revised counts without words that hold an address, and batches 2
    and 4 once more, before and after the first two were compacted."""
    counters = {
        "classes-1": token_counts.classes,
        "words-1": token_counts.words,
        "masked": lambda text: token_counts.words(text) - F.regexp_count(text, F.lit(ADDRESS)),
    }
    docs = table(spark, sf_dir, "documents")
    rows = staged(
        token_counts.counted(
            docs.withColumn("print", F.xxhash64("text")), counters, keep=["doc_id", "print"]
        ),
        "token-rows",
    )
    first = staged(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "token-first")
    marked = rows.join(first, "print").withColumn("copy", F.col("doc_id") > F.col("first"))
    marked = staged(marked.select("source", "lang", "version", "tokens", "copy"), "token-marked")
    real = marked.filter("version <> 'masked'")
    words = marked.filter("version = 'words-1' AND NOT copy")
    masked = marked.filter("version = 'masked' AND NOT copy").withColumn("version", F.lit("words-1"))
    batches = {
        1: token_counts.inserts(real.filter("version = 'words-1'")),
        2: token_counts.inserts(real.filter("version = 'classes-1'")),
        3: token_counts.deletes(real.filter("copy")),
        4: token_counts.revisions(words, masked),
    }
    totals = token_counts.TokenTotals(spark, scratch_path(spark, "token-totals"))
    for batch in (1, 2, 2, 3, 4):
        totals.commit(batch, batches[batch])
    totals.compact(through=2)
    for batch in (2, 4):
        totals.commit(batch, batches[batch])
    return totals.totals()


_SQL["op5_token_counts"] = """
WITH firsts AS (
    SELECT source, lang, text FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
), counts AS (
    SELECT source, lang, 'classes-1' AS version, len(regexp_extract_all(text,
        '[A-Za-z]+|[0-9]+|[^\\x20\\x09-\\x0DA-Za-z0-9]')) AS tokens FROM firsts
    UNION ALL
    SELECT source, lang, 'words-1', len(list_filter(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'),
        lambda w: NOT contains(w, '@'))) FROM firsts
)
SELECT source, lang, version, count(*) AS docs, CAST(sum(coalesce(tokens, 0)) AS BIGINT) AS tokens
FROM counts GROUP BY ALL
"""


@query("embeddings")
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(table(spark, sf_dir, "embeddings"), cosine=0.95)


@query("documents")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = language.fit(docs.filter(~held_out))
    told = language.identify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query("documents")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)


@query("documents", "benchmark")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return contaminated(documents, benchmark)


@query("documents")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = mixed(docs, MARGINS, KEEP, TOPICS, keep_columns=["doc_id", "source", "lang"])
    return told.select(
        "doc_id",
        "source",
        "lang",
        F.col("__topic").alias("topic"),
        F.col("__tokens").alias("tokens"),
        F.col("__weight").alias("weight"),
        F.col("__probability").alias("probability"),
        F.col("__kept").alias("kept"),
    )


@query("documents")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary.load(RANKS, PATTERN)
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), vocabulary, keep=["doc_id"])
    told = byte_bpe.decode(encoded, vocabulary)
    return told.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("documents")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_repeats("doc_id", "text").alias("text"))
    told = periodic_runs(docs, keep=["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    told = told.withColumns({"best": longest, "lines": F.array_join(lines, "")})
    length, period = F.col("best.length"), -F.col("best.col3")
    return told.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("embeddings")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives(vectors, anchor=F.col("vec_id") % 50 == 0)


_SQL["op11_hard_negatives"] = """
WITH vectors AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same,
        CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors r ON a.id % 50 = 0 AND a.id <> r.id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, n.id AS negative_id,
    positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER best <= 3
"""
