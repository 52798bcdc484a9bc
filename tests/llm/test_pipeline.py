import pytest
from compare import connect, differences

import corpus_pipeline as cp
from __spark_entry__ import oracle_sql, queries
from tidemark.llm import catalogue
from tidemark.llm.common import table
from tidemark.llm.decontamination import normal

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in catalogue.all_queries()) == list(range(1, 14))
    assert set(catalogue.all_queries()) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(catalogue.all_sql()))
def test_query_equals_sql(spark, name):
    assert differences(queries()[name](spark, SF), connect(SF), oracle_sql()[name]) == []


COLUMNS = {
    "op1_line_dedup": "doc_id text n_lines n_removed",
    "op2_toxicity": "doc_id held_out score predicted windows",
    "op3_html_extraction": "page_id url text n_chars",
    "op4_ngram_join": "doc_id n_shingles component_id",
    "op6_embedding_dedup": "vec_id n_links component_id kept",
    "op7_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op8_language_id": "doc_id held_out lang_pred score bits_per_byte",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_input_row(spark, name):
    out = queries()[name](spark, SF)
    source = {"op3": "pages", "op6": "embeddings"}.get(name[:3], "documents")
    assert out.columns == COLUMNS[name].split()
    assert out.count() == table(spark, SF, source).count()


def jaccard(a, b, size=5):
    sets = []
    for text in (a, b):
        w = text.lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        if name != "sharding":
            assert out.columns == list(cp.COLUMNS)
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        rows = {r.doc_id: r for r in docs.collect()}
        kept[name] = (before.collect(), rows)

    before, after = kept["language"]
    assert all(not any(c.isalpha() for c in r.text or "") for r in before if r.doc_id not in after)
    before, after = kept["near_duplicates"]
    texts = {r.doc_id: r.text for r in before}
    for gone in set(texts) - set(after):
        assert max(jaccard(texts[gone], t) for i, t in texts.items() if i != gone) >= 0.8
    left = list(after.values())
    assert not any(jaccard(a.text, b.text) >= 0.8 for i, a in enumerate(left) for b in left[:i])
    before, after = kept["decontamination"]
    items = [normal(r.text) for r in table(spark, SF, "benchmark").collect()]
    leaks = {r.doc_id for r in before if any(i and i in normal(r.text) for i in items)}
    assert leaks and not leaks & set(after) and len(before) - len(after) <= len(leaks) + 2
    before, after = kept["mixing"]
    assert 0.2 * len(before) < len(after) < 0.8 * len(before)
    before, after = kept["sharding"]
    assert set(after) == {r.doc_id for r in before}


def test_run_equals_its_stages(spark):
    first = sorted(map(str, cp.run(spark, SF).collect()))
    assert first == sorted(map(str, cp.run(spark, SF).collect())) and first
