from pathlib import Path

import pytest

from llm_fixtures import docs_of, llm  # noqa: F401

from tidemark.llm import token_counts as tc
from tidemark.session import scratch_path

COUNTERS = {"words-1": tc.words, "classes-1": tc.classes}


def totals(book):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in book.totals().collect()}


def test_counts(docs_of):
    df = docs_of([(1, "It's 12 o'clock.\n Yes"), (2, None), (3, ""), (4, "é\xa0b")])
    rows = tc.counted(df, COUNTERS, keep=["doc_id"]).collect()
    assert {(r.doc_id, r.version): r.tokens for r in rows} == {
        (1, "words-1"): 4, (1, "classes-1"): 9, (2, "words-1"): 0, (2, "classes-1"): 0,
        (3, "words-1"): 0, (3, "classes-1"): 0, (4, "words-1"): 1, (4, "classes-1"): 3,
    }


def test_batches_are_idempotent_and_deltas_add_up(llm, docs_of):
    book = tc.TokenTotals(llm, scratch_path(llm, "totals"))
    words = lambda rows: tc.counted(docs_of(rows), {"words-1": tc.words})
    first = words([(1, "a b c", "en", "x"), (2, "d", "en", "x"), (3, "e f", None, None), (3, "e f", None, None)])
    assert book.commit(1, tc.inserts(first))
    expected = {("x", "en", "words-1"): (2, 4), (None, None, "words-1"): (2, 4)}
    assert totals(book) == expected
    book.commit(1, tc.inserts(first))
    assert totals(book) == expected
    book.commit(2, tc.revisions(words([(2, "d", "en", "x")]), words([(2, "d e f", "de", "x")])))
    book.commit(3, tc.deletes(words([(3, "e f", None, None)] * 2)))
    book.commit(4, tc.inserts(words([])))
    expected = {("x", "en", "words-1"): (1, 3), ("x", "de", "words-1"): (1, 3)}
    assert totals(book) == expected
    book.compact(through=3)
    assert totals(book) == expected
    assert not book.commit(2, tc.inserts(first)) and totals(book) == expected
    again = tc.TokenTotals(llm, book.path)
    assert not again.commit(3, tc.inserts(first)) and totals(again) == expected
    again.commit(5, tc.inserts(words([(9, "z", "en", "x")])))
    again.compact(through=5)
    again.compact(through=4)
    assert totals(again)[("x", "en", "words-1")] == (2, 4)


def test_extra_columns_and_long_texts(docs_of):
    df = docs_of([(1, "w " * 100_000)]).selectExpr("*", "1 AS tokens", "2 AS version", "3 AS sign")
    (row,) = tc.counted(df, {"words-1": tc.words}).collect()
    assert (row.tokens, row.version) == (100_000, "words-1")
    assert tc.counted(docs_of([]), COUNTERS).count() == 0


def test_public_tokenizer(docs_of):
    tokenizers = pytest.importorskip("tokenizers")
    path = Path("/opt/tokenizers/byte_bpe_50k.json")
    if not path.exists():
        pytest.skip("no tokenizer files")
    texts = ["hello world", None, "", "ünïcode <|endoftext|>"]
    rows = tc.counted(docs_of(list(enumerate(texts))), {"bpe": tc.vocabulary(str(path))}, keep=["doc_id"]).collect()
    plain = tokenizers.Tokenizer.from_file(str(path))
    plain.encode_special_tokens = True
    assert {r.doc_id: r.tokens for r in rows} == {
        i: len(plain.encode(t, add_special_tokens=False).ids) if t else 0 for i, t in enumerate(texts)
    }
