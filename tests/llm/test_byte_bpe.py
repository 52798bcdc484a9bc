import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import docs_of, llm  # noqa: F401

from tidemark.llm import byte_bpe, catalogue
from tidemark.llm.byte_bpe import Encoder, Vocabulary, decode, encode
from tidemark.llm.perfect_hash import PerfectHash

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = Vocabulary.load(PATH, public_tokenizers.PATTERN)
ENCODER = Encoder(VOCABULARY)
PUBLIC = tiktoken.Encoding(
    "public",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks={t: k for k, t in enumerate(VOCABULARY.tokens)},
    special_tokens={},
)


def expected(text):
    ids = PUBLIC.encode_ordinary(text or "")
    digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    return len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()


def test_perfect_hash_gives_every_key_a_slot_of_its_own():
    for n in (0, 1, 2, 7, 1000, 20_000):
        keys = [b"%d" % (k * k) for k in range(n)]
        found = PerfectHash.build(keys)
        assert sorted(found.slots(keys).tolist()) == list(range(n))
        other = found.slots([b"", b"none", b"x" * 1000])
        assert n == 0 or ((0 <= other) & (other < n)).all()
    with pytest.raises(ValueError, match="not all different"):
        PerfectHash.build([b"a", b"a"])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_public_library(text):
    ids, at = ENCODER.encode([text, None, text])
    own = PUBLIC.encode_ordinary(text)
    assert ids.tolist() == own * 2 and at.tolist() == [0, len(own), len(own), 2 * len(own)]


def test_every_character_splits_as_in_the_public_library():
    texts = [f"a{c}b 1{c}2 .{c} {c}" for c in map(chr, range(0x3400)) ]
    ids, at = ENCODER.encode(texts)
    assert [p.tolist() for p in np.split(ids, at[1:-1])] == [PUBLIC.encode_ordinary(t) for t in texts]


def test_long_pieces_and_ties():
    rng = random.Random(3)
    for text in ("a" * 50_000, "".join(rng.choices("ab", k=30_000)), " " * 999, "\n" * 77 + "x", "é" * 501):
        assert ENCODER.encode([text])[0].tolist() == PUBLIC.encode_ordinary(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 2)
    small = Encoder(VOCABULARY)
    for text in ("one two threeish", "two four fivesome", "one one threeish"):
        assert small.encode([text])[0].tolist() == PUBLIC.encode_ordinary(text)


def test_bytes_are_gathered_in_chunks(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 3)
    data = np.frombuffer(b"abcdefgh", np.uint8)
    starts, lengths = np.array([4, 0, 2, 7, 1, 1, 3]), np.array([3, 0, 2, 1, 0, 7, 1])
    parts = [byte_bpe._gathered(data, s, n) for s, n in byte_bpe._chunks(starts, lengths)]
    assert len(parts) == 3 and b"".join(p.tobytes() for p in parts) == b"efg" b"cd" b"h" b"bcdefgh" b"d"


def test_operator_edges(llm, docs_of):
    rows = [(1, "It's 10 o'clock,  ok?"), (1, "It's 10 o'clock,  ok?"), (2, None), (3, ""), (None, "<|endoftext|>\x00"),
            (4, "a b " * 100_000)]
    docs = docs_of(rows).selectExpr("*", "'x' AS ids", "1 AS decoded")
    got = decode(encode(docs, VOCABULARY), VOCABULARY).collect()
    assert sorted((r.doc_id or 0, r.text or "", r.source) for r in got) == sorted((i or 0, t or "", "a") for i, t in rows)
    for r in got:
        assert r.ids == PUBLIC.encode_ordinary(r.text or "") and r.decoded == (r.text or "").encode()
    assert encode(docs_of([]), VOCABULARY).count() == 0
    odd = llm.createDataFrame([(1, None), (2, [1, None]), (3, [50256]), (4, [-1]), (5, [])], "k int, ids array<int>")
    assert [tuple(r) for r in decode(odd, VOCABULARY).select("k", "decoded").collect()] == [
        (1, None), (2, None), (3, None), (4, None), (5, b""),
    ]


def test_vocabulary_files_are_checked(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(255)))
    with pytest.raises(ValueError, match="a byte is no token"):
        Vocabulary.load(str(path), ".")
    path.write_bytes(base64.b64encode(b"a") + b" 3")
    with pytest.raises(ValueError, match="not 0 to n"):
        Vocabulary.load(str(path), ".")


def test_query_equals_the_public_library(llm):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in llm.read.parquet(f"{folder}/documents.parquet").collect()}
    got = catalogue.op13_byte_bpe(llm, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(texts[r.doc_id])
