import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import docs_of, llm  # noqa: F401

from tidemark.llm import catalogue
from tidemark.llm.periodic_runs import Automaton, LastEnds, collapsed, found_runs, periodic_runs, runs_of


def brute(words, least):
    """Every period's stretches of equal words that far apart, but those of smaller periods."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            inner = words[start : start + length]
            if length >= max(least, 2 * q) and not any(inner[r:] == inner[:-r] for r in range(1, q)):
                found.append((start, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts(rng):
    n, k = rng.randrange(90), rng.choice([1, 2, 3, 6, 40])
    words = [rng.randrange(k) for _ in range(n)]
    if n > 6 and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randrange(1, n)
        words = [words[i] if i < a else words[a + (i - a) % min(p, n - a)] for i in range(n)]
    return words


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(700):
        words = texts(rng)
        assert runs_of(words, least) == brute(words, least), words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_last_ends_equal_brute_force(numbers):
    """After each number, the segments tell for every suffix where it ended before."""
    states = Automaton(numbers)
    ends = LastEnds(states.link)
    for end, state in enumerate(states.prefix, start=1):
        told = [0] * end
        for before, length in sorted(ends.access(state, end, states.length), key=lambda s: -s[1]):
            told[:length] = [before] * length
        for k in range(1, end + 1):
            suffix = numbers[end - k : end]
            earlier = [j for j in range(k, end) if numbers[j - k : j] == suffix]
            assert told[k - 1] == max(earlier, default=0)


@pytest.mark.parametrize("least", [3, 5, 12])
def test_stretches_lose_no_run(least):
    rng = random.Random(least + 50)
    for _ in range(200):
        several = [texts(rng) for _ in range(4)]
        raw = [" ".join(f"w{w}" for w in ws).encode() for ws in several]
        offsets = np.cumsum([0, *map(len, raw)])
        _, runs = found_runs(np.frombuffer(b"".join(raw), np.uint8), offsets, least)
        assert runs == [brute(ws, least) for ws in several]


def test_a_long_text_in_n_log_n_steps():
    rng = random.Random(1)
    words = [rng.randrange(5000) for _ in range(9000)] * 4
    assert runs_of(words) == [(0, 36_000, 9000)]
    assert runs_of([7] * 50_000) == [(0, 50_000, 1)]


def test_collapsed_keeps_the_first_period():
    assert collapsed(b" a b\ta b a  c ", [(0, 5, 2)]) == b"a b c"
    assert collapsed(b"", []) == b""
    assert collapsed(b"x y", []) == b"x y"


def test_operator_edges(llm, docs_of):
    poem = "so it goes " * 6
    rows = [(1, poem), (1, poem), (2, None), (3, ""), (4, " \t\n"), (None, "one\x0btwo"), (5, "é" * 3 + " " + "la " * 12)]
    rows.append((6, "x y z " * 40_000))
    got = periodic_runs(docs_of(rows).selectExpr("*", "1 AS runs", "2 AS n_words")).collect()
    told = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.source) for r in got}
    assert len(got) == len(rows) and told == {
        1: (18, [(0, 18, 3)], "so it goes", "a"),
        2: (0, [], "", "a"),
        3: (0, [], "", "a"),
        4: (0, [], "", "a"),
        None: (2, [], "one two", "a"),
        5: (13, [(1, 12, 1)], "ééé la", "a"),
        6: (120_000, [(0, 120_000, 3)], "x y z", "a"),
    }
    assert periodic_runs(docs_of([])).count() == 0


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + math.floor((n - a) / (3 + g % 8))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words, 12)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(),
    )


def test_query_equals_brute_force(llm, tmp_path):
    """Whole texts of up to 400 words: brute force takes quadratic steps."""
    whole = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    short = whole.filter("size(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+')) <= 400")
    odd = llm.createDataFrame([(10**9 + k, t) for k, t in enumerate([None, "", " ", "a", "b c"] * 20)], "doc_id long, text string")
    short.unionByName(odd, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text for r in llm.read.parquet(f"{tmp_path}/documents.parquet").collect()}
    got = catalogue.op12_periodic_runs(llm, str(tmp_path)).collect()
    assert len(got) == len(texts) > 400 and sum(r.n_runs > 0 for r in got) > 20
    for r in got:
        own = (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
        assert own == expected(r.doc_id, texts[r.doc_id]), r.doc_id
