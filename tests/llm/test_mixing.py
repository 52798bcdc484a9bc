import random

import pytest

from llm_fixtures import docs_of, llm  # noqa: F401

from tidemark.llm.mixing import mixed, rake


def brute(cells, goals, sweeps=200):
    """Weights of {(a, b): tokens} by plain proportional fitting."""
    weight = dict.fromkeys(cells, 1.0)
    total = sum(cells.values())
    for _ in range(sweeps):
        for k, goal in enumerate(goals):
            for value, share in goal.items():
                held = sum(weight[c] * cells[c] for c in cells if c[k] == value)
                for c in cells:
                    if c[k] == value and held:
                        weight[c] *= share * total / held
    return weight


def test_weights_equal_plain_fitting(llm):
    rng = random.Random(1)
    cells = {(a, b): rng.randint(50, 900) for a in "xyz" for b in "pq"}
    df = llm.createDataFrame([(*k, v) for k, v in cells.items()], "a string, b string, tokens long")
    goals = {"a": {"x": 0.2, "y": 0.3, "z": 0.5}, "b": {"p": 0.6, "q": 0.4}}
    expected = brute(cells, goals.values())
    for r in rake(df, goals).collect():
        assert r.weight == pytest.approx(expected[r.a, r.b], rel=2e-3)


def corpus():
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        source = rng.choices(["big", "mid", None], weights=[6, 3, 1])[0]
        lang = rng.choice(["en", "de"])
        text = " ".join(["w"] * rng.randint(1, 30)) + (" licence" if rng.random() < 0.1 else "")
        rows.append((i, text, lang, source))
    return rows


MARGINS = {"source": {"big": 0.5, "mid": 0.3, "∅": 0.2}, "lang": {"en": 0.6}, "topic": 1.0}


def test_kept_tokens_meet_the_marginals(docs_of):
    df = mixed(docs_of(corpus()), MARGINS, 0.4, [("law", "licence")])
    rows = df.collect()
    held = lambda f: sum(r["__tokens"] * r["__probability"] for r in rows if f(r))
    total = held(lambda r: True)
    assert total / sum(r["__tokens"] for r in rows) == pytest.approx(0.4, rel=0.01)
    assert held(lambda r: r.source is None) / total == pytest.approx(0.2, rel=0.01)
    assert held(lambda r: r.lang == "en") / total == pytest.approx(0.6, rel=0.01)
    kept = sum(r["__tokens"] for r in rows if r["__kept"])
    assert kept == pytest.approx(total, rel=0.1)


def test_a_cell_is_kept_whole_at_most(docs_of):
    df = mixed(docs_of(corpus()), {"topic": {"law": 0.9}}, 0.5, [("law", "licence")])
    assert all(r["__probability"] <= 1 for r in df.collect())
    assert df.filter("__topic = 'law'").selectExpr("bool_and(__kept)").first()[0]


def test_edge_cases(docs_of):
    rows = [(None, None, None, None), (1, "", "en", "a"), (2, "x y", "en", "a"), (2, "x y", "en", "a"), (3, "w " * 50_000, "de", "b")]
    df = docs_of(rows).selectExpr("*", "1 AS __tokens", "'t' AS topic", "5 AS weight", "6 AS goal", "7 AS tokens")
    out = mixed(df, {"source": 0.5, "lang": 0.5, "topic": 1.0}, 0.9)
    got = out.collect()
    assert sorted(r["__tokens"] for r in got) == [0, 0, 2, 2, 50_000] and all(r.weight == 5 for r in got)
    assert len({r["__kept"] for r in got if r.doc_id == 2}) == 1
    assert sorted(map(str, got)) == sorted(map(str, out.collect()))
    assert mixed(docs_of([]), {"source": 0.5}, 0.5).count() == 0
    assert mixed(docs_of([(1, None)]), {"source": 0.5}, 0.5).count() == 1
