import math

import numpy as np
import pytest

from llm_fixtures import llm  # noqa: F401

from tidemark.llm import vector_dedup as vd
from tidemark.llm.vector_dedup import Hashing, vector_links

SCHEMA = "vec_id long, embedding array<float>, label int"


def clouds(seed, groups=30, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 12)):
            rows.append(centre + rng.standard_normal(dim) * rng.choice([0, 0.05, 0.15, 0.3]))
    rng.shuffle(rows)
    return [(i * 2, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(rows)]


def brute(rows, cosine):
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    label = np.arange(len(rows))
    for _ in rows:
        label = np.array([min(label[i], *label[near[i]], label[i]) if near[i].any() else label[i] for i in range(len(rows))])
    return {r[0]: (int(near[i].sum()), rows[label[i]][0]) for i, r in enumerate(rows)}


@pytest.mark.parametrize("tile", [2000, 4])
def test_links_equal_brute_force(llm, monkeypatch, tile):
    monkeypatch.setattr(vd, "TILE", tile)
    rows = clouds(tile)
    got = {r.vec_id: r for r in vector_links(llm.createDataFrame(rows, SCHEMA), 0.95).collect()}
    expected = brute(rows, 0.95)
    found = sum(r.n_links for r in got.values())
    assert found >= 0.99 * sum(n for n, _ in expected.values()) > 0
    assert all(got[i].n_links <= n for i, (n, _) in expected.items())
    wrong = [i for i, (_, c) in expected.items() if got[i].component_id != c]
    assert len(wrong) <= 0.01 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_chance_to_meet_is_as_computed():
    rng = np.random.default_rng(1)
    hashing = Hashing(1, 4000)
    a = rng.standard_normal(24)
    a /= np.linalg.norm(a)
    b = rng.standard_normal(24)
    b -= (a @ b) * a
    b /= np.linalg.norm(b)
    other = 0.95 * a + math.sqrt(1 - 0.95**2) * b
    buckets = hashing.buckets(np.stack([a, other]))
    assert (buckets[0] == buckets[1]).mean() == pytest.approx(vd._meet(math.sqrt(0.1)), abs=0.03)
    for rows in (100, 10**6, 10**10):
        h = Hashing.for_rows(rows, 0.95)
        assert 1 - (1 - vd._meet(math.sqrt(0.1)) ** h.projections) ** h.tables >= vd.RECALL


def test_edge_cases(llm):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0), (2, [2.0, 4.0, 6.0], 1), (3, v, None), (3, v, 0), (None, v, 0), (4, None, 0), (5, [], 0),
        (6, [0.0, 0.0, 0.0], 0), (7, [float("nan"), 1.0, 2.0], 0), (8, [float("inf"), 1.0, 2.0], 0),
        (9, [1.0, 2.0], 0), (10, [-1.0, -2.0, -3.0], 0), (11, [1e30, 2e30, 3e30], 0), (12, [None, 1.0, 2.0], 0),
    ]
    df = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS copies", "3 AS v", "4 AS n_links")
    got = [tuple(r) for r in vector_links(df, 0.95).collect()]
    linked = [(1, 5, 1, True), (2, 5, 1, False), (3, 5, 1, False), (3, 5, 1, False), (11, 5, 1, False)]
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 12)]
    assert sorted(r for r in got if r[0] is not None) == sorted(linked + alone)
    assert [r for r in got if r[0] is None] == [(None, 5, None, False)]
    assert vector_links(llm.createDataFrame([], SCHEMA), 0.95).count() == 0


def test_every_dimension_is_joined_within_itself(llm):
    wide, narrow = clouds(5, 20, 16), clouds(6, 6, 8)
    narrow = [(100_001 + 2 * k, v, label) for k, (_, v, label) in enumerate(narrow)]
    got = {r.vec_id: r for r in vector_links(llm.createDataFrame(wide + narrow, SCHEMA), 0.95).collect()}
    for rows in (wide, narrow):
        expected = brute(rows, 0.95)
        links = sum(n for n, _ in expected.values())
        assert links >= sum(got[i].n_links for i in expected) >= 0.97 * links > 0
        assert sum(got[i].component_id != c for i, (_, c) in expected.items()) <= 0.03 * len(rows)
