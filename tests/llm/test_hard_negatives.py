import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import llm  # noqa: F401

from tidemark.llm import catalogue
from tidemark.llm import hard_negatives as hn
from tidemark.llm.hard_negatives import Best, Codes, Questions, hard_negatives, integer_scores, rotation

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    """Rows (id, vector, label) compared two by two, with Python's integers."""
    taken = [
        (i, [math.floor(x * scale) for x in v], label)
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for k, (a, v, label) in enumerate(taken):
        if a is None or not anchor(a):
            continue
        others = [
            (-sum(p * q for p, q in zip(v, w)), math.inf if i is None else i, j, i, own)
            for j, (i, w, own) in enumerate(taken)
            if j != k and len(w) == len(v)
        ]
        for s, _, _, p, _ in sorted(o for o in others if o[4] == label)[:positives]:
            fit = sorted(o for o in others if o[4] != label and -s * low <= -100 * o[0] <= -s * high)
            out += [(a, p, r, o[3], -s, -o[0]) for r, o in enumerate(fit[:negatives], start=1)]
    return out


def key(row):
    return tuple((v is None, v or 0) for v in row)


def check(llm, rows, **options):
    df = llm.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in hard_negatives(df, F.col("vec_id") % 5 == 0, **options).collect()]
    expected = brute(rows, lambda i: i % 5 == 0, options.get("positives", 5), options.get("negatives", 3))
    assert sorted(got, key=key) == sorted(expected, key=key)
    return got


def clouds(seed, n=400, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    v = centres[rng.integers(0, 12, n)] + rng.standard_normal((n, dim)) * rng.choice([0, 0.1, 0.8], n)[:, None]
    v = np.round(v, 2) if seed % 2 else v
    return [(int(i), [float(np.float32(x)) for x in w], int(k)) for i, w, k in zip(rng.permutation(n), v, rng.integers(0, 4, n))]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(llm, seed):
    assert len(check(llm, clouds(seed))) > 300


def test_small_passes_and_blocks_change_nothing(llm, monkeypatch):
    monkeypatch.setattr(hn, "PASS_BYTES", 24 * 8 * 20)
    monkeypatch.setattr(hn, "ROWS", 16)
    monkeypatch.setattr(hn, "ANCHORS", 7)
    check(llm, clouds(3, 200))
    check(llm, clouds(4, 150), positives=1, negatives=9)


def test_intervals_hold_every_score():
    rng = np.random.default_rng(0)
    for size in (1, 3, 64, 65, 200):
        x = rng.integers(-300, 300, (40, size))
        y = np.concatenate([rng.integers(-300, 300, (40, size)), x[:5], -x[:5], np.zeros((1, size), int)])
        turn = rotation(size)
        assert np.allclose(turn @ turn.T, np.eye(size))
        lower, upper = Questions.of(x, turn).bounds(Codes.of(y, turn))
        scores = x @ y.T
        assert (lower <= scores).all() and (scores <= upper).all()
        assert size < 64 or (upper - lower).mean() < 2 * (np.abs(scores).max() + scores.std() * 8)


def test_intervals_leave_out_what_is_far():
    """Vectors of a direction stand apart from others by their codes alone."""
    rng = np.random.default_rng(2)
    near = rng.standard_normal(256)
    x = np.floor(256 * (near + 0.05 * rng.standard_normal((5, 256)))).astype(np.int64)
    far = np.floor(256 * rng.standard_normal((500, 256))).astype(np.int64)
    turn = rotation(256)
    _, upper = Questions.of(x, turn).bounds(Codes.of(far, turn))
    assert (upper < (x @ x.T).min()).mean() > 0.95


def test_integer_scores_are_exact():
    rng = np.random.default_rng(1)
    for most in (2**10, 2**29):
        x, y = (rng.integers(-most, most, (30, 8)) for _ in range(2))
        exact = [[sum(int(p) * int(q) for p, q in zip(a, b)) for b in y] for a in x]
        for share in (0.001, 0.5, 1.0):
            wanted = rng.random((30, 30)) < share
            got = integer_scores(x, y, wanted)
            assert (got == np.where(wanted, exact, np.iinfo(np.int64).min)).all()


def test_best_keeps_ties_by_id():
    best = Best(2, 2)
    for ident in ([5, 3, 9], [4, 1, 0]):
        best.offer(np.array([0, 1]), np.array([[7, 7, 6], [1, 2, 3]]), np.array(ident), np.array(ident))
    assert list(zip(best.slot, best.score, best.ident)) == [(0, 7, 1), (0, 7, 3), (1, 3, 0), (1, 3, 9)]


def test_edge_cases(llm):
    a, b = [1.0, 0.5], [0.9, 0.0]
    rows = [
        (0, a, 1), (0, a, 1), (1, a, 1), (1, a, 1), (2, b, 2), (2, b, 2), (None, b, 2), (None, a, 1), (5, a, None),
        (10, None, 1), (15, [float("nan"), 1.0], 1), (20, [None, 1.0], 1), (25, [float("inf"), 1.0], 2),
        (30, [], 1), (31, [], 1), (32, [], 2), (35, [0.0, 0.0], 1), (36, [0.0, -0.0], 2), (40, [1.0], 1), (41, [0.7], 1),
        (42, [0.6], 3), (45, [-1.0, -0.5], 2), (50, [0.3, 0.3], 4),
    ]
    assert len(check(llm, rows)) > 20
    huge = [(100, [3e38, 1.0], 1), (101, [1e30, 1.0], 2)]
    df = llm.createDataFrame(rows + huge, SCHEMA).selectExpr("*", "1 AS row", "2 AS ident", "3 AS v", "4 AS asked")
    assert hard_negatives(df, F.col("vec_id") % 5 == 0).count() == len(brute(rows, lambda i: i % 5 == 0))
    assert hard_negatives(llm.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    assert hard_negatives(llm.createDataFrame(rows, SCHEMA), F.lit(False)).columns[0] == "anchor_id"


def test_query_equals_brute_force(llm):
    folder = "/root/testdata/sf0.001"
    raw = llm.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in raw]
    got = [tuple(r) for r in catalogue.op11_hard_negatives(llm, folder).collect()]
    assert sorted(got) == sorted(brute(rows, lambda i: i % 50 == 0)) and got
