import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs_of, llm  # noqa: F401

from tidemark.llm import toxicity as tx


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in tx._start(rng, rng.normal(size=9), rng.normal(size=9)).items()}
    x = rng.normal(size=(tx.WINDOW, 4, 6 * tx.STATES))
    mask = np.arange(tx.WINDOW) < np.array([tx.WINDOW, 3, 10, 1])[:, None]
    y = np.array([1, 0, 1, 0.0])

    def loss(p, x):
        logit, _ = tx._forward(p, x, mask)
        return float((np.log1p(np.exp(logit)) - y * logit).sum())

    kept = []
    logit, _ = tx._forward(p, x, mask, kept)
    g, dx = tx._backward(p, x, mask, kept, 1 / (1 + np.exp(-logit)) - y)
    for name in ("Uf", "Ub", "A", "a", "v", "o", "q"):
        at = tuple(0 for _ in p[name].shape)
        up, down = ({**p, name: p[name].copy()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert (loss(up, x) - loss(down, x)) / 2e-2 == pytest.approx(g[name][at], abs=1e-4)
    for at in ((0, 0, 0), (5, 0, 35), (2, 1, 25)):
        up, down = x.copy(), x.copy()
        up[at] += 1e-2
        down[at] -= 1e-2
        assert (loss(p, up) - loss(p, down)) / 2e-2 == pytest.approx(dx[at], abs=1e-4)
    assert not dx[5, 1].any()  # behind the window's end


def test_windows_overlap_and_cover_every_word():
    counts = [0, 1, tx.WINDOW, tx.WINDOW + 1, 3 * tx.WINDOW + 7]
    first = np.cumsum([0, *counts])
    index = np.arange(first[-1]) + 1
    windows, size, text = tx.windows_of(first, index)
    for t, n in enumerate(counts):
        rows = [list(w[:s]) for w, s, o in zip(windows, size, text, strict=True) if o == t]
        assert {x for r in rows for x in r} == set(index[first[t] : first[t + 1]])
        for a, b in zip(rows, rows[1:], strict=False):
            assert a[tx.STEP :] == b[: tx.WINDOW - tx.STEP]
        assert len(rows) == (0 if not n else 1 + max(0, -(-(n - tx.WINDOW) // tx.STEP)))


def corpus(n, seed):
    """Clean prose, and prose with bad words of two kinds: whole words and word beginnings."""
    rng = random.Random(seed)
    part = ["ka", "lo", "mi", "stre", "ung", "te", "ra", "no", "si", "pe"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choices(part, k=rng.randint(1, 3))) for _ in range(rng.randint(20, 200))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(2, 5)):
                bad = rng.choice(["vilo", "Graxx"]) if rng.random() < 0.5 else "zuqo" + rng.choice(part)
                words.insert(rng.randrange(len(words)), bad)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def net():
    rows = corpus(700, 1)
    toxic = np.array([r[2] for r in rows])
    return tx.train([r[1] for r in rows], toxic, int(toxic.sum()), int((1 - toxic).sum()))


def test_held_out_accuracy(llm, net):
    df = llm.createDataFrame(corpus(300, 2), "doc_id long, text string, toxic int")
    rows = tx.score(df, net).collect()
    right = sum((r.score >= tx.THRESHOLD) == bool(r.toxic) for r in rows)
    assert right >= 0.93 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxic_words_anywhere_in_a_long_text(net):
    clean = " ".join(t for _, t, bad in corpus(400, 3) if not bad)
    texts = [clean, clean + " vilo zuqoka graxx vilo", "vilo zuqoka graxx " + clean]
    scores, windows = tx._score_texts(net, pa.array(texts))
    assert windows[0] > 300 and (scores[1:] >= tx.THRESHOLD).all()


def test_edge_cases(llm, docs_of, net):
    docs = [(None, None), (1, None), (2, ""), (3, "12 %"), (4, "vilo graxx zuqolo"), (4, "vilo graxx zuqolo"), (5, "ka " * 80_000)]
    df = docs_of(docs).selectExpr("*", "'x' AS score", "1 AS windows", "2 AS toxic")
    out = tx.score(df, net)
    rows = out.collect()
    assert len(rows) == len(docs) and out.columns[-2:] == ["score", "windows"] and "toxic" in out.columns
    assert {r.windows for r in rows if r.doc_id in (None, 1, 2, 3)} == {0}
    assert len({r.score for r in rows if r.doc_id == 4}) == 1
    assert tx.score(docs_of([]), net).count() == 0
    labels = "doc_id long, toxic int"
    nothing = tx.fit(df, llm.createDataFrame([], labels))
    assert all(r.score < 1e-5 for r in tx.score(df, nothing).collect())
    odd = llm.createDataFrame([(1, 1), (None, 1), (2, None), (3, 0), (4, 1), (77, 0), (5, 7)], labels)
    assert tx.score(df, tx.fit(df.drop("toxic"), odd)).agg(F.count("score")).first()[0] == len(docs)


def test_fit_on_tables(llm):
    rows = corpus(400, 5)
    docs = llm.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = llm.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    found = tx.score(docs.join(labels, "doc_id"), tx.fit(docs, labels)).collect()
    assert sum((r.score >= tx.THRESHOLD) == bool(r.toxic) for r in found) >= 0.9 * len(rows)
