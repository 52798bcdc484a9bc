"""Toxic documents: a bidirectional gated recurrent network with attention pooling."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import share
from tidemark.llm.text import Words, mix, text_bytes, words

# Labelled texts of each class the network is fitted on, in expectation: the bound of the fit.
FIT_TOXIC, FIT_CLEAN = 800, 1600
# Words per window, and words from one window's start to the next one's: every stretch of half
# a window lies in some window whole.
WINDOW, STEP = 40, 20
# Sizes: word and character vectors, states per direction, attention.
WORD_DIM, CHAR_DIM, STATES, ATTENTION = 8, 8, 10, 8
# Beginnings and ends of a word, in bytes, that stand for its characters.
HEADS, TAILS = (3, 4, 5, 6, 7), (3, 4, 5)
# Texts of the fit that a word or a word part must be in to have a vector, and most vectors.
LEAST_TEXTS, MOST_VECTORS = 4, 1 << 16
ROUNDS, BATCH, RATE = 4, 128, 0.01
THRESHOLD = 0.7
SEED = 2

# Letters (and all bytes of longer characters), digits and the signs that stand for letters in
# disguised words make words here.
_LETTERS = np.full(256, 0x20, dtype=np.uint8)
for _range in (range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1), range(ord("0"), ord("9") + 1), b"@$*", range(128, 256)):
    _LETTERS[list(_range)] = list(_range)

Params = dict[str, np.ndarray]


def _words_of(column: pa.Array) -> tuple[Words, np.ndarray]:
    """The words that have a letter."""
    raw, offsets = text_bytes(column)
    data = _LETTERS[raw]
    found = words(data, offsets)
    letters = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(data >= 65, out=letters[1:])
    spelled = letters[found.ends] > letters[found.starts]
    first = np.append(0, np.cumsum(spelled))[found.first]
    return Words(found.hashes[spelled], found.starts[spelled], found.ends[spelled], first), data


def _parts(found: Words, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the beginnings and ends of the words numbered ``at``; 0 where one is too short."""
    starts, ends = found.starts[at], found.ends[at]
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    out = np.zeros((len(at), len(HEADS) + len(TAILS)), dtype=np.uint64)
    for sizes, first in ((HEADS, 0), (TAILS, len(HEADS))):
        for k, size in enumerate(sizes, first):
            long = np.flatnonzero(ends - starts >= size)
            begin = starts[long] if not first else ends[long] - size
            h = np.full(len(long), 1 + k, dtype=np.uint64)
            for i in range(size):
                h = h * np.uint64(1099511628211) + lower[begin + i]
            out[long, k] = mix(h) | np.uint64(1)
    return out


def _known(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place in the sorted vocabulary plus 1, or 0."""
    if not len(vocabulary):
        return np.zeros(hashes.shape, dtype=np.int64)
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == hashes, at + 1, 0)


@dataclass
class Network:
    vocabulary: np.ndarray
    parts: np.ndarray
    p: Params
    slope: float = 1.0
    shift: float = 0.0
    empty: float = 0.0

    def project(self, word: np.ndarray, part: np.ndarray) -> np.ndarray:
        return self.inputs(word, part) @ self.p["W"] + self.p["b"]

    def inputs(self, word: np.ndarray, part: np.ndarray) -> np.ndarray:
        n = np.maximum((part > 0).sum(axis=1, keepdims=True), 1).astype(np.float32)
        return np.concatenate([self.p["E"][word], self.p["C"][part].sum(axis=1) / n], axis=1)

    def logits(self, projected: np.ndarray, windows: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.zeros(len(windows), dtype=np.float32)
        full = size == WINDOW
        for whole in (True, False):
            rows = np.flatnonzero(full == whole)
            for a in range(0, len(rows), 512):
                at = rows[a : a + 512]
                mask = None if whole else np.arange(WINDOW) < size[at, None]
                out[at] = _forward(self.p, projected[windows[at].T], mask)[0]
        return out

    def score(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit.astype(np.float64) + self.shift, -60, 60)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def _run(x: np.ndarray, u: np.ndarray, mask: np.ndarray | None, back: bool, keep: list | None) -> np.ndarray:
    """States of one direction, (time, windows, STATES)."""
    steps, n, h3 = x.shape
    size = h3 // 3
    h = np.zeros((n, size), dtype=np.float32)
    out = np.empty((steps, n, size), dtype=np.float32)
    for t in reversed(range(steps)) if back else range(steps):
        hu = h @ u
        gates = _sigmoid(x[t, :, : 2 * size] + hu[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        new = np.tanh(x[t, :, 2 * size :] + r * hu[:, 2 * size :])
        fresh = new + z * (h - new)
        if mask is not None:
            fresh = np.where(mask[:, t, None], fresh, h)
        if keep is not None:
            keep.append((t, h, z, r, new, hu[:, 2 * size :]))
        h = fresh
        out[t] = h
    return out


def _forward(p: Params, x: np.ndarray, mask: np.ndarray | None, keep: list | None = None):
    """Logits of windows, from projected words x (time, windows, 6 * STATES)."""
    half = 3 * STATES
    notes = ([], []) if keep is not None else (None, None)
    forth = _run(x[:, :, :half], p["Uf"], mask, False, notes[0])
    back = _run(x[:, :, half:], p["Ub"], mask, True, notes[1])
    h = np.concatenate([forth, back], axis=2)
    k = np.tanh(h @ p["A"] + p["a"])
    s = k @ p["v"]
    if mask is not None:
        s = np.where(mask.T, s, np.float32(-1e9))
    w = np.exp(s - s.max(axis=0))
    w /= w.sum(axis=0)
    c = np.einsum("tn,tnh->nh", w, h)
    logit = c @ p["o"] + p["q"][0]
    if keep is not None:
        keep.append((h, k, w, c, notes))
    return logit, x


def _backward(p: Params, x: np.ndarray, mask: np.ndarray, kept: list, dlogit: np.ndarray):
    """Gradients of the parameters above the inputs, and of x."""
    h, k, w, c, notes = kept[0]
    g = {"o": c.T @ dlogit, "q": np.array([dlogit.sum()], dtype=np.float32)}
    dc = dlogit[:, None] * p["o"]
    dw = np.einsum("nh,tnh->tn", dc, h)
    ds = w * (dw - (w * dw).sum(axis=0))
    dk = ds[:, :, None] * p["v"] * (1 - k * k)
    g["v"] = np.einsum("tn,tnk->k", ds, k)
    g["a"] = dk.sum(axis=(0, 1))
    g["A"] = h.reshape(-1, h.shape[2]).T @ dk.reshape(-1, dk.shape[2])
    dh = w[:, :, None] * dc + dk @ p["A"].T
    dx = np.zeros_like(x)
    for name, part, note, at in (
        ("Uf", dh[:, :, :STATES], notes[0], 0),
        ("Ub", dh[:, :, STATES:], notes[1], 3 * STATES),
    ):
        u, du = p[name], np.zeros_like(p[name])
        carry = np.zeros_like(part[0])
        for t, before, z, r, new, hn in reversed(note):
            d = part[t] + carry
            m = mask[:, t, None].astype(np.float32)
            dn = d * m
            dnew = dn * (1 - z) * (1 - new * new)
            dz = dn * (before - new) * z * (1 - z)
            dr = dnew * hn * r * (1 - r)
            dhu = np.concatenate([dz, dr, dnew * r], axis=1)
            du += before.T @ dhu
            carry = d * (1 - m) + dn * z + dhu @ u.T
            dx[t, :, at : at + 3 * STATES] = np.concatenate([dz, dr, dnew], axis=1)
        g[name] = du
    return g, dx


def windows_of(first: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping windows of all texts: words (windows, WINDOW), sizes, texts.

    Every word is in a window; each window but a text's first starts with the last
    ``WINDOW - STEP`` words of the one before. A text of no words has no window.
    """
    counts = np.diff(first)
    many = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STEP)) + 1, 0)
    text = np.repeat(np.arange(len(counts)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    start = first[:-1][text] + nth * STEP
    size = np.minimum(WINDOW, first[1:][text] - start)
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    found = np.where(inside, index[np.where(inside, at, 0)] if len(index) else 0, 0)
    return found, size, text


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> Network:
    """A network fitted on a bounded sample: about `FIT_TOXIC` toxic and `FIT_CLEAN` clean
    labels, drawn by a hash of the id, with their whole texts. The sample is drawn before it
    meets the texts, so those are not shuffled. Labels without an id or other than 0 and 1, and ids without
    a document, are passed over; a null text counts as the empty one.

    Word and part vectors start from their log-odds between the classes. As labels are of
    texts, each round takes the windows of toxic texts that score highest as toxic, and
    of clean texts those that score highest and one more. A fifth of the sample is held back to set how the
    highest window's score becomes the text's.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("toxic"))
    known = known.filter("toxic IN (0, 1) AND id IS NOT NULL")
    sizes = dict(known.groupBy("toxic").count().collect())
    rate = F.when(F.col("toxic") == 1, FIT_TOXIC / max(sizes.get(1, 0), 1)).otherwise(
        FIT_CLEAN / max(sizes.get(0, 0), 1)
    )
    drawn = known.filter(share("id", seed=2) < rate)
    own = docs.select(F.col(doc_id).alias("own"), F.coalesce(text, F.lit("")).alias("text"))
    met = own.join(F.broadcast(drawn), F.col("own") == F.col("id")).select("text", "toxic").toPandas()
    met = met.sort_values(["text", "toxic"], ignore_index=True)
    return train(met.text.tolist(), met.toxic.to_numpy(), sizes.get(1, 0), sizes.get(0, 0))


def train(texts: list[str], toxic: np.ndarray, n_toxic: int, n_clean: int) -> Network:
    rng = np.random.default_rng(SEED)
    found, data = _words_of(pa.array(texts, pa.string()))
    hashes, at, index = np.unique(found.hashes, return_index=True, return_inverse=True)
    own_parts = _parts(found, data, at)
    per_text = [np.unique(index[a:b]) for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    used = rng.random(len(texts)) < 0.8
    vocabulary, word_odds = _odds([hashes[u] for u in per_text], toxic, used)
    part_rows = [np.unique(own_parts[u]) for u in per_text]
    parts, part_odds = _odds([r[r > 0] for r in part_rows], toxic, used)
    p = _start(rng, word_odds, part_odds)
    net = Network(vocabulary, parts, p)
    word, part = _known(vocabulary, hashes), _known(parts, own_parts)
    windows, size, owner = windows_of(found.first, index)
    if not len(windows) or len(set(toxic[used].tolist())) < 2:
        rate = n_toxic / max(n_toxic + n_clean, 1)
        net.shift, net.slope, net.empty = float(np.log((rate + 1e-6) / (1 - rate + 1e-6))), 0.0, rate
        return net

    # Before anything is learned a window is as toxic as its most telling word.
    telling = np.maximum(
        np.append(0, word_odds)[word], np.where(part > 0, np.append(0, part_odds)[part], 0).max(axis=1, initial=0)
    )
    inside = np.arange(WINDOW) < size[:, None]
    top = np.sort(np.where(inside, telling[windows], 0), axis=1)[:, -3:]
    logit = top.sum(axis=1).astype(np.float32)
    moments: dict[str, list] = {}
    step = 0
    for _ in range(ROUNDS):
        chosen, labels = _choose(rng, logit, owner, toxic, used)
        order = rng.permutation(len(chosen))
        for a in range(0, len(order), BATCH):
            rows = chosen[order[a : a + BATCH]]
            step += 1
            _learn(net, word, part, windows[rows], size[rows], labels[order[a : a + BATCH]], moments, step)
        logit = net.logits(net.project(word, part), windows, size)
    _calibrate(net, logit, owner, toxic, ~used, n_toxic, n_clean)
    return net


def _odds(rows: list[np.ndarray], toxic: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that enough texts have, sorted, with the log-odds of being in a toxic one."""
    rows = [r for r, u in zip(rows, used, strict=True) if u]
    label = np.repeat(toxic[used], [len(r) for r in rows])
    seen, at = np.unique(np.concatenate(rows) if rows else np.zeros(0, np.uint64), return_inverse=True)
    bad = np.bincount(at, weights=label == 1, minlength=len(seen))
    good = np.bincount(at, weights=label == 0, minlength=len(seen))
    enough = np.flatnonzero(bad + good >= LEAST_TEXTS)
    if len(enough) > MOST_VECTORS:
        enough = np.sort(enough[np.argsort(-(bad + good)[enough], kind="stable")[:MOST_VECTORS]])
    seen, bad, good = seen[enough], bad[enough], good[enough]
    n_bad, n_good = max((toxic[used] == 1).sum(), 1), max((toxic[used] == 0).sum(), 1)
    odds = np.log((bad + 0.5) / n_bad) - np.log((good + 0.5) / n_good)
    return seen, np.clip(odds, -1, 5)


def _start(rng: np.random.Generator, word_odds: np.ndarray, part_odds: np.ndarray) -> Params:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    inputs = WORD_DIM + CHAR_DIM
    p = {
        "E": normal(len(word_odds) + 1, WORD_DIM, scale=0.05),
        "C": normal(len(part_odds) + 1, CHAR_DIM, scale=0.05),
        "W": normal(inputs, 6 * STATES, scale=0.3),
        "b": np.zeros(6 * STATES, dtype=np.float32),
        "Uf": normal(STATES, 3 * STATES, scale=0.3),
        "Ub": normal(STATES, 3 * STATES, scale=0.3),
        "A": normal(2 * STATES, ATTENTION, scale=0.4),
        "a": np.zeros(ATTENTION, dtype=np.float32),
        "v": normal(ATTENTION, scale=0.4),
        "o": normal(2 * STATES, scale=0.4),
        "q": np.zeros(1, dtype=np.float32),
    }
    p["E"][1:, 0], p["C"][1:, 0] = word_odds / 2, part_odds / 2
    p["E"][0], p["C"][0] = 0, 0
    return p


def _choose(rng, logit, owner, toxic, used) -> tuple[np.ndarray, np.ndarray]:
    """Windows to learn from: the top two of toxic texts, the top two and a random one of others."""
    order = np.lexsort((-logit, owner))
    first = np.searchsorted(owner[order], np.arange(len(toxic)))
    count = np.bincount(owner, minlength=len(toxic))
    rows = []
    for text in np.flatnonzero(used & (count > 0)):
        own = order[first[text] : first[text] + count[text]]
        if toxic[text]:
            rows.extend(own[:1])
            rows.extend(w for w in own[1:3] if logit[w] > 0.7 * logit[own[0]] and logit[w] > 0)
        else:
            rows.extend(own[:2])
            rows.append(own[rng.integers(len(own))])
    chosen = np.array(rows, dtype=np.int64)
    return chosen, toxic[owner[chosen]].astype(np.float32)


def _learn(net, word, part, windows, size, label, moments, step) -> None:
    p = net.p
    uniq, at = np.unique(windows, return_inverse=True)
    at = at.reshape(windows.shape)
    x_in = net.inputs(word[uniq], part[uniq])
    projected = x_in @ p["W"] + p["b"]
    mask = np.arange(WINDOW) < size[:, None]
    kept: list = []
    logit, x = _forward(p, projected[at.T], mask, kept)
    d = ((_sigmoid(logit) - label) / len(label)).astype(np.float32)
    g, dx = _backward(p, x, mask, kept, d)
    dprojected = np.zeros_like(projected)
    np.add.at(dprojected, at.T, dx)
    g["W"], g["b"] = x_in.T @ dprojected, dprojected.sum(axis=0)
    din = dprojected @ p["W"].T
    rows = {"E": (word[uniq], din[:, :WORD_DIM])}
    n = np.maximum((part[uniq] > 0).sum(axis=1, keepdims=True), 1).astype(np.float32)
    spread = np.repeat(din[:, None, WORD_DIM:] / n[:, None], part.shape[1], axis=1)
    rows["C"] = (part[uniq].ravel(), spread.reshape(-1, CHAR_DIM))
    for name, grad in g.items():
        m = moments.setdefault(name, [np.zeros_like(grad), np.zeros_like(grad)])
        m[0] += 0.1 * (grad - m[0])
        m[1] += 0.001 * (grad * grad - m[1])
        p[name] -= RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    for name, (ids, grad) in rows.items():  # vectors: a step scaled by the gradients so far
        touched, which = np.unique(ids, return_inverse=True)
        total = np.zeros((len(touched), grad.shape[1]), dtype=np.float32)
        np.add.at(total, which, grad)
        seen = moments.setdefault(name, [np.full(p[name].shape, 1e-4, dtype=np.float32)])[0]
        seen[touched] += total * total
        p[name][touched] -= 0.02 * total / np.sqrt(seen[touched])
        p[name][0] = 0


def _calibrate(net, logit, owner, toxic, held, n_toxic, n_clean) -> None:
    """Slope and shift from the highest window to the text's score, on texts held back, which
    are weighted as the classes are among all labelled ones."""
    top = np.full(len(toxic), -np.inf)
    np.maximum.at(top, owner, logit)
    rows = held & np.isfinite(top)
    net.empty = float(n_toxic / max(n_toxic + n_clean, 1))
    if len(set(toxic[rows].tolist())) < 2:
        return
    x, y = top[rows], toxic[rows].astype(float)
    total = max(n_toxic + n_clean, 1)
    weight = np.where(y == 1, n_toxic / total / max(y.sum(), 1), n_clean / total / max((1 - y).sum(), 1))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
        e, s = weight * (q - y), weight * q * (1 - q)
        grad = np.array([(e * x).sum() + 0.003 * (slope - 1), e.sum()])
        hess = np.array([[(s * x * x).sum() + 0.003, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-6]])
        change = np.clip(np.linalg.solve(hess, grad), -1, 1)
        slope, shift = slope - change[0], shift - change[1]
        if np.abs(change).max() < 1e-6:
            break
    if slope > 0:
        net.slope, net.shift = float(slope), float(shift)


def score(docs: DataFrame, net: Network, text: str = "text", out: str = "score", most: str = "windows") -> DataFrame:
    """``docs`` with a score from 0 to 1 per row, and its number of windows.

    All overlapping windows of the whole text are scored (`windows_of`); the text gets the score of the
    highest. A text that is null, empty or without letters has no window and gets the
    share of toxic ones among the labelled texts. Columns of the two names in the input
    are replaced, all others stay; repeated rows repeat their score, an empty table gives
    none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)
    kept = docs.drop(out, most)
    raw = "__scored_text"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            scores, counts = _score_texts(m, batch.column(raw))
            keep = [i for i, n in enumerate(batch.schema.names) if n != raw]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(scores, pa.float64()), pa.array(counts, pa.int32())],
                schema=pa.schema(
                    [*(batch.schema.field(i) for i in keep), pa.field(out, pa.float64()), pa.field(most, pa.int32())]
                ),
            )

    return kept.withColumn(raw, F.col(text)).mapInArrow(work, kept.schema.add(out, "double").add(most, "integer"))


# Words whose windows are held at once.
CHUNK = 200_000


def _score_texts(net: Network, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    found, data = _words_of(column)
    hashes, at, index = np.unique(found.hashes, return_index=True, return_inverse=True)
    projected = net.project(_known(net.vocabulary, hashes), _known(net.parts, _parts(found, data, at)))
    n = len(found.first) - 1
    top, counts, a = np.full(n, -np.inf), np.zeros(n, dtype=np.int32), 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(found.first, found.first[a] + CHUNK, side="right")) - 1)
        lo, hi = int(found.first[a]), int(found.first[b])
        windows, size, owner = windows_of(found.first[a : b + 1] - lo, index[lo:hi])
        if len(windows):
            np.maximum.at(top, owner + a, net.logits(projected, windows, size))
            np.add.at(counts, owner + a, 1)
        a = b
    filled = np.isfinite(top)
    scores = np.full(n, net.empty)
    scores[filled] = net.score(top[filled])
    return scores, counts
