"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import share
from tidemark.llm.text import text_bytes

# Longest context in bytes; the runs counted are one longer.
CONTEXT = 4
# Labelled texts the statistics are taken from, per language, in expectation. This is
# the bound of the fit; scoring covers every text.
FIT_TEXTS = 400
# Bytes that are told apart from their neighbours in a text of several languages.
PIECE = 64
# Bytes scored at once, so that the arrays of a batch with very long texts stay small.
CHUNK = 1 << 20

UNKNOWN = "und"


@dataclass(frozen=True)
class ByteModel:
    """Frozen statistics of all languages in one trie of byte runs.

    ``child[k][node * symbols + s]`` is the run of k + 1 bytes that continues ``node``
    by ``s`` (0: unseen); ``bits[k][node, lang]`` is the exact code length of a run's
    last byte after the bytes before it; ``escape[k][node, lang]`` is what a byte costs
    that was seen after the run in no language, before the shorter context is asked.
    """

    languages: list[str]
    symbol: np.ndarray
    symbols: int
    child: list[np.ndarray]
    bits: list[np.ndarray]
    escape: list[np.ndarray]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits that each byte of the texts takes under each language: (bytes, languages)."""
        n, langs = len(data), len(self.languages)
        if not n:
            return np.zeros((0, langs), dtype=np.float32)
        s = self.symbol[data]
        runs = [s + 1]
        for k in range(1, CONTEXT + 1):
            longer = np.zeros(n, dtype=np.int32)
            longer[k:] = self.child[k][runs[-1][k - 1 : -1] * self.symbols + s[k:]]
            for i in range(k):  # no run reaches over the start of a text
                at = offsets[:-1] + i
                longer[at[at < n]] = 0
            runs.append(longer)
        # Bytes told by their longest seen run; the escapes on the way are added.
        cost = np.empty((n, langs), dtype=np.float32)
        left = np.arange(n)
        extra = np.zeros((n, langs), dtype=np.float32)
        opening = np.zeros(n, dtype=bool)
        opening[offsets[:-1][offsets[:-1] < n]] = True
        for k in range(CONTEXT, -1, -1):
            run = runs[k][left]
            hit = run > 0
            at = left[hit]
            cost[at] = self.bits[k][run[hit]]
            if k < CONTEXT:
                cost[at] += extra[at]
            left = left[~hit]
            if not len(left) or not k:
                break
            context = np.where(opening[left], 0, runs[k - 1][left - 1])
            extra[left] += self.escape[k - 1][context]
        return cost


def _count_runs(languages: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {name: i for i, name in enumerate(languages)}
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            lang = np.array([names[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            per_byte = np.repeat(lang, np.diff(offsets))
            for k in range(CONTEXT + 1):
                n = len(data) - k
                if n <= 0:
                    continue
                run = np.zeros(n, dtype=np.int64)
                for i in range(k + 1):
                    run = run * 256 + data[i : i + n]
                inside = np.ones(n, dtype=bool)
                for i in range(1, k + 1):
                    at = offsets[1:-1] - i
                    inside[at[(at >= 0) & (at < n)]] = False
                keys = (run * len(languages) + per_byte[:n])[inside]
                seen, times = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(seen), k, dtype=np.int32)),
                        pa.array(seen // len(languages)),
                        pa.array((seen % len(languages)).astype(np.int32)),
                        pa.array(times),
                    ],
                    names=["k", "run", "lang", "n"],
                )

    return count


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> ByteModel:
    """Statistics from a bounded sample of the labelled texts: all languages get about
    `FIT_TEXTS` whole texts each (all they have, if fewer), drawn by a hash of the text.

    Rows without a text or a language are passed over. Runs of bytes are counted in
    the tasks and summed by Spark; the driver gets one row per distinct run of the sample.
    Escapes are method C: a context that was followed n times by d distinct bytes keeps
    d / (n + d) for the others, and hands them to the context one byte shorter.
    """
    known = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.filter("text IS NOT NULL AND text <> '' AND lang IS NOT NULL")
    sizes = dict(known.groupBy("lang").count().collect())
    languages = sorted(sizes)
    if not languages:
        return _model([], [])
    rates = F.create_map(*[F.lit(x) for name in languages for x in (name, FIT_TEXTS / sizes[name])])
    drawn = known.filter(share("text", seed=8) < rates[F.col("lang")])
    runs = drawn.mapInArrow(_count_runs(languages), "k int, run long, lang int, n long")
    counts = runs.groupBy("k", "run", "lang").agg(F.sum("n").alias("n"))
    # Runs seen once in the sample say little and are most of it: long ones are left out
    # of the frozen statistics, so their context escapes instead.
    counts = counts.filter("k < 3 OR n > 1")
    got = counts.toPandas()
    return _model(languages, [got[got.k == k] for k in range(CONTEXT + 1)])


def _model(languages: list[str], counts: list) -> ByteModel:
    langs = len(languages)
    if not langs:
        none = np.zeros((257, 0), dtype=np.float32)
        zero = np.zeros(256 * 257, dtype=np.int32)
        return ByteModel(
            [], np.arange(256, dtype=np.int32), 256, [zero] * (CONTEXT + 1),
            [none] * (CONTEXT + 1), [none] * (CONTEXT + 1),
        )
    used = np.unique(counts[0].run.to_numpy(dtype=np.int64))
    symbols = len(used) + 1  # the last one stands for every byte that was not seen
    symbol = np.full(256, symbols - 1, dtype=np.int32)
    symbol[used] = np.arange(len(used))

    # Order 0: every symbol is a node, so each byte has a cost in every language.
    child: list[np.ndarray] = [np.zeros(0, dtype=np.int32)]
    n = np.zeros((symbols + 1, langs))
    np.add.at(n, (symbol[counts[0].run] + 1, counts[0].lang), counts[0].n)
    total, distinct = n.sum(axis=0), (n > 0).sum(axis=0)
    esc = (distinct + 1) / (total + distinct + 1)
    p = n / (total + distinct + 1) + esc / 256
    bits, escape, levels = [(-np.log2(p)).astype(np.float32)], [], [p]
    for k in range(1, CONTEXT + 1):
        run, lang, times = (counts[k][c].to_numpy(dtype=np.int64) for c in ("run", "lang", "n"))
        seen, node = np.unique(run, return_inverse=True)
        # A run is as frequent as its parts at least, so those are in the trie too.
        parents = _walk(child, symbol, symbols, seen >> 8, k)
        shorter = _walk(child, symbol, symbols, seen & ((1 << (8 * k)) - 1), k)
        size = len(levels[-1])
        step = np.zeros(size * symbols, dtype=np.int32)
        step[parents * symbols + symbol[seen & 255]] = np.arange(1, len(seen) + 1)
        n = np.zeros((len(seen) + 1, langs))
        np.add.at(n, (node + 1, lang), times)
        total, distinct = np.zeros((size, langs)), np.zeros((size, langs))
        np.add.at(total, parents, n[1:])
        np.add.at(distinct, parents, (n[1:] > 0).astype(float))
        esc = np.where(total > 0, distinct / np.maximum(total + distinct, 1), 1.0)
        p = np.ones((len(seen) + 1, langs))
        kept = n[1:] / np.maximum(total + distinct, 1)[parents]
        p[1:] = kept + esc[parents] * levels[-1][shorter]
        bits.append((-np.log2(p)).astype(np.float32))
        escape.append((-np.log2(esc)).astype(np.float32))
        child.append(step)
        levels.append(p)
    return ByteModel(languages, symbol, symbols, child, bits, escape)


def _walk(child: list, symbol: np.ndarray, symbols: int, runs: np.ndarray, length: int) -> np.ndarray:
    """The nodes of runs of ``length`` bytes; 0 where one is not in the trie."""
    node = symbol[(runs >> (8 * (length - 1))) & 255].astype(np.int64) + 1
    for k in range(1, length):
        node = child[k][node * symbols + symbol[(runs >> (8 * (length - 1 - k))) & 255]].astype(np.int64)
    return node


def identify(
    docs: DataFrame,
    model: ByteModel,
    text: str = "text",
    predicted: str = "lang_pred",
    score: str = "score",
    bits: str = "bits_per_byte",
) -> DataFrame:
    """``docs`` with the predicted language of every whole text.

    Each language's code length of every `PIECE` bytes is exact under the frozen
    statistics, with the contexts running on from piece to piece. A piece's bytes are
    shared out by 2 ** -length, and the text goes to the language with most of its bytes
    (ties: the first name): so a quoted passage in another language does not outweigh a
    larger rest. The score is that language's part of the bytes, and ``bits`` its code length per byte. A text that is
    null or has no letter gets `UNKNOWN`, score 0 and null bits; so does every text if no
    language was learned. Columns of these three names in the input are replaced; all
    others are kept as they are, and so are repeated rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(predicted, score, bits)
    letter, raw = "__has_letter", "__identified_text"
    shown = kept.withColumns(
        {raw: F.col(text), letter: F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))}
    )

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in batches:
            data, offsets = text_bytes(batch.column(raw))
            lettered = batch.column(letter).to_numpy(zero_copy_only=False).astype(bool)
            best = np.full(len(offsets) - 1, len(m.languages))
            certain = np.zeros(len(best))
            per_byte = np.full(len(best), np.nan)
            if m.languages and len(best):
                shares, length = _told(m, data, offsets)
                first = shares.argmax(axis=1)
                best = np.where(lettered, first, best)
                certain = np.where(lettered, np.minimum(shares.max(axis=1), 1.0), 0.0)
                size = np.maximum(np.diff(offsets), 1)
                own = length[np.arange(len(first)), first]
                per_byte = np.where(lettered, own / size, np.nan)
            columns = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in (raw, letter)]
            fields = [f for f in batch.schema if f.name not in (raw, letter)]
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(names[best], pa.string()),
                    pa.array(certain, pa.float64()),
                    pa.array(per_byte, pa.float64(), from_pandas=True),
                ],
                schema=pa.schema(
                    [*fields, pa.field(predicted, pa.string()), pa.field(score, pa.float64()), pa.field(bits, pa.float64())]
                ),
            )

    schema = kept.schema.add(predicted, "string").add(score, "double").add(bits, "double")
    return shown.mapInArrow(score_batches, schema)


def _told(model: ByteModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the share of it that goes to each language, and its bits under each."""
    texts, langs = len(offsets) - 1, len(model.languages)
    shares, bits = np.zeros((texts, langs)), np.zeros((texts, langs))

    def add(a: int, cost: np.ndarray, own: np.ndarray) -> None:
        """Texts from ``a`` on, of sizes ``own``, with the costs of all their bytes."""
        starts = np.cumsum(own) - own
        within = np.arange(len(cost)) - np.repeat(starts, own)
        piece = np.flatnonzero(within % PIECE == 0)
        if not len(piece):
            return
        length = np.add.reduceat(cost, piece, axis=0, dtype=np.float64)
        text = a + np.searchsorted(starts, piece, side="right") - 1
        over = np.clip(length - length.min(axis=1, keepdims=True), 0, 1000)
        share = np.exp2(-over)
        share *= (np.diff(np.append(piece, len(cost))) / share.sum(axis=1))[:, None]
        np.add.at(shares, text, share)
        np.add.at(bits, text, length)

    first = 0
    while first < texts:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1)
        a, b = int(offsets[first]), int(offsets[last])
        if b - a <= CHUNK:
            own = offsets[first : last + 1] - a
            add(first, model.code_lengths(data[a:b], own), np.diff(own))
        else:  # one long text: parts that begin with the context of their first byte
            for at in range(a, b, CHUNK):
                lead, end = min(CONTEXT, at - a), min(at + CHUNK, b)
                whole = np.array([0, end - at + lead], dtype=np.int64)
                add(first, model.code_lengths(data[at - lead : end], whole)[lead:], np.array([end - at]))
        first = last
    return shares / np.maximum(np.diff(offsets), 1)[:, None], bits
