"""Byte-level BPE encoding by the ranks of a public vocabulary, and decoding."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sliced
from tidemark.llm.perfect_hash import PerfectHash, joined

# Pre-tokens whose ids a Python worker remembers (some 200 bytes each); after a slice that
# leaves more it forgets all of them.
REMEMBERED = 700_000
# Ids that are decoded at once.
CHUNK = 1 << 18
_POSITION = 40
_MASK = (1 << _POSITION) - 1


@dataclass(frozen=True)
class Vocabulary:
    """Tokens in the order of their ranks, which are their ids, and how texts are split."""

    name: str  # of what it holds
    tokens: tuple[bytes, ...]
    pattern: str
    whole: PerfectHash
    by_slot: np.ndarray  # the rank of the token in each slot of `whole`

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        """From a file of lines "base64 of the token, rank"; read by the driver, and sent
        with the tasks (about a megabyte for 50,000 tokens)."""
        lines = [line.split() for line in Path(path).read_bytes().splitlines() if line.strip()]
        ranks = {int(rank): base64.b64decode(token) for token, rank in lines}
        if sorted(ranks) != list(range(len(ranks))):
            raise ValueError("the ranks are not 0 to n - 1")
        tokens = tuple(ranks[k] for k in range(len(ranks)))
        if not {bytes([b]) for b in range(256)} <= set(tokens):
            raise ValueError("a byte is no token, so some texts have no encoding")
        whole = PerfectHash.build(tokens)
        name = hashlib.sha256(b"\n".join([pattern.encode(), *map(base64.b64encode, tokens)])).hexdigest()
        return cls(name, tokens, pattern, whole, np.argsort(whole.slots(tokens)).astype(np.int32))


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """The encoder of this process, which may run many tasks one after another."""
    if vocabulary.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary.name] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.name]


class Encoder:
    """What a Python worker needs to encode, made from the vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.split = regex.compile(vocabulary.pattern).findall
        self.ranks = {token: rank for rank, token in enumerate(vocabulary.tokens)}
        self.byte = [self.ranks[bytes([b])] for b in range(256)]
        # Ranks of pairs of bytes, at 256 times the first and the second; -1: no token.
        self.two = [-1] * (1 << 16)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.two[token[0] << 8 | token[1]] = rank
        # The ids of a pre-token, 32 bits each.
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and where each text's begin (one more: the end)."""
        pieces = [self.split(t) if t else [] for t in texts]
        self._learn(set(chain.from_iterable(pieces)))
        ids_of = self.known.__getitem__
        found = [b"".join(map(ids_of, own)) for own in pieces]
        if len(self.known) > REMEMBERED:
            self.known = {}
        at = np.zeros(len(found) + 1, dtype=np.int32)
        np.cumsum([len(f) // 4 for f in found], out=at[1:])
        return np.frombuffer(b"".join(found), np.int32), at

    def _learn(self, pieces: set[str]) -> None:
        """Ids of all pre-tokens not known yet: first those that are tokens as a whole."""
        new = list(pieces.difference(self.known))
        raw = [p.encode() for p in new]
        words = self.vocabulary
        ranks = words.by_slot[words.whole.slots(raw)].tolist()
        tokens, known, merged = words.tokens, self.known, self.merged
        for piece, data, rank in zip(new, raw, ranks, strict=True):
            ids = (rank,) if tokens[rank] == data else merged(data)
            known[piece] = array("i", ids).tobytes()

    def merged(self, data: bytes) -> list[int]:
        """Ids of one pre-token by merging, while there is one, the pair of neighbours of least
        rank, the leftmost of equal ones. Tokens are linked by where they start, and a heap
        holds the pairs that are tokens: n log n steps, however long the pre-token is."""
        n, two, rank_of = len(data), self.two, self.ranks.get
        ids = [*map(self.byte.__getitem__, data)]
        # Rank of the pair that starts at a place; -1: none.
        pair = [two[a << 8 | b] for a, b in zip(data, data[1:], strict=False)]
        pair.append(-1)
        heap = [rank << _POSITION | i for i, rank in enumerate(pair) if rank >= 0]
        if not heap:
            return ids
        heapify(heap)
        after = [*range(1, n + 2)]
        before = [*range(-1, n)]
        while heap:
            top = heappop(heap)
            i = top & _MASK
            rank = top >> _POSITION
            if pair[i] != rank:
                continue
            ids[i] = rank
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = -1
            if end < n:
                before[end] = i
                rank = pair[i] = rank_of(data[i : after[end]], -1)
                if rank >= 0:
                    heappush(heap, rank << _POSITION | i)
            else:
                pair[i] = -1
            left = before[i]
            if left >= 0:
                rank = pair[left] = rank_of(data[left:end], -1)
                if rank >= 0:
                    heappush(heap, rank << _POSITION | left)
        found, i = [], 0
        while i < n:
            found.append(ids[i])
            i = after[i]
        return found


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    ids: str = "ids",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (none given: all) and ``ids``, the text's token ids.

    The pattern splits a text, and each piece is encoded alone, without special tokens. In two
    tiers: a minimal perfect hash of the whole vocabulary tells at once which of the pieces that
    a batch brings are tokens; each other one is merged by a heap over its linked bytes.

    Null and empty texts have no ids (an empty array). Long texts and long pieces are encoded
    whole; a piece of n bytes takes n log n steps and some hundred bytes of memory a byte.
    Repeated rows stay rows of their own, equal texts get equal ids. An empty table gives no
    rows. A column that is named as ``ids`` is replaced.
    """
    held = [c for c in (docs.columns if keep is None else keep) if c != ids]
    source = docs.select(*[F.col(c) for c in held], F.col(text).alias("__text"))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in held)
    schema += f"{', ' if held else ''}`{ids}` array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch in sliced(batches, "__text"):
            flat, at = encoder.encode(batch.column("__text").to_pylist())
            column = pa.ListArray.from_arrays(pa.array(at), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*held, ids])

    return source.mapInArrow(run, schema)


def _chunks(*arrays: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    for k in range(0, len(arrays[0]), CHUNK):
        yield tuple(a[k : k + CHUNK] for a in arrays)


def _gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Stretches of bytes one after another."""
    ends = np.cumsum(lengths)
    moved = np.repeat(starts - (ends - lengths), lengths)
    return data[moved + np.arange(len(moved))]


def decode(
    docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``docs`` with ``decoded``, the bytes that the token ids stand for.

    Bytes, as ids need not end where a character does. No ids: no bytes; null for a null array
    and for one with a null or with an id that the vocabulary has not.
    """
    held = [c for c in docs.columns if c != decoded]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts = joined(vocabulary.tokens)
        for batch in batches:
            column = batch.column(ids)
            at = np.zeros(len(column) + 1, dtype=np.int64)
            np.cumsum(pc.list_value_length(column).fill_null(0).to_numpy(), out=at[1:])
            flat = column.flatten()
            numbers = flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            wrong = (numbers < 0) | (numbers >= len(starts) - 1)
            numbers[wrong] = 0
            lengths = (starts[1:] - starts[:-1])[numbers]
            upto = np.append(0, np.cumsum(lengths))[at]
            parts = [_gathered(data, starts[n], k) for n, k in _chunks(numbers, lengths)]
            raw = np.concatenate([data[:0], *parts])
            bad = np.add.reduceat(np.append(wrong, False), at[:-1]) > 0 if len(column) else wrong
            bad &= at[1:] > at[:-1]
            bad |= column.is_null().to_numpy(zero_copy_only=False)
            whole = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(column), [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(raw)]
            )
            out = pc.if_else(pa.array(~bad), whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in held], out], names=[*held, decoded])

    return docs.select(*held).mapInArrow(run, f"{schema}, `{decoded}` binary")
