"""Texts of an Arrow batch as one byte array, and its words as arrays of 64-bit hashes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# Polynomial hash over the ring of 64-bit numbers: random values for bytes, odd base.
_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C17
_INVERSE = pow(_BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, np.uint64(base % 2**64), dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _both_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _CACHE.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        _CACHE[0] = have = (_powers(_BASE, size), _powers(_INVERSE, size))
    return have[0][:n], have[1][:n]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of UTF-8 bytes, and where each starts (one more: the end).

    A null text is taken as the empty one.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = column.buffers()
    at = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes; equal stretches have equal ones."""
    n = len(data)
    power, inverse = _both_powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


class Words(NamedTuple):
    hashes: np.ndarray  # uint64, in text order
    starts: np.ndarray  # first byte
    ends: np.ndarray  # byte after the last
    first: np.ndarray  # per text, its first word; one more: the number of words


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """The words, runs of bytes other than ASCII white space, hashed with A-Z lowered."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    solid = ~_SPACE[data]
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | border[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | border[1:])) + 1
    power, inverse = _both_powers(n + 1)
    seen = _LOWER[data] if lower else data
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[seen] * power[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(found: Words, size: int) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its word runs of ``size``.

    A text of fewer words has its whole sequence as the only run, one without words none.
    """
    h = found.hashes
    if len(h) >= size:
        runs = np.zeros(len(h) - size + 1, dtype=np.uint64)
        for k in range(size):
            runs += h[k : k + len(runs)] * _PLACE[k]
        runs = mix(runs)
    sets = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= size:
            own = np.sort(runs[a : b - size + 1])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            sets.append(own[keep])
        elif b > a:
            value = (h[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix(value + _PLACE[32 + b - a]))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def blocks_of(
    lines: np.ndarray, weights: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the smallest blocks of lines that weigh ``least`` together.

    From each line that has a weight the block that starts with it and the one that ends with
    it, if there are such. So any longer run of that weight is made up of blocks: a line that
    is in neither block of its own is inside of the one from the run's first line. Lines of
    weight 0 are in no hash.
    """
    at = np.flatnonzero(weights)
    n = len(at)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    power, inverse = _both_powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(lines[at].view(np.uint64) * power[:n], out=sums[1:])
    upto = np.concatenate([[0], np.cumsum(weights[at])])
    forward = np.searchsorted(upto, upto[:-1] + least)  # one behind the block's last line
    backward = np.searchsorted(upto, upto[1:] - least, side="right") - 1
    i, j = np.flatnonzero(forward <= n), np.flatnonzero(backward >= 0)
    starts = np.concatenate([i, backward[j]])
    ends = np.concatenate([forward[i], j + 1])
    keys = mix((sums[ends] - sums[starts]) * inverse[starts])
    return at[starts], at[ends - 1] + 1, keys
