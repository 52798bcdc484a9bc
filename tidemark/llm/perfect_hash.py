"""A minimal perfect hash over byte strings, looked up for many strings at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from tidemark.llm.text import mix, span_hashes

# Keys per bucket on average, and displacements tried at once.
LOAD = 3
TRIES = 256
# Displacements tried per bucket before all starts again with another seed.
MOST_TRIES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def joined(keys: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All keys as one byte array, and where each starts (one more: the end)."""
    offsets = np.zeros(len(keys) + 1, dtype=np.int64)
    np.cumsum([len(k) for k in keys], out=offsets[1:])
    return np.frombuffer(b"".join(keys), np.uint8), offsets


def _hashes(keys: Sequence[bytes], seed: int) -> np.ndarray:
    data, at = joined(keys)
    lengths = np.diff(at).astype(np.uint64)
    return mix(span_hashes(data, at[:-1], at[1:]) + lengths + np.uint64(seed) * _STEP)


@dataclass(frozen=True)
class PerfectHash:
    """n different keys to the numbers 0 to n - 1, each once (hash, displace, compress).

    A key hashes to a bucket, and the bucket's displacement leads its keys to slots of their
    own; a bucket of one key names its slot. Strings that are no key get some slot too, so a
    caller compares the key of the slot.
    """

    displacement: np.ndarray
    size: int
    seed: int

    @classmethod
    def build(cls, keys: Sequence[bytes]) -> PerfectHash:
        if len(set(keys)) != len(keys):
            raise ValueError("the keys are not all different")
        seed = 0
        while True:
            displacement = _displacements(_hashes(keys, seed)) if keys else np.zeros(1, np.int64)
            if displacement is not None:
                return cls(displacement, len(keys), seed)
            seed += 1

    def slots(self, keys: Sequence[bytes]) -> np.ndarray:
        if not self.size or not keys:
            return np.zeros(len(keys), dtype=np.int64)
        found = _hashes(keys, self.seed)
        moved = self.displacement[_bucket(found, len(self.displacement))]
        spread = _slot(found, np.maximum(moved, 0), self.size)
        return np.where(moved < 0, -moved - 1, spread)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _slot(hashes: np.ndarray, moved: np.ndarray, size: int) -> np.ndarray:
    return (mix(hashes + (moved.astype(np.uint64) + np.uint64(1)) * _STEP) % np.uint64(size)).astype(np.int64)


def _displacements(hashes: np.ndarray) -> np.ndarray | None:
    """A displacement per bucket, or none if two keys share a hash or a bucket finds no place."""
    n = len(hashes)
    if len(np.unique(hashes)) != n:
        return None
    buckets = -(-n // LOAD)
    bucket = _bucket(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    sizes = np.diff(starts)
    displacement = np.zeros(buckets, dtype=np.int64)
    free = np.ones(n, dtype=bool)
    for b in np.argsort(-sizes, kind="stable").tolist():
        if sizes[b] < 2:
            break
        own = hashes[order[starts[b] : starts[b + 1]]]
        for first in range(0, MOST_TRIES, TRIES):
            tried = np.arange(first, first + TRIES)
            slots = np.sort(_slot(own[None, :], tried[:, None], n), axis=1)
            fits = free[slots].all(axis=1) & (slots[:, 1:] != slots[:, :-1]).all(axis=1)
            if fits.any():
                k = int(fits.argmax())
                displacement[b] = tried[k]
                free[slots[k]] = False
                break
        else:
            return None
    single = np.flatnonzero(sizes == 1)
    displacement[single] = -np.flatnonzero(free)[: len(single)] - 1
    return displacement
