"""Runs of repeated words in texts, found by a suffix automaton with link-cut access."""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sliced
from tidemark.llm.text import Words, mix, text_bytes, words

# Words of the shortest run. A run has its period at least twice.
LEAST_WORDS = 12

Run = tuple[int, int, int]

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Automaton:
    """The suffix automaton of a sequence of small numbers.

    A state's strings end at the same places. ``length`` is that of its longest string, ``link``
    leads to the state of the longest suffix that ends at more places, and ``prefix[i]``
    is the state of the first i + 1 numbers. Most states have one way on, which lies in two
    arrays; only those with more have a dictionary.
    """

    def __init__(self, numbers: Sequence[int]) -> None:
        self.length, self.link = array("i", [0]), array("i", [-1])
        self.symbol, self.to = array("i", [-1]), array("i", [-1])
        self.more: dict[int, dict[int, int]] = {}
        self.prefix = array("i")
        length, link, symbol, to, more = self.length, self.link, self.symbol, self.to, self.more
        last = 0
        for c in numbers:
            state = len(length)
            self._add(length[last] + 1, 0, -1, -1)
            p, q = last, -1
            while p >= 0:
                if symbol[p] == c:
                    q = to[p]
                    break
                if symbol[p] < 0:
                    symbol[p], to[p] = c, state
                else:
                    ways = more.get(p)
                    if ways is None:
                        more[p] = {c: state}
                    elif c in ways:
                        q = ways[c]
                        break
                    else:
                        ways[c] = state
                p = link[p]
            if q >= 0:
                if length[p] + 1 != length[q]:
                    q = self._split(p, c, q)
                link[state] = q
            self.prefix.append(state)
            last = state

    def _add(self, length: int, link: int, symbol: int, to: int) -> None:
        self.length.append(length)
        self.link.append(link)
        self.symbol.append(symbol)
        self.to.append(to)

    def _split(self, p: int, c: int, q: int) -> int:
        """A state of its own for the strings of ``q`` that come by ``c`` from ``p`` and its links."""
        symbol, to, more, link = self.symbol, self.to, self.more, self.link
        half = len(self.length)
        self._add(self.length[p] + 1, link[q], symbol[q], to[q])
        if q in more:
            more[half] = dict(more[q])
        while p >= 0:
            if symbol[p] == c:
                if to[p] != q:
                    break
                to[p] = half
            elif more.get(p, {}).get(c) == q:
                more[p][c] = half
            else:
                break
            p = link[p]
        link[q] = half
        return half


class LastEnds:
    """Where the strings of an automaton's states ended last, as paths of a link-cut tree.

    The states are a tree by their links. Those of one preferred path share their last end,
    which is kept at the root of the path's splay tree. ``access`` makes the way from the
    tree's root to a state one path with a new end, and tells the ends it had: a
    segment each, with the length of the longest string in it.
    """

    def __init__(self, link: Sequence[int]) -> None:
        n = len(link)
        self.up = array("i", link)
        self.left, self.right = array("i", [-1]) * n, array("i", [-1]) * n
        self.end = array("i", [0]) * n

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree, which takes the path's end along."""
        up, left, right = self.up, self.left, self.right
        top = x
        while True:
            y = up[x]
            if y < 0:
                break
            if left[y] == x:
                below = True
            elif right[y] == x:
                below = False
            else:
                break
            z = up[y]
            if z >= 0 and (left[z] == y or right[z] == y):
                top = z
                if (left[z] == y) == below:
                    self._rotate(y)
                else:
                    self._rotate(x)
            else:
                top = y
            self._rotate(x)
        if top != x:
            self.end[x] = self.end[top]

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = right[x]
            left[y] = inner
            right[x] = y
        else:
            inner = left[x]
            right[y] = inner
            left[x] = y
        if inner >= 0:
            up[inner] = y
        if z >= 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        up[x] = z
        up[y] = x

    def access(self, state: int, end: int, length: Sequence[int]) -> list[tuple[int, int]]:
        up, right, ends = self.up, self.right, self.end
        found, x, below = [], state, -1
        while x >= 0:
            self._splay(x)
            before = ends[x]
            if before:
                found.append((before, length[x]))
            cut = right[x]
            if cut >= 0:
                ends[cut] = before
            right[x] = below
            below, x = x, up[x]
        ends[below] = end
        return found


def runs_of(numbers: Sequence[int], least: int = LEAST_WORDS) -> list[Run]:
    """All runs (start, length, period) of ``least`` or more numbers, by start, then period.

    With each number appended, the last ends of all its suffixes are recoloured. A segment
    whose strings, up to a length, ended a distance ago no longer than that shows a square
    with the distance as its period, and that period is the smallest: nearer ends would
    have recoloured the segment. A square that is in no run yet is extended to both sides.
    Every run is found at the end of its first two periods, and n numbers take about n log n steps.
    """
    n = len(numbers)
    states = Automaton(numbers)
    ends = LastEnds(states.link)
    covered: dict[int, int] = {}
    found: list[Run] = []
    for end, state in enumerate(states.prefix, start=1):
        for before, length in ends.access(state, end, states.length):
            period = end - before
            if period > length or covered.get(period, 0) >= end:
                continue
            stop = end
            while stop < n and numbers[stop] == numbers[stop - period]:
                stop += 1
            start = end - 2 * period
            while start > 0 and numbers[start - 1] == numbers[start - 1 + period]:
                start -= 1
            covered[period] = stop
            if stop - start >= least:
                found.append((start, stop - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _stretches(found: Words, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words that can hold runs.

    With g = 1 + least // 3, every word of a run is in some g consecutive words of the run that
    come in it twice: where the period q has g words or more, those lie in one of the first two
    periods; else the run has least >= 2 q + g - 1 words, and any g of them come again q on or
    before. So words in no such repeated g end all runs, first in a text, then in what is
    left between them, until nothing more falls out.
    """
    size = 1 + least // 3
    n = len(found.hashes)
    starts, ends = found.first[:-1], found.first[1:]
    grams = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
    for k in range(size if len(grams) else 0):
        grams += found.hashes[k : k + len(grams)] * np.uint64(pow(int(_ODD), k + 1, 1 << 64))
    left = -1
    while True:
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        held = int((ends - starts).sum())
        if held == left or not held:
            return starts, ends
        left = held
        counts = ends - starts - size + 1
        part = np.repeat(np.arange(len(starts)), counts)
        at = np.arange(len(part)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[part]
        keys = mix(grams[at] + part.astype(np.uint64) * _ODD)
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(keys), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        change = np.zeros(n + 1, dtype=np.int64)
        np.add.at(change, at[again], 1)
        np.add.at(change, at[again] + size, -1)
        covered = np.cumsum(change)[:n] > 0
        # Stretches next to each other stay apart.
        border = np.zeros(n + 1, dtype=bool)
        border[starts] = True
        border[ends] = True
        first = np.flatnonzero(covered & (border[:-1] | ~np.append(False, covered[:-1])))
        last = np.flatnonzero(covered & (border[1:] | ~np.append(covered[1:], False)))
        starts, ends = first, last + 1


def found_runs(data: np.ndarray, offsets: np.ndarray, least: int = LEAST_WORDS) -> tuple[Words, list[list[Run]]]:
    """The words of some texts, and of each text its runs."""
    found = words(data, offsets, lower=False)
    runs: list[list[Run]] = [[] for _ in range(len(offsets) - 1)]
    starts, ends = _stretches(found, least)
    owner = np.searchsorted(found.first, starts, side="right") - 1
    for text, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist(), strict=True):
        numbers: dict[bytes, int] = {}
        spelled = [data[i:j].tobytes() for i, j in zip(found.starts[a:b].tolist(), found.ends[a:b].tolist(), strict=True)]
        own = [numbers.setdefault(w, len(numbers)) for w in spelled]
        first = a - int(found.first[text])
        runs[text] += [(first + s, length, period) for s, length, period in runs_of(own, least)]
    return found, runs


def collapsed(text: bytes, runs: Sequence[Run]) -> bytes:
    """The words joined by one space, of each run only the first period's."""
    kept = text.split()
    if runs:
        change = np.zeros(len(kept) + 1, dtype=np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        gone = np.cumsum(change)[:-1] > 0
        kept = [w for w, out in zip(kept, gone.tolist(), strict=True) if not out]
    return b" ".join(kept)


def periodic_runs(
    docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, least: int = LEAST_WORDS
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (none given: all) with ``n_words``, ``runs``, ``collapsed``.

    Words are runs of characters other than ASCII white space, numbered from 0. A run is a stretch
    of ``least`` words or more that has its smallest period twice at least and can be extended
    to no side; ``runs`` holds (start, length, period) by start, then period, and they may overlap.
    ``collapsed`` is the words joined by one space, without those that a run has behind
    its first period.

    Words are compared by their bytes. Only stretches in which runs of words repeat go to the
    automaton (see `_stretches`, which loses none). Null and empty texts have no words, no
    runs and an empty ``collapsed``. A text is handled whole by one task, with some hundred
    bytes of memory per word of its repetitive stretches. Repeated rows are rows of their own;
    an empty table gives no rows. Columns named as the three results are replaced.
    """
    own = ("n_words", "runs", "collapsed")
    held = [c for c in (docs.columns if keep is None else keep) if c not in own]
    source = docs.select(*[F.col(c) for c in held], F.col(text).alias("__text"))
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in held)
    schema += "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "__text"):
            data, offsets = text_bytes(batch.column("__text"))
            found, runs = found_runs(data, offsets, least)
            raw = data.tobytes()
            at = offsets.tolist()
            left = [collapsed(raw[a:b], r) for a, b, r in zip(at[:-1], at[1:], runs, strict=True)]
            rows = [[dict(zip(_RUN.names, r, strict=True)) for r in own] for own in runs]
            results = [
                pa.array(np.diff(found.first), pa.int64()),
                pa.array(rows, pa.list_(_RUN)),
                pa.array(left, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *results], names=[*held, *own])

    return source.mapInArrow(run, schema)


def planted_repeats(doc_id: str, text: str) -> Column:
    """The text, or where crc32 of the id is divisible by 10 its words with a repeated end.

    With h the crc32 and g = floor(h / 10), the words from number a = g % n on repeat the
    p = 1 + floor((n - a) / (3 + g % 8)) words there. Null ids leave their text as it is.
    """
    crc = f"crc32(cast({doc_id} AS string))"
    chosen = f"regexp_extract_all({text}, '([^\\\\x20\\\\x09-\\\\x0D]+)', 1)"
    told = f"named_struct('g', {crc} div 10, 'w', {chosen})"
    a = "cast(x.g % size(x.w) AS int)"
    p = f"cast(1 + (size(x.w) - {a}) div (3 + x.g % 8) AS int)"
    unit = f"slice(x.w, 1 + {a}, {p})"
    again = f"flatten(array_repeat({unit}, cast(1 + size(x.w) div {p} AS int)))"
    whole = f"array_join(slice(concat(slice(x.w, 1, {a}), {again}), 1, size(x.w)), ' ')"
    repeated = f"element_at(transform(array({told}), x -> if(size(x.w) > 0, {whole}, {text})), 1)"
    return F.expr(f"CASE WHEN {crc} % 10 = 0 AND {text} IS NOT NULL THEN {repeated} ELSE {text} END")
