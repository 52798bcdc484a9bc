"""Benchmark items in documents: exact pieces by the pigeonhole rule, then Myers' distance."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Edits allowed per item: this share of its characters, rounded down.
EDIT_SHARE = 0.06
# Items of fewer characters are searched exactly only.
LEAST_EDITED = 40
# Characters of items handled in one pass over the documents. A larger benchmark takes
# several passes, each over all documents, so what is sent to the tasks stays bounded.
PASS_CHARS = 2 << 20

SCHEMA = "doc_id long, item_id long, edits int, start long, end long"


class Items(NamedTuple):
    texts: list[tuple[int, str, int]]  # item id, normalised text, edits allowed
    pieces: dict[str, list[tuple[int, int]]]  # piece -> (index in texts, offset in the text)


def normal(text: str | None) -> str:
    """Lower case, white space runs as one space, trimmed; null as the empty text."""
    return " ".join(text.lower().split()) if text else ""


def budget(length: int) -> int:
    return int(length * EDIT_SHARE) if length >= LEAST_EDITED else 0


def split_items(rows: list[tuple[int, str]]) -> Items:
    """Every item cut into one piece more than it may have edits: one must stay whole."""
    texts, pieces = [], {}
    for item, text in rows:
        text = normal(text)
        if not text:
            continue
        edits = budget(len(text))
        index, parts = len(texts), edits + 1
        texts.append((item, text, edits))
        for p in range(parts):
            a, b = p * len(text) // parts, (p + 1) * len(text) // parts
            pieces.setdefault(text[a:b], []).append((index, a))
    return Items(texts, pieces)


def peq_of(pattern: str) -> dict[str, int]:
    bits: dict[str, int] = {}
    for i, c in enumerate(pattern):
        bits[c] = bits.get(c, 0) | 1 << i
    return bits


def best_end(bits: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edits between a pattern of ``m`` characters and any part of ``text``, and the
    first end of such a part. Myers (1999), with one long integer for the column."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    least, end = m, 0
    for j, c in enumerate(text, 1):
        eq = bits.get(c, 0)
        either = eq | down
        row = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(row | up))
        minus = up & row
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1, minus << 1
        up = (minus | ~(either | plus)) & full
        down = plus & either
        if score < least:
            least, end = score, j
    return least, end


def finder(items: Items):
    """A function text -> [(index of item, edits, start, end)], one per item found."""
    automaton = ahocorasick.Automaton()
    for piece, at in items.pieces.items():
        automaton.add_word(piece, (len(piece), at))
    automaton.make_automaton()
    forward = [peq_of(text) for _, text, _ in items.texts]
    backward = [peq_of(text[::-1]) for _, text, _ in items.texts]

    def find(text: str) -> list[tuple[int, int, int, int]]:
        hits: dict[int, set[int]] = {}
        for last, (size, at) in automaton.iter(text):
            for index, offset in at:
                hits.setdefault(index, set()).add(last + 1 - size - offset)
        found = []
        for index, begins in hits.items():
            _, pattern, edits = items.texts[index]
            m, best = len(pattern), None
            spans: list[list[int]] = []
            for begin in sorted(begins):
                a, b = max(0, begin - edits), min(len(text), begin + m + edits)
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
            for a, b in spans:
                if edits == 0:
                    at = text.find(pattern, a, b)
                    score, end = (0, at + m - a) if at >= 0 else (m, 0)
                else:
                    score, end = best_end(forward[index], m, text[a:b])
                if score <= edits and (best is None or score < best[0]):
                    back = text[max(a, a + end - m - edits) : a + end][::-1]
                    _, length = best_end(backward[index], m, back)
                    best = (score, a + end - length, a + end)
                    if not score:
                        break
            if best:
                found.append((index, *best))
        return found

    return find


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item that the document holds within the item's edit budget.

    Both texts are normalised (`normal`). An item of n >= `LEAST_EDITED` characters may
    differ from a part of the document by ``int(n * EDIT_SHARE)`` insertions, deletions and
    substitutions, a shorter one by none. Columns: doc_id, item_id, the least ``edits``,
    and where the first best part lies in the normalised document (``start``, ``end``; the
    shortest such part). Lossless: with one piece more than edits, one piece stays whole, and every exact hit
    of a piece is verified around its place; hits that overlap are verified together.

    Null and empty texts, on either side, and items of white space match nothing. Rows of
    documents are judged one by one, so repeated rows repeat their findings and a null id
    is kept; of items that are repeated each gives its own row, and an item with a null id
    is reported with a null. Very long texts are searched whole. Empty tables
    give no rows. Further columns are ignored.

    The benchmark is read to the driver in passes of at most `PASS_CHARS` characters, and
    each pass goes over all documents.
    """
    spark = docs.sparkSession
    wanted = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = benchmark.select(F.col(item_id).cast("long"), item_text).filter(
        F.length(F.trim(item_text)) > 0
    )
    found = None
    for part in _passes(rows):
        sent = spark.sparkContext.broadcast(split_items(part))
        one = wanted.mapInArrow(_searching(sent), SCHEMA)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else spark.createDataFrame([], SCHEMA)


def _passes(rows: DataFrame) -> Iterator[list[tuple[int, str]]]:
    part, size = [], 0
    for item, text in rows.toLocalIterator():
        if part and size + len(text) > PASS_CHARS:
            yield part
            part, size = [], 0
        part.append((item, text))
        size += len(text)
    if part:
        yield part


def _searching(sent):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        find = finder(items)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            ids = batch.column(0).to_pylist()
            for i, value in enumerate(batch.column(1)):
                for index, edits, start, end in find(normal(value.as_py())):
                    row = (ids[i], items.texts[index][0], edits, start, end)
                    for column, cell in zip(out, row, strict=True):
                        column.append(cell)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["doc_id", "item_id", "edits", "start", "end"],
            )

    return search
