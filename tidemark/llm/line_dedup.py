"""Line deduplication by patience diff between documents that share lines."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import blocks_of
from tidemark.session import staged

# Neighbouring lines of fewer words are no reason to compare documents, nor to be deleted.
LEAST_WORDS = 5

# Letters and signs of scripts without spaces (Thai to Myanmar, Khmer, Tai, Javanese to Cham,
# Chinese and Japanese with their punctuation); two of them count as a word.
_UNSPACED = (
    r"\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{1950}-\x{19FF}\x{1A20}-\x{1AAF}\x{1B00}-\x{1B7F}\x{2E80}-\x{312F}"
    r"\x{3190}-\x{9FFF}\x{A980}-\x{AADF}\x{F900}-\x{FAFF}\x{FF00}-\x{FFEF}\x{20000}-\x{323AF}"
)
_FIRST_UNSPACED = r"[\x{0E00}-\x{10FFFF}]"
_SPACE = "\x20\t\n\v\f\r"
_WORD = r"[^\x20\x09-\x0D]+"
_WORD_OR_TWO = rf"[{_UNSPACED}]{{1,2}}|[^\x20\x09-\x0D{_UNSPACED}]+"


def _word_count(line: Column) -> Column:
    spaced = (F.octet_length(line) == F.char_length(line)) | ~line.rlike(_FIRST_UNSPACED)
    return F.when(spaced, F.regexp_count(line, F.lit(_WORD))).otherwise(
        F.regexp_count(line, F.lit(_WORD_OR_TWO))
    )


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of ``pairs``, sorted by the first number, that rises in the second."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        if p == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[p] = j
            at[p] = k
        before.append(at[p - 1] if p else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _in_turn(a: list[int], i: int, m: int, b: list[int], j: int, n: int) -> list[tuple[int, int]]:
    """Positions of equal lines in two ranges, paired in the order they come in."""
    places: dict[int, list[int]] = {}
    for q in range(n - 1, j - 1, -1):
        places.setdefault(b[q], []).append(q)
    return [(p, places[a[p]].pop()) for p in range(i, m) if places.get(a[p])]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of equal lines, rising in both: common heads and tails, then lines
    that are unique on both sides, and the same again between those. Where none is unique,
    the first of a line on one side meets the first on the other, the second the second."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            found.append((m, n))
        if i == m or j == n:
            continue
        ours, theirs = Counter(a[i:m]), Counter(b[j:n])
        place = {line: q for q, line in enumerate(b[j:n], j) if theirs[line] == 1}
        unique = [(p, place[x]) for p, x in enumerate(a[i:m], i) if ours[x] == 1 and x in place]
        anchors = _rising(unique or _in_turn(a, i, m, b, j, n))
        if not anchors:
            continue
        found.extend(anchors)
        for p, q in [*anchors, (m, n)]:
            todo.append((i, p, j, q))
            i, j = p + 1, q + 1
    return sorted(found)


def common_lines(
    a: list[int], weights: list[int], b: list[int], least: int = 1, b_weights: list[int] | None = None
) -> list[int]:
    """Positions in ``a`` of the blocks of ``least`` weight that ``b`` has too. Without
    ``b_weights``, lines that ``a`` does not have end every common block.

    First the blocks that patience aligns. An alignment rises on both sides and takes a line
    of ``b`` once, so what comes in another order or more often is sought after that, by
    `blocks_of`, without regard to where it stands in ``b``. Lines of weight 0 go along in
    aligned blocks and inside of others.
    """
    out: set[int] = set()
    block: list[tuple[int, int]] = []
    for pair in [*patience(a, b), (-9, -9)]:
        if block and pair != (block[-1][0] + 1, block[-1][1] + 1):
            if sum(weights[i] for i, _ in block) >= least:
                out.update(i for i, _ in block)
            block = []
        block.append(pair)
    if any(w and i not in out for i, w in enumerate(weights)):
        if b_weights is None:
            known = dict(zip(a, weights, strict=True))
            b_weights = [known.get(x, least) for x in b]
        theirs = blocks_of(np.array(b, np.int64), np.array(b_weights, np.int64), least)
        starts, ends, keys = blocks_of(np.array(a, np.int64), np.array(weights, np.int64), least)
        common = np.isin(keys, theirs[2])
        for i, m in zip(starts[common].tolist(), ends[common].tolist(), strict=True):
            out.update(range(i, m))
    return sorted(out)


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    flat = column.values.to_numpy(zero_copy_only=False)
    at = column.offsets.to_numpy()
    return (flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True))


def _blocks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The distinct blocks of each document."""
    for batch in batches:
        both = zip(_lists(batch.column("lines")), _lists(batch.column("counts")), strict=True)
        keys = [np.unique(blocks_of(lines, counts.astype(np.int64), least)[2]) for lines, counts in both]
        at = pa.array(np.cumsum([0, *map(len, keys)]).astype(np.int32))
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("print"), pa.ListArray.from_arrays(at, pa.array(flat.view(np.int64)))],
            names=["id", "print", "keys"],
        )


def _align(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, prints = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        sides = zip(*(_lists(batch.column(i)) for i in range(2, 6)), strict=True)
        # Two documents at a time: lists of all lines of a batch would fill the memory.
        rows = [common_lines(*(x.tolist() for x in (a, n, b)), least, m.tolist()) for a, n, b, m in sides]
        hit = [k for k, row in enumerate(rows) if row]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[k] for k in hit], pa.int64()),
                pa.array([prints[k] for k in hit], pa.int64()),
                pa.array([rows[k] for k in hit], pa.list_(pa.int32())),
            ],
            names=["id", "print", "at"],
        )


def without_common_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``docs`` with blocks of lines that an earlier document has deleted from ``text``.

    Adds ``n_lines`` and ``n_removed`` (columns of these names are replaced). Documents are
    ordered by id, versions of one id by a hash of their text. Lines are equal if they are
    without the white space at their ends (blanks, tabs, CR, form feeds). A block is a line
    of at least ``least_words`` words, or as few neighbouring lines as hold that many words together; two letters of a script without
    spaces count as a word. A block that several documents have leads each of them to one
    other, the earliest that has it: so the comparisons are as many as the shared blocks,
    however many documents share one, and every block is compared with its first place. The
    two documents are aligned by patience diff, where lines that are unique on both sides
    (the rare ones) are the anchors, and each aligned run of lines with ``least_words`` words
    goes from the later document. Blocks that are not aligned, as they come in another order or
    more often, go too: none is left that an earlier document has. Lines without words count for
    nothing: those between the lines of a block go with it.

    A null id or text keeps its row as it is, with 0 removed; a null text has no lines and
    an empty one has one. Repeated rows are one document and lose the same lines. A
    document that is a copy is left with the empty text, not dropped. An empty
    table gives no rows.
    """
    kept = docs.drop("n_lines", "n_removed")
    body = F.col(text)
    raw = F.split(body, "\n")
    sigs = staged(
        docs.filter(F.col(doc_id).isNotNull() & body.isNotNull())
        .select(
            F.col(doc_id).cast("long").alias("id"),
            F.xxhash64(body).alias("print"),
            F.transform(raw, lambda x: F.xxhash64(F.btrim(x, F.lit(_SPACE)))).alias("lines"),
            F.transform(raw, _word_count).alias("counts"),
        ),
        "line-hashes",
    )
    documents = sigs.dropDuplicates(["id", "print"])
    own = sigs.mapInArrow(partial(_blocks, least=least_words), "id long, print long, keys array<long>")
    places = own.select(F.struct("id", "print").alias("doc"), F.explode("keys").alias("line"))
    first = places.groupBy("line").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last")
    )
    first = staged(
        first.filter("first <> last").select(F.col("line").alias("shared"), "first"), "line-owners"
    )
    pairs = places.join(first, F.col("line") == F.col("shared")).filter("doc <> first")
    pairs = staged(
        pairs.select(
            F.col("doc.id").alias("id"),
            F.col("doc.print").alias("print"),
            F.col("first.id").alias("first_id"),
            F.col("first.print").alias("first_print"),
        ).distinct(),
        "line-pairs",
    )
    later = staged(pairs.join(documents, ["id", "print"]), "line-later")
    earlier = staged(
        documents.join(
            pairs.select(F.col("first_id").alias("id"), F.col("first_print").alias("print")).distinct(),
            ["id", "print"],
            "left_semi",
        ).select(F.col("id").alias("i"), F.col("print").alias("p"), F.col("lines").alias("others"), F.col("counts").alias("theirs")),
        "line-earlier",
    )
    met = later.join(earlier, (F.col("first_id") == F.col("i")) & (F.col("first_print") == F.col("p")))
    aligned = met.select("id", "print", "lines", "counts", "others", "theirs").mapInArrow(
        partial(_align, least=least_words), "id long, print long, at array<int>"
    )
    gone = (
        aligned.select("id", "print", F.explode("at").alias("at"))
        .groupBy("id", "print")
        .agg(F.sort_array(F.collect_set("at")).alias("__gone"))
        .select(F.col("id").alias("__id"), F.col("print").alias("__print"), "__gone")
    )
    left = kept.join(
        gone,
        (F.col(doc_id).cast("long") == F.col("__id")) & (F.xxhash64(body) == F.col("__print")),
        "left",
    )
    # What stays is the stretches between the lines that go, each copied once.
    borders = F.concat(F.array(F.lit(-1)), F.col("__gone"), F.array(F.size("__lines")))
    cut = left.withColumn("__lines", raw).withColumn("__borders", F.when(F.col("__gone").isNotNull(), borders))
    stretches = F.transform(
        F.sequence(F.lit(1), F.size("__borders") - 1),
        lambda k: F.slice("__lines", F.get("__borders", k - 1) + 2, F.get("__borders", k) - F.get("__borders", k - 1) - 1),
    )
    rest = F.array_join(F.flatten(stretches), "\n")
    return cut.withColumns(
        {
            "n_lines": F.when(body.isNull(), 0).otherwise(F.size("__lines")),
            "n_removed": F.coalesce(F.size("__gone"), F.lit(0)),
            text: F.when(F.col("__gone").isNull(), body).otherwise(rest),
        }
    ).drop("__id", "__print", "__gone", "__lines", "__borders")
