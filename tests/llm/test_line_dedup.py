import random

from llm_fixtures import docs_of, llm  # noqa: F401

from tidemark.llm.line_dedup import common_lines, patience, without_common_lines

A = "this is a line of more than five words"
B = "another quite long line that documents have in common"
C = "a third line which is long enough to count"


def cleaned(df):
    return {(r.doc_id, r.n_removed): r.text for r in without_common_lines(df).collect()}


def test_alignment_is_a_common_subsequence_and_anchors_hold():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randint(0, 9) for _ in range(rng.randint(0, 14))]
        b = [rng.randint(0, 9) for _ in range(rng.randint(0, 14))]
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert patience(a, a) == [(i, i) for i in range(len(a))]
    assert patience([1, 2, 3, 4], [9, 2, 3, 8, 4]) == [(1, 1), (2, 2), (3, 4)]


def test_blocks_without_a_telling_line_stay():
    assert common_lines([1, 2, 3], [False] * 3, [1, 2, 3]) == []
    assert common_lines([7, 1, 2, 3, 8], [False, False, True, False, False], [1, 2, 3]) == [1, 2, 3]


def test_moved_and_repeated_lines_go():
    telling = [True] * 3
    assert patience([1, 2, 1, 2], [3, 1, 2, 1, 4, 2]) == [(0, 1), (1, 2), (2, 3), (3, 5)]
    assert common_lines([1, 2, 3], telling, [3, 2, 1]) == [0, 1, 2]
    assert common_lines([8, 1, 9, 1, 7, 1], [False, True, False, True, False, True], [5, 1, 6]) == [1, 3, 5]
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, 7) for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = common_lines(a, [x > 2 for x in a], b)
        assert {i for i, x in enumerate(a) if x > 2 and x in b} == {i for i in got if a[i] > 2}


def test_no_telling_line_of_an_earlier_document_is_left(docs_of):
    docs = [(1, f"{A}\n{B}\nhere\n{C}"), (2, f"{C}\nx\n{B}\ny\n{A}\nz\n{B}\nmy own words"), (3, f"{A}\nu\n{A}\nv")]
    assert {i: t for (i, _), t in cleaned(docs_of(docs)).items()} == {1: docs[0][1], 2: "x\ny\nz\nmy own words", 3: "u\nv"}


def test_white_space_at_line_ends_does_not_matter(docs_of):
    docs = [(1, f"{A}\n{B}\n{C}"), (2, f"{A}\r\n{B}\r\nown\r\n{C}\r\n"), (3, f"\t{A}\t\n \t{B} \f\v\n{C}\t \r\nx")]
    assert cleaned(docs_of(docs)) == {(1, 0): docs[0][1], (2, 3): "own\r\n", (3, 3): "x"}


def test_blocks_are_all_lines_of_common_runs():
    rng = random.Random(3)
    weight = [0, 1, 1, 2, 3, 4, 5, 6]
    for _ in range(300):
        a, b = ([rng.randint(0, 7) for _ in range(rng.randint(0, 12))] for _ in range(2))
        words = [weight[x] for x in a]
        full = [[x for x in side if weight[x]] for side in (a, b)]
        at = [i for i, x in enumerate(a) if weight[x]]
        runs = {tuple(full[1][i:j]) for j in range(len(b) + 1) for i in range(j)}
        want = set()
        for j in range(len(at) + 1):
            for i in range(j):
                run = full[0][i:j]
                if tuple(run) in runs and sum(weight[x] for x in run) >= 5:
                    want.update(at[i:j])
        assert {i for i in common_lines(a, words, b, 5, [weight[x] for x in b]) if words[i]} == want


def test_short_lines_count_together(docs_of):
    verse = "tiger tiger\nburning bright\n\nin the forests\nof\nthe night"
    words = "\n".join(f"word{i}" for i in range(60))
    chinese = "我们每天早上都去公园里散步"
    thai = "ฉันไปโรงเรียนทุกวันในตอนเช้า"
    docs = [(1, verse), (2, f"{A}\n{verse}"), (3, f"of\nthe night\n{B}\nof"), (4, words), (5, words), (6, chinese),
            (7, f"你好\n{chinese}"), (8, f"{thai}\nx"), (9, thai), (10, f"y\n你好"), (11, "我们每天\n早上都去\n公园里"),
            (12, "z\n我们每天\n早上都去\n公园里"), (13, "in the forests\nof\nits own")]
    left = {i: t for (i, _), t in cleaned(docs_of(docs)).items()}
    kept = (1, 3, 4, 6, 8, 10, 11, 13)
    assert left == {**{i: t for i, t in docs if i in kept}, 2: A, 5: "", 7: "你好", 9: "", 12: "z"}


def test_common_blocks_go_from_the_later_document(docs_of):
    docs = [
        (5, f"own words of five\n{A}\nshort\n{B}\nthe end"),
        (2, f"first text\n{A}\nshort\n{B}"),
        (9, f"{C}\nmiddle\n{A}\n"),
        (7, f"{C} \nno copy of the line"),
        (8, "short\nfirst text"),
    ]
    got = cleaned(docs_of(docs))
    assert got == {
        (2, 0): docs[1][1],
        (5, 3): "own words of five\nthe end",
        (7, 0): docs[3][1],
        (9, 2): "middle\n",
        (8, 0): "short\nfirst text",
    }


def test_a_line_of_all_documents_stays_in_the_first(docs_of):
    docs = [(i, f"text number {i} is here today\n{A}") for i in range(300)] + [(400 + i, f"{B}\n{C}") for i in range(100)]
    got = without_common_lines(docs_of(docs)).collect()
    assert sum(A in r.text for r in got) == 1 and next(r for r in got if A in r.text).doc_id == 0
    assert sorted(r.doc_id for r in got if r.doc_id >= 400 and r.text) == [400]


def test_edge_cases(docs_of):
    long = "\n".join(f"line {i} of a very long text" for i in range(20_000))
    docs = [(None, A), (1, A), (2, None), (3, ""), (4, A), (4, A), (4, f"{A}\nmore"), (5, long), (6, long)]
    df = docs_of(docs).selectExpr("*", "1 AS n_lines", "2 AS id", "3 AS print", "4 AS line", "5 AS lines")
    rows = without_common_lines(df).collect()
    assert sorted((str(r.doc_id), str(r.text)[:9], r.n_lines, r.n_removed) for r in rows) == sorted(
        [("None", A[:9], 1, 0), ("1", A[:9], 1, 0), ("2", "None", 0, 0), ("3", "", 1, 0), ("4", "", 1, 1), ("4", "", 1, 1),
         ("4", "more", 2, 1), ("5", "line 0 of", 20_000, 0), ("6", "", 20_000, 20_000)])
    assert rows[0].id == 2
    assert without_common_lines(docs_of([])).count() == 0
