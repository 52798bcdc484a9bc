import random

from llm_fixtures import docs_of, llm  # noqa: F401

from tidemark.llm import decontamination as d


def distance(pattern, text):
    """Sellers' table: least edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_bit_parallel_distance():
    rng = random.Random(2)
    for _ in range(300):
        p = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        assert d.best_end(d.peq_of(p), len(p), t)[0] == distance(p, t)


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at, how = rng.randrange(len(text)), rng.random()
        if how < 0.33:
            del text[at]
        elif how < 0.66:
            text.insert(at, rng.choice("xyz"))
        else:
            text[at] = rng.choice("xyz")
    return "".join(text)


def test_all_items_within_budget_are_found_and_no_others(llm, docs_of):
    rng = random.Random(3)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "sed", "do", "eiusmod", "tempor"]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    items = [(i, prose(rng.randint(4, 40))) for i in range(25)]
    docs = []
    for k in range(120):
        _, item = items[k % 25]
        put = edited(rng, item, rng.randint(0, 12)) if k % 3 else ""
        docs.append((k, f"{prose(30)} {put.upper() if k % 2 else put}\n {prose(20)}"))
    benchmark = llm.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in d.contaminated(docs_of(docs), benchmark).collect()}
    expected = {}
    for k, text in docs:
        for i, item in items:
            edits = distance(d.normal(item), d.normal(text))
            if edits <= d.budget(len(item)):
                expected[k, i] = edits
    assert {k: r.edits for k, r in got.items()} == expected and len(expected) > 30
    texts, named = dict(docs), dict(items)
    for (k, i), r in got.items():
        part = d.normal(texts[k])[r.start : r.end]
        pattern = d.normal(named[i])
        assert distance(pattern, part) == r.edits and abs(len(part) - len(pattern)) <= r.edits


def test_edge_cases(llm, docs_of, monkeypatch):
    item = "a passage of the benchmark that is long enough to be searched with edits"
    schema = "item_id long, text string, doc_id long"
    benchmark = llm.createDataFrame([(1, item, 9), (1, item, 9), (None, item, 9), (2, None, 9), (3, "  ", 9), (4, "", 9)], schema)
    docs = [(None, item), (1, None), (2, ""), (3, item), (3, item), (4, "x " * 100_000 + item), (5, "clean")]
    df = docs_of(docs).selectExpr("*", "1 AS item_id", "2 AS edits")
    got = d.contaminated(df, benchmark).collect()
    assert sorted((str(r.doc_id), str(r.item_id)) for r in got) == sorted(
        (i, j) for i in ("None", "3", "3", "4") for j in ("1", "1", "None")
    )
    monkeypatch.setattr(d, "PASS_CHARS", 80)
    assert sorted(map(str, d.contaminated(df, benchmark).collect())) == sorted(map(str, got))
    assert d.contaminated(docs_of([]), benchmark).count() == 0
    assert d.contaminated(df, benchmark.limit(0)).count() == 0
