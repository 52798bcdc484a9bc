import random
import re

import numpy as np
import pytest

from llm_fixtures import docs_of, llm  # noqa: F401

from tidemark.llm import ngram_join as nj
from tidemark.llm.groups import Sets
from tidemark.llm.ngram_join import Bands, Threshold, join_across, join_within, ngram_components

LIMIT = Threshold(90, 100)


def families(rng, count, most=300):
    """Random sets around common bases, from equal ones to unlike ones."""
    sets = []
    for _ in range(count):
        n = int(rng.integers(1, most))
        base = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        for _ in range(rng.integers(1, 8)):
            s = base.copy()
            k = int(n * rng.uniform(0, 0.12))
            s[rng.integers(0, n, k)] = rng.integers(0, 2**63, k).astype(np.uint64)
            sets.append(np.unique(s))
    return sets


def true_links(sets, num=90, den=100):
    out = []
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if den * both >= num * (len(a) + len(b) - both):
                out.append((i, j))
    return out


def parts(n, links):
    sets = Sets(n)
    for i, j in links:
        sets.join(i, j)
    return sets.labels().tolist()


@pytest.mark.parametrize("bits", [1 << 16, 64])
def test_trees_find_what_all_pairs_find(monkeypatch, bits):
    monkeypatch.setattr(nj, "MOST_BITS", bits)
    rng = np.random.default_rng(bits)
    for _ in range(12):
        sets = families(rng, int(rng.integers(1, 10)))
        links = true_links(sets)
        assert parts(len(sets), join_within(sets, LIMIT)) == parts(len(sets), links)
        h = len(sets) // 2
        if h:
            a, b = sets[:h], sets[h:]
            across = join_across(a, list(range(h)), b, list(range(h, len(sets))), LIMIT)
            found = [(i, h + j) for i, j in across]
            found += join_within(a, LIMIT) + [(h + i, h + j) for i, j in join_within(b, LIMIT)]
            assert parts(len(sets), found) == parts(len(sets), links)
            assert all((max(i, j), min(i, j)) in links for i, j in found)


def test_most_node_pairs_are_pruned():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, 200).astype(np.uint64)) for _ in range(400)]
    maps, hidden = nj.bitmaps(sets)
    tree = nj.Tree(sets, maps, hidden)
    labels = np.arange(len(sets))
    assert not list(nj.traverse(tree, tree, LIMIT, labels, labels, itself=True))


def test_links_share_a_band():
    rng = np.random.default_rng(7)
    bands = Bands.of(LIMIT, 5)
    functions = bands.functions()
    sets = families(rng, 80)
    keys = [bands.keys(s, *functions) for s in sets]
    links = true_links(sets)
    assert len(links) > 30 and all((keys[i] == keys[j]).any() for i, j in links)
    assert (1 - 0.9**5) ** bands.bands <= nj.MISSED


def brute(docs, size, num, den):
    sets = {}
    for i, text in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        runs = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}
        sets[i] = runs or ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and den * len(a & b) >= num * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def corpus(seed, families=25):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randint(1, 3)))
    docs = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice([1, 2, 3, 30, 120, 400]))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = word()
            docs.append((len(docs) * 3, rng.choice([" ", "\n", "\t "]).join(copy).title()))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("tile", [2000, 3])
@pytest.mark.parametrize("limit,size", [((90, 100), 3), ((4, 5), 5)])
def test_components_equal_brute_force(docs_of, monkeypatch, tile, limit, size):
    monkeypatch.setattr(nj, "TILE", tile)
    docs = corpus(tile + size)
    got = ngram_components(docs_of(docs), Threshold(*limit), size, rows=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, size, *limit)


def test_edge_cases(docs_of):
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = [(None, "a b c d"), (None, None), (1, None), (2, ""), (3, " \n "), (4, "A b"), (5, "a B"), (6, "a b c d"),
            (6, "a b c d"), (9, "a b c d"), (10, long), (11, long + " x")]
    df = docs_of(docs).selectExpr("*", "1 AS n", "2 AS mark", "3 AS keys", "4 AS component_id", "5 AS block")
    got = [tuple(r) for r in ngram_components(df, LIMIT, 3).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(
        [(None, 2, None), (None, 0, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 2, 6), (6, 2, 6),
         (9, 2, 6), (10, 29_998, 10), (11, 29_999, 10)], key=key)
    assert ngram_components(docs_of([]), LIMIT, 3).count() == 0


def test_texts_of_one_id_are_nodes_of_their_own(docs_of):
    rng = random.Random(12)
    text = lambda: [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
    docs, want = [], []
    for i in range(20):
        a, b, other = text(), text(), text()
        docs += [(i, " ".join(a)), (i, " ".join(b)), (100 + i, " ".join([*a, "x"])), (200 + i, " ".join([*b, "y"]))]
        docs += [(300 + i, " ".join(other)), (i, " ".join(a))]
        want += [(i, i)] * 3 + [(100 + i, i), (200 + i, i), (300 + i, 300 + i)]
    for seed in (1, 2):
        random.Random(seed).shuffle(docs)
        got = ngram_components(docs_of(docs), LIMIT, 3).collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == sorted(want)
