import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from llm_fixtures import docs_of, llm  # noqa: F401

from tidemark.llm import language
from tidemark.llm.common import fold
from tidemark.llm.text import text_bytes

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["stre", "ung", "pf"], "cc": ["ción", "ña", "que"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def labelled(n=60, seed=3):
    rng = random.Random(seed)
    return [(i, prose(rng, lang, 40), lang, "s") for i, lang in enumerate(rng.choices(list(SYLLABLES), k=n))]


def brute_model(rows, languages):
    """Counts per context length, language and context, pruned as the fit prunes."""
    counts = [{lang: Counter() for lang in languages} for _ in range(language.CONTEXT + 1)]
    for _, text, lang, _ in rows:
        raw = text.encode()
        for k in range(language.CONTEXT + 1):
            for i in range(len(raw) - k):
                counts[k][lang][raw[i : i + k + 1]] += 1
    for k in range(3, language.CONTEXT + 1):
        for lang in languages:
            counts[k][lang] = Counter({r: n for r, n in counts[k][lang].items() if n > 1})
    return counts


def brute_bits(counts, lang, raw, i):
    follow = [defaultdict(dict) for _ in counts]
    for k, by_lang in enumerate(counts):
        for run, n in by_lang[lang].items():
            follow[k][run[:-1]][run[-1]] = n

    def p(k):
        if k < 0:
            return 1 / 256
        seen = follow[k].get(raw[i - k : i], {}) if i >= k else {}
        if not seen:
            return p(k - 1) if k else 1 / 256
        total, distinct = sum(seen.values()), len(seen)
        extra = 1 if k == 0 else 0
        below = 1 / 256 if k == 0 else p(k - 1)
        return seen.get(raw[i], 0) / (total + distinct + extra) + (distinct + extra) / (
            total + distinct + extra
        ) * below

    return -math.log2(p(language.CONTEXT))


def test_code_lengths_are_exact(docs_of):
    rows = labelled(12)
    model = language.fit(docs_of(rows))
    counts = brute_model(rows, model.languages)
    texts = ["kalo mika", "", "x", "ción strung", "zzz kalo"]
    data, offsets = text_bytes(pa.array(texts))
    cost = model.code_lengths(data, offsets)
    for t, text in enumerate(texts):
        raw = text.encode()
        for i in range(len(raw)):
            for j, lang in enumerate(model.languages):
                assert math.isclose(cost[offsets[t] + i, j], brute_bits(counts, lang, raw, i), rel_tol=1e-4)


def test_long_texts_in_parts_cost_the_same(docs_of, monkeypatch):
    model = language.fit(docs_of(labelled(12)))
    data, offsets = text_bytes(pa.array(["kalo mi " * 500, "", "strung " * 30]))
    whole = language._told(model, data, offsets)
    monkeypatch.setattr(language, "CHUNK", language.PIECE * 5)
    parts = language._told(model, data, offsets)
    assert np.allclose(whole[0], parts[0]) and np.allclose(whole[1], parts[1])


def test_languages_are_told_apart_on_held_out_rows(docs_of):
    df = docs_of(labelled(300))
    held = fold("doc_id", 4) == 2
    told = language.identify(df.filter(held), language.fit(df.filter(~held)))
    rows = told.collect()
    assert len(rows) > 40 and all(r.lang_pred == r.lang and r.score > 0.9 for r in rows)


def test_edge_cases(docs_of):
    model = language.fit(docs_of([*labelled(30), (99, None, "aa", "s"), (98, "kalo", None, "s")]))
    rows = [(1, None), (2, ""), (3, "123 !?"), (None, "kalo mi"), (5, "kalo mi"), (5, "kalo mi"), (6, "kalo " * 70_000)]
    df = docs_of(rows).selectExpr("*", "'old' AS lang_pred", "3 AS score", "4 AS best")
    got = {(r.doc_id, r.text): r for r in language.identify(df, model).collect()}
    assert [got[k].lang_pred for k in rows[:3]] == ["und"] * 3
    assert all(got[k].score == 0 and got[k].bits_per_byte is None for k in rows[:3])
    assert all(got[k].lang_pred == "aa" and got[k].best == 4 for k in rows[3:])
    assert language.identify(df, model).count() == len(rows)
    assert language.identify(docs_of([]), model).count() == 0
    unlearned = language.identify(df, language.fit(docs_of([]))).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}


def test_the_larger_part_of_a_mixed_text_wins(docs_of):
    rng = random.Random(5)
    model = language.fit(docs_of(labelled(60)))
    text = prose(rng, "aa", 60) + " " + prose(rng, "bb", 25)
    row = language.identify(docs_of([(1, text)]), model).first()
    assert row.lang_pred == "aa" and 0.5 < row.score < 0.95


def test_every_language_of_the_data_is_learned(docs_of):
    text = lambda k: f"{chr(0x4E00 + 7 * k)}{chr(0x3400 + 11 * k)} " * 12
    rows = [(2 * k + i, text(k), f"l{k:03d}", "s") for k in range(230) for i in range(2)]
    model = language.fit(docs_of(rows))
    assert model.languages == [f"l{k:03d}" for k in range(230)]
    told = language.identify(docs_of(rows), model).collect()
    assert all(r.lang_pred == r.lang for r in told)
