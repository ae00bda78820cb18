"""Phrase collocations against plain counting."""

import re
from collections import Counter

import pytest

from panelwatch.llm import blocks, phrases

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, best):
    """(lang, rank, phrase, a, l, r, n, score) from (lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 5):
                    if i + k <= len(w):
                        f[lang, tuple(w[i : i + k])] += 1
    longer = Counter()
    for (lang, p), a in f.items():
        if a >= least and len(p) > 2:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[lang, p[i : i + k]] = max(longer[lang, p[i : i + k]], a)
    out = {}
    for (lang, p), a in f.items():
        if a >= least and len(p) > 1 and 100 * longer[lang, p] < 80 * a:
            score, _, x, y = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), x, y))
    return {
        (lang, rank, p.decode(), -a, x, y, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, x, y) in enumerate(sorted(found)[:best], 1)
    }


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def texts(rng, n, hot):
    """Documents of few words, a third of them with one very common word, pair and passage."""
    words = ["a", "B", "c", "dé", "e-e", "ff", "東京", "g", "h", "🙂", "i", "long" * 50]
    out = []
    for k in range(n):
        w = [rng.choice(words[: 3 + k % 9]) for _ in range(rng.randint(0, 40))]
        if hot and k % 3 == 0:
            w += ["the", "Very", "same", "passage", "Of", "many"] * 4
        marks = [" ", " ", "  ", "\t", "\n", ", ", ".", " ; ", "\x0b", "\x0d\x0a", " "]
        out.append((["en", "de", None, "und", "", "E"][k % 6], "".join(x + rng.choice(marks) for x in w)))
    return out


@pytest.mark.parametrize("budget", [1, 40, 1 << 22])
def test_phrases_equal_plain_counts(spark, budget, monkeypatch):
    """Small budgets split prefixes of one, two and three words over groups."""
    import random

    monkeypatch.setattr(phrases, "GROUP_SUFFIXES", budget)
    monkeypatch.setattr(phrases, "HELD_PREFIXES", 500 if budget == 1 else 1 << 21)
    monkeypatch.setattr(phrases, "HEAVY_SHARE", 64 if budget == 40 else 1 << 16)
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", 400)
    monkeypatch.setattr(blocks, "KEYS_PER_PART", 300)
    monkeypatch.setattr(phrases.scan, "RUN_BYTES", 2000)
    rows = texts(random.Random(budget), 240, True) + [("en", None), (None, ""), ("en", " ..\n,, "), ("fr", "one"), ("fr", "...")]
    rows += [("en", "two words. " * 3000), ("xx", "tie one, tie two, " * 30), ("xx", "up to. up to " * 15)]
    df = spark.createDataFrame([(*r, 1, "own", "own") for r in rows], "lang string, text string, n int, rank string, phrase string").repartition(3)
    for least, best in ((30, 2000), (4, 7)):
        got = [tuple(r) for r in phrases.collocations(df, least=least, best=best).select(*COLUMNS).collect()]
        want = plain(rows, least, best)
        assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 30


def test_prefixes_are_split_within_the_budget(spark, monkeypatch):
    import random

    monkeypatch.setattr(phrases, "GROUP_SUFFIXES", 60)
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", 400)
    monkeypatch.setattr(phrases.scan, "RUN_BYTES", 2000)
    seen = {}
    real = phrases.partitioned

    def spy(tokens, words, total):
        seen["known"] = real(tokens, words, total)
        return seen["known"]

    monkeypatch.setattr(phrases, "partitioned", spy)
    df = spark.createDataFrame(texts(random.Random(1), 200, True), "lang string, text string")
    phrases.counted(df, "lang", "text", 30)
    known = seen["known"]
    assert all(len(k) for k in known.keys) and all((c > 60).all() for c in known.counts)
    assert known.groups.max() > 10


def test_empty_tables_and_wide_products(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).collect() == []
    big = 9 * 10**18
    nodes = spark.createDataFrame([(2, 1, 2, 0, 0, big - 5, big, 0, 0)], phrases.NODES)
    words = spark.createDataFrame([(1, big, "en", "x"), (2, big - 1, "en", "y")], "id long, n long, lang string, word string")
    row = phrases.scored(nodes, words, 2 * big).first()
    assert row.score == 2_000_000 * (big - 5) // (2 * big - 1) and (row.l, row.r, row.lang) == (big, big - 1, "en")
