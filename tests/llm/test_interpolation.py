"""Scores of the interpolated model against counts and mixtures in plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch.llm import blocks, interpolation
from panelwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
ORDER = interpolation.ORDER


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def kind_of(i):
    if i is None:
        return 1
    c = zlib.crc32(str(i).encode())
    return 0 if c % 7 == 2 else 2 if c // 7 % interpolation.DELETED == 3 else 1


def counts_of(docs, kinds):
    """Counters of all orders (contexts of starts included) over documents of these kinds."""
    grams = [Counter() for _ in range(ORDER + 1)]
    for i, t in docs:
        if kind_of(i) in kinds:
            w = [""] * (ORDER - 1) + tokens_of(t)
            for p in range(ORDER - 1, len(w)):
                for k in range(1, ORDER + 1):
                    grams[k][tuple(w[p - k + 1 : p + 1])] += 1
            for k in range(1, ORDER):
                grams[k]["start", k] += 1  # contexts of nothing but starts
    return grams


def mixtures(docs, grams, kinds, distinct):
    """Per document of these kinds: (bucket, estimates) of its tokens."""
    total = sum(v for g, v in grams[1].items() if g[0] != "start")
    for i, t in docs:
        if kind_of(i) in kinds:
            w = [""] * (ORDER - 1) + tokens_of(t)
            out = []
            for p in range(ORDER - 1, len(w)):
                f, bucket = [1 / (distinct + 1), grams[1][(w[p],)] / max(total, 1)], [min(total.bit_length(), 15)]
                for k in range(2, ORDER + 1):
                    ctx = tuple(w[p - k + 1 : p])
                    c = grams[k - 1]["start", k - 1] if not any(x != "" for x in ctx) else grams[k - 1][ctx]
                    f.append(grams[k][tuple(w[p - k + 1 : p + 1])] / c if c else 0.0)
                    bucket.append(min(c.bit_length(), 15))
                out.append((sum(b * 16**n for n, b in enumerate(bucket)), f))
            yield i, out


def plain_weights(held, rounds):
    may = interpolation.allowed(ORDER)
    weights = may / may.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        sums = np.zeros(weights.shape)
        for _, toks in held:
            for b, f in toks:
                share = weights[b] * f
                sums[b] += share / share.sum()
        weights = interpolation.shares(sums, may)
    return weights


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def plain_scores(docs, weights):
    grams = counts_of(docs, (1, 2))
    distinct = sum(1 for g in grams[1] if g[0] != "start")
    total = sum(v for g, v in grams[1].items() if g[0] != "start")
    out = []
    for (i, t), (_, toks) in zip(docs, mixtures(docs, grams, (0, 1, 2), distinct)):
        c = [grams[1][(w,)] for w in tokens_of(t)]
        base = sum(math.log10((x + 1) / (total + distinct + 1)) for x in c)
        out.append((i, len(c), sum(x > 0 for x in c), total, base, sum(math.log10(float((weights[b] * f).sum())) for b, f in toks)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, round(x, 6) if isinstance(x, float) else x) for x in r))


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(order(got), order(want)):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9, abs=1e-9) and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)


COLUMNS = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_scores_equal_plain_counts(spark, documents, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", 3000)
    monkeypatch.setattr(blocks, "KEYS_PER_PART", 7000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learns = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    model = interpolation.train(docs, learns)
    assert model.blocks.count() > 4 and model.answers[1].select("part").distinct().count() > 3
    same([tuple(r) for r in interpolation.scores(model).select("id", *COLUMNS).collect()], plain_scores(documents, model.weights))
    grams = counts_of(documents, (1,))
    held = list(mixtures(documents, grams, (2,), model.totals.distinct))
    assert sum(len(t) for _, t in held) > 300
    for k in (1, 2, 3):
        monkeypatch.setattr(interpolation, "MOST_ROUNDS", k)
        rows = [(np.array([b for b, _ in t], np.uint32).tobytes(), np.array([f for _, f in t]).tobytes()) for _, t in held]
        found = interpolation.learn_weights(spark.createDataFrame(rows, "bucket binary, estimates binary"), ORDER)
        assert np.abs(found - plain_weights(held, k)).max() < 1e-8


def test_query_over_the_whole_table(spark, documents):
    rows = QUERIES["op12_interpolated_scores"](spark, SF).collect()
    again = QUERIES["op12_interpolated_scores"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert {r.doc_id: r.held_out for r in rows} == {i: kind_of(i) == 0 for i, _ in documents}
    out = [r for r in rows if r.held_out and r.n_tokens > 1]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # better on texts it never saw


def test_probabilities_of_all_words_sum_to_one(documents):
    grams = counts_of(documents[:30], (1, 2))
    words = [g for g in grams[1] if g[0] != "start"]
    weights = plain_weights([], 1)
    total = sum(grams[1][w] for w in words)
    for ctx in [("", ""), ("", words[0][0]), next((g[0], g[1]) for g in grams[2] if "start" not in g and "" not in g and None not in g)]:
        seen = [total] + [grams[k]["start", k] if not any(c != "" for c in ctx[2 - k :]) else grams[k][ctx[2 - k :]] for k in (1, 2)]
        b = sum(min(c.bit_length(), 15) * 16**n for n, c in enumerate(seen))
        p = 0.0
        for w in [*words, ("never seen",)]:
            f = [1 / (len(words) + 1), grams[1][w] / total, grams[2][ctx[1:] + w] / max(seen[1], 1), grams[3][ctx + w] / max(seen[2], 1)]
            p += float((weights[b] * f).sum())
        assert p == pytest.approx(1.0)


def test_odd_rows_and_empty_tables(spark, docs, odd, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", 500)
    df = docs(odd).withColumns({"kind": F.lit("own"), "block": F.lit("own"), "part": F.lit("own")})
    learns = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, F.lit(True))
    model = interpolation.train(df, learns)
    pairs = [(i, t) for i, t, *_ in odd]
    same([tuple(r) for r in interpolation.scores(model).select("id", *COLUMNS).collect()], plain_scores(pairs, model.weights))
    none = interpolation.scores(interpolation.train(df, F.lit(False))).collect()
    assert len(none) == len(odd) and all(r.score == 0 and r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in none)
    assert interpolation.scores(interpolation.train(df.limit(0), learns)).collect() == []
