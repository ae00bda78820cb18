"""The registered queries without SQL, over whole small tables, against plain Python."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_table_operators import plain_groups
from test_text_operators import base_of, plain_tiles, spans_of

from panelwatch.llm import decontamination, quality
from panelwatch.llm.queries import QUERIES, TOKEN_LIMIT, tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows_of(spark, name, *columns, sf=SF):
    return Counter(tuple(r) for r in QUERIES[name](spark, sf).select(*columns).collect())


def test_suffix_dedup(spark, documents):
    want = Counter()
    for (i, t), (spans, kept) in zip(documents, spans_of([t for _, t in documents], 200)):
        n = len((t or "").encode())
        want[i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()] += 1
    assert rows_of(spark, "op8_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_near_dedup(spark, documents):
    roots, sizes = plain_groups([t for _, t in documents])
    least = {}
    for (i, _), r in zip(documents, roots):
        least[r] = min(i, least.get(r, i))
    want = Counter((i, n, least[r], least[r] == i) for (i, _), r, n in zip(documents, roots, sizes))
    assert rows_of(spark, "op9_minhash_near_dedup", "doc_id", "n_shingles", "component_id", "kept") == want
    assert any(n > 1 for n in Counter(roots).values())


def test_token_counts(spark, documents):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    sizes = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in documents]
    want = Counter((i, b, n, n > TOKEN_LIMIT) for i, b, n in sizes)
    assert rows_of(spark, "op10_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_quality_trees(spark, documents):
    out = QUERIES["op4_quality_trees"](spark, SF).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert got == Counter((i, *(b := base_of(t)), b[0] < 50 or 100 * b[4] > 50 * b[0]) for i, t in documents)
    assert not any(r.kept and r.base_failed for r in out)


def test_quality_scores_tell_good_from_bad(spark):
    sf = "/root/testdata/sf0.01"
    scores = QUERIES["op4_quality_trees"](spark, sf).filter("not base_failed").select("doc_id", "score", "kept")
    rows = scores.join(spark.read.parquet(f"{sf}/labels.parquet").filter("quality is not null"), "doc_id").toPandas()
    good, bad = (rows[rows.quality == q].score.to_numpy() for q in (1, 0))
    assert len(good) and rows[rows.quality == 1].kept.mean() > 0.99
    if len(bad):
        assert (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean() > 0.8


def test_quality_of_documents_whose_label_was_kept_back(spark):
    """Trees grown on one half of the labels, held against the other."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality is not null").withColumn("half", F.expr("crc32(cast(doc_id as string)) % 2"))
    judged = quality.judged(spark.read.parquet(f"{sf}/documents.parquet"), labels.filter("half = 0")).filter("not base_failed")
    rows = judged.select("doc_id", "score", "kept").join(labels.filter("half = 1"), "doc_id").toPandas()
    good, bad = (rows[rows.quality == q] for q in (1, 0))
    assert len(good) > 50 and len(bad) > 5
    assert (good.score.to_numpy()[:, None] > bad.score.to_numpy()[None]).mean() > 0.95
    assert good.kept.mean() > 0.9 and bad.kept.mean() < 0.3


def test_held_out_languages(spark):
    """Languages of documents that no classifier saw."""
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op5_language_codes"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    both = found.join(docs, "doc_id").collect()
    assert len(both) == docs.count()
    lettered = [r for r in both if re.search(r"[^\W\d_]", r.text or "")]
    ids = {r.doc_id for r in lettered}
    assert all((r.lang_pred == "und") == (r.doc_id not in ids) for r in both)
    known = [r for r in lettered if r.held_out and r.lang is not None]
    assert len(known) > 100 and np.mean([r.lang_pred == r.lang for r in known]) > 0.97


def test_benchmark_tiling(spark, documents):
    """Coverage by tiles of every document and item that share a seed, longest first, without any index."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    split = lambda t: re.findall(r"[a-z0-9\x80-\xff]+", (t or "").encode().decode("latin-1").translate(LOWER))
    grams = lambda w: set(zip(*(w[k:] for k in range(decontamination.SEED))))
    patterns = [(i, w, grams(w)) for i, w in ((i, split(t)) for i, t in items) if len(w) >= decontamination.SEED]
    want = {}
    for i, t in documents:
        words = split(t)
        own = grams(words)
        shares = []
        for item, p, seeds in patterns:
            some = own & seeds
            if len(some) and len({w for g in some for w in g}) >= decontamination.COVERAGE * len(set(p)):
                near = {k + j for k in range(len(words)) if tuple(words[k : k + decontamination.SEED]) in some for j in range(decontamination.SEED)}
                text = [w if k in near else f"-{k}" for k, w in enumerate(words) if {k - 1, k, k + 1} & near]
                covered = sum(k for _, _, k in plain_tiles(text, p, decontamination.SEED))
                if covered >= decontamination.COVERAGE * len(p):
                    shares.append((-covered / len(p), item))
        want[i] = min(shares)[1] if shares else None
    got = {r.doc_id: r.item_id if r.contaminated else None for r in QUERIES["op1_benchmark_tiling"](spark, SF).collect()}
    assert got == want and any(v is not None for v in want.values()) and None in want.values()


LOWER = {c: c + 32 for c in range(65, 91)}


def test_packed_ids_hold_every_token(spark, documents):
    import public_tokenizers

    from panelwatch.llm.packing import texts_back

    packed = QUERIES["op7_packed_ids"](spark, SF).withColumn("n", F.size("doc_ids")).collect()
    back = texts_back([r.asDict() for r in packed], tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert {i: back.get(i, "") for i, _ in documents} == {i: t or "" for i, t in documents}
    assert all(r.n >= 1 for r in packed)
