"""Document scores by a language model with deleted interpolation.

The probability of a token mixes maximum-likelihood estimates of all orders up to ``ORDER``
and a uniform share for unknown words.  The weights depend on how often each context was
seen (``bucket``).  Some training documents are deleted from the counts, and expectation-
maximisation on them, with estimates from the retained rest, learns the weights; the
final estimates come from all training documents.

Counts of any size never meet in one place: blocks of documents ask for the sums of their
n-grams (``blocks``), so no n-gram is sent more often than once per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.llm import blocks as bl
from panelwatch.llm.steps import settle

ORDER = 3
#: One in so many training documents is deleted, to learn the weights.
DELETED = 16
#: Contexts seen 2**(BUCKETS - 2) times or more share a bucket; bucket 0 is for unseen ones.
BUCKETS = 16
MOST_ROUNDS = 25
GAIN = 1e-5
#: Tokens of the overall weights that each bucket's own ones start with.
PRIOR = 5.0
SCORED_ONLY, KEPT, HELD = 0, 1, 2


@dataclass
class Totals:
    """Tokens and documents of training, of its retained part, and distinct training tokens."""

    tokens: int
    docs: int
    retained_tokens: int
    retained_docs: int
    distinct: int


def buckets(contexts: list[np.ndarray]) -> np.ndarray:
    """One number for the context frequencies of all orders."""
    out = np.zeros(len(contexts[0]) if contexts else 0, np.int64)
    for c in reversed(contexts):
        out = out * BUCKETS + np.minimum(np.frexp(c.astype(np.float64))[1], BUCKETS - 1)
    return out


def estimates(block: bl.Block, counts: list[np.ndarray], tokens: int, docs: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """Each token's bucket and its estimates by order, the uniform one first; ``counts`` are per token, by order."""
    out = [np.full(len(block.tokens), 1.0 / (distinct + 1)), counts[0] / max(tokens, 1)]
    contexts = [block.after(c, docs) for c in counts[:-1]]
    for c, x in zip(counts[1:], contexts):
        out.append(c / np.maximum(x, 1))
    seen = np.full(len(block.tokens), tokens, np.int64)
    return buckets([seen, *contexts]), np.stack(out, axis=1)


def allowed(order: int) -> np.ndarray:
    """Which estimates each bucket has: those whose context was seen, and the uniform one."""
    n = np.arange(BUCKETS**order)
    return np.stack([n >= 0] + [n // BUCKETS**k % BUCKETS > 0 for k in range(order)], axis=1)


def per_token(block: bl.Block, sums: list[np.ndarray]) -> list[np.ndarray]:
    return [s[block.grams(k + 1)[1]] for k, s in enumerate(sums)]


def held_estimates(t: Totals):
    """Arrow function: blocks of deleted documents to their tokens' buckets and estimates from the retained rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, sums in bl.visits(batches):
            own, f = estimates(block, per_token(block, sums), t.retained_tokens, t.retained_docs, t.distinct)
            yield pa.RecordBatch.from_arrays(
                [pa.array([own.astype(np.uint32).tobytes()], pa.binary()), pa.array([f.tobytes()], pa.binary())], names=["bucket", "estimates"]
            )

    return run


def expected(weights: np.ndarray):
    """Arrow function: one row per bucket of a task: expected tokens of each estimate, and the log likelihood."""
    k = weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, like = np.zeros(weights.shape), np.zeros(len(weights))
        for b in batches:
            for own, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own, f = np.frombuffer(own, np.uint32), np.frombuffer(f).reshape(-1, k)
                share = weights[own] * f
                p = share.sum(axis=1)
                share /= p[:, None]
                for c in range(k):
                    sums[:, c] += np.bincount(own, share[:, c], len(weights))
                like += np.bincount(own, np.log(p), len(weights))
        some = np.flatnonzero(sums.sum(axis=1))
        lists = pa.array([sums[i] for i in some], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), lists, pa.array(like[some])], names=["bucket", "expected", "like"])

    return run


def shares(sums: np.ndarray, may: np.ndarray) -> np.ndarray:
    """Weights of all buckets from expected tokens: one token spread over all, then the overall ones as a prior."""
    whole = sums.sum(axis=0) + 1.0 / sums.shape[1]
    start = np.where(may, whole, 0.0)
    out = np.where(may, sums, 0.0) + PRIOR * start / start.sum(axis=1, keepdims=True)
    return out / out.sum(axis=1, keepdims=True)


def learn_weights(held: DataFrame, order: int) -> np.ndarray:
    """Weights by bucket, by expectation-maximisation over all deleted tokens.

    A round is one pass over the deleted tokens and sends one row per bucket and task to the
    shuffle, and one row per bucket to the driver.
    """
    may = allowed(order)
    weights = may / may.sum(axis=1, keepdims=True)
    before = None
    for _ in range(MOST_ROUNDS):
        parts = held.mapInArrow(expected(weights), "bucket int, expected array<double>, like double")
        cols = [F.sum(F.col("expected")[k]).alias(f"e{k}") for k in range(order + 1)]
        rows = parts.groupBy("bucket").agg(*cols, F.sum("like").alias("like")).collect()
        if not rows:
            break
        sums = np.zeros(weights.shape)
        for r in rows:
            sums[r["bucket"]] = [r[f"e{k}"] for k in range(order + 1)]
        like = sum(r["like"] for r in rows) / sums.sum()
        weights = shares(sums, may)
        if before is not None and like - before < GAIN:
            break
        before = like
    rounded = np.maximum(np.round(weights, 9), np.where(may, 1e-9, 0.0))  # sums in any order give the same
    return rounded / rounded.sum(axis=1, keepdims=True)


def score(t: Totals, weights: np.ndarray):
    """Arrow function: block rows with answers to one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, sums in bl.visits(batches):
            counts = per_token(block, sums)
            own, f = estimates(block, counts, t.tokens, t.docs, t.distinct)
            logs = np.log10((weights[own] * f).sum(axis=1))
            base = np.log10((counts[0] + 1) / (t.tokens + 1 * (t.distinct + 1)))
            known = np.add.reduceat((counts[0] > 0).astype(np.int64), block.firsts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, pa.int64()), pa.array(block.lengths), pa.array(known), pa.array(np.add.reduceat(base, block.firsts)),
                 pa.array(np.add.reduceat(logs, block.firsts))],
                names=["id", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


@dataclass
class Model:
    """What was learned, with the blocks of all documents and the answers to them."""

    blocks: DataFrame
    answers: list[DataFrame]
    totals: Totals
    weights: np.ndarray
    n_tokens: int


def train(docs: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> Model:
    """Counts of all documents for which ``learns`` is true, and the weights; other documents only ask for counts."""
    number = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0))
    deleted = F.floor(number / 7) % DELETED == 3
    kind = F.when(~learns, SCORED_ONLY).when(deleted, HELD).otherwise(KEPT)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), kind.alias("kind"), F.col(text_col).alias("text"))
    blocks = bl.encoded(rows)
    found = {r["kind"]: r for r in blocks.groupBy("kind").agg(F.sum("n_tokens").alias("tokens"), F.sum("n_docs").alias("docs")).collect()}
    of = lambda c, *kinds: sum(found[k][c] for k in kinds if k in found)
    everything = of("tokens", SCORED_ONLY, KEPT, HELD)
    answers = [bl.answered(blocks, gram_counts(k), everything, (KEPT, HELD), (KEPT,), (HELD,)) for k in range(1, order + 1)]
    distinct = answers[0].agg(F.sum("fresh").alias("n")).first()["n"] or 0
    totals = Totals(of("tokens", KEPT, HELD), of("docs", KEPT, HELD), of("tokens", KEPT), of("docs", KEPT), distinct)
    held = bl.with_answers(blocks.filter(F.col("kind") == HELD), answers, "retained", of("tokens", HELD))
    held = settle(held.mapInArrow(held_estimates(totals), "bucket binary, estimates binary"), bl.BATCH_BYTES)
    return Model(blocks, answers, totals, learn_weights(held, order), everything)


def gram_counts(k: int):
    def keys_of(block: bl.Block) -> tuple[np.ndarray, np.ndarray]:
        keys, place = block.grams(k)
        return keys, np.bincount(place, minlength=len(keys))

    return keys_of


def scores(model: Model) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every document, in no order.

    Texts are lower-cased (A-Z) words and one end.  ``base_score`` is the log10 probability by
    counts plus one, ``score`` the model's; words that training lacks share the uniform
    estimate of one further word.  Null and empty texts are an end alone; a null id learns
    where ``learns`` says so and never is deleted; rows that repeat have a score each.  With no training
    documents both scores are 0.  An empty table gives an empty table; other columns are not read.
    Words and n-grams are equal if their 64-bit hashes are.
    """
    rows = bl.with_answers(model.blocks, model.answers, "trained", model.n_tokens)
    out = rows.mapInArrow(score(model.totals, model.weights), "id long, n_tokens long, n_known long, base_score double, score double")
    out = settle(out, bl.BATCH_BYTES)
    return out.withColumn("train_tokens", F.lit(model.totals.tokens).cast("long"))
