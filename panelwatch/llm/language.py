"""Language of whole texts by error-correcting output codes.

Each language has a codeword; each bit has a binary classifier, a logistic regression on
hashed byte trigrams of the lower-cased text with everything but letters as blanks.  A
text gets the language whose codeword has the least logistic loss under the bits' margins.
Two codewords of nearly equal loss make the text ambiguous.

The classifiers are fitted on at most ``PER_LANGUAGE`` rows of each language (those with
the smallest hashed ids) and at most ``TRAIN_ROWS`` in all, of the rows whose text has a letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.llm import scan
from panelwatch.llm.steps import settle

PER_LANGUAGE = 400
TRAIN_ROWS = 4_000
BUCKETS = 1 << 12
LOW = 3
EXHAUSTIVE = 6
STEPS = 300
#: Least difference in loss between the two nearest codewords of a clear text.
CLEAR = 0.2
UNKNOWN = "und"
FOUND = ["lang_pred", "score", "ambiguous"]

_LETTERS = scan._LOWER.copy()
_LETTERS[[c for c in range(128) if not chr(c).isalpha()]] = 32


def codewords(n: int) -> np.ndarray:
    """(languages, bits) of -1 and 1: all splits for few languages, else the best of random codes."""
    if n <= EXHAUSTIVE:
        bits = max(1, 2 ** (n - 1) - 1)
        return np.array([[1 if l == 0 or (b >> (l - 1)) & 1 == 0 else -1 for b in range(1, bits + 1)] for l in range(n)])  # noqa: E741
    rng, best, most = np.random.default_rng(11), None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], (n, int(np.ceil(10 * np.log2(n)))))
        apart = ((code[:, None] != code[None]).sum(axis=2) + np.eye(n, dtype=int) * 10**6).min()
        if apart > most and (abs(code.sum(axis=0)) < n).all():
            best, most = code, apart
    return best


def trigrams(data: np.ndarray) -> np.ndarray:
    """The bucket of the trigram at each position; -1 without a letter."""
    t = _LETTERS[data].astype(np.uint32)
    if len(t) < 3:
        return np.empty(0, np.int64)
    g = t[:-2] | (t[1:-1] << np.uint32(8)) | (t[2:] << np.uint32(16))
    h = ((g * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64) % BUCKETS
    h[g == 0x202020] = -1
    return h


def _within(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Drops trigrams that reach into the next text."""
    for back in (1, 2):
        at = offsets[1:-1] - back
        h[at[(at >= 0) & (at < len(h))]] = -1
    return h


def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (lang, text) to (lang, trigram shares as float32)."""
    for b in batches:
        data, offsets = scan.column(b, "text")
        rows = []
        for s, e in zip(offsets[:-1], offsets[1:]):
            h = trigrams(data[s:e])
            n = np.bincount(h[h >= 0], minlength=BUCKETS)
            rows.append((n / max(n.sum(), 1)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], names=["lang", "shares"])


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(rows, bits) for the texts of one run."""
        h = _within(trigrams(data), offsets)
        at = np.flatnonzero(h >= 0)
        edges = np.searchsorted(at, offsets)
        n = np.diff(edges)
        out = np.zeros((len(n), self.weights.shape[1]))
        some = np.flatnonzero(n)
        if len(some):
            out[some] = np.add.reduceat(self.weights[h[at]], edges[:-1][some], axis=0, dtype=np.float64) / n[some, None]
        return out + self.bias

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its share of the weight, and the lead over the next."""
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]).sum(axis=2)
        order = np.sort(loss, axis=1)
        lead = order[:, 1] - order[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
        return loss.argmin(axis=1), 1 / np.exp(order[:, :1] - loss).sum(axis=1), lead


def fit(languages: list[str], shares: np.ndarray, which: np.ndarray) -> Model:
    """All bits at once: logistic regression by accelerated gradient steps on standardised shares."""
    code = codewords(len(languages))
    x = shares.astype(np.float32)
    mean, spread = x.mean(axis=0), x.std(axis=0) + np.float32(1e-4)
    x = (x - mean) / spread / np.float32(np.sqrt(x.shape[1]))
    y = code[which].astype(np.float32)
    w, bias = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    ahead, speed, rate = w.copy(), bias.copy(), np.float32(8.0)
    for step in range(STEPS):
        m = x @ ahead + speed
        g = -y / (1 + np.exp(y * m)) / len(x)
        new_w, new_b = ahead - rate * (x.T @ g + np.float32(1e-4) * ahead), speed - rate / 8 * g.sum(axis=0)
        k = np.float32(step / (step + 3))
        ahead, speed = new_w + k * (new_w - w), new_b + k * (new_b - bias)
        w, bias = new_w, new_b
    scale = 1 / spread / np.float32(np.sqrt(x.shape[1]))
    weights = w * scale[:, None]
    return Model(languages, code, weights.astype(np.float32), bias - mean @ weights)


def apply(model: Model, carry: bool):
    """Arrow function over rows with ``text`` and, last, ``_lettered``; the other columns pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], object)
        for b in batches:
            data, offsets = scan.column(b, "text")
            lettered = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            rest = b.drop_columns(["_lettered"] if carry else ["_lettered", "text"])
            for i, j in scan.runs(offsets):
                best, share, lead = model.decode(model.margins(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                known = lettered[i:j]
                found = [
                    pa.array(names[np.where(known, best, -1)], pa.string()),
                    pa.array(np.where(known, np.clip(share, 0, 1), 0.0)),
                    pa.array(known & (lead < CLEAR)),
                ]
                yield pa.RecordBatch.from_arrays([*rest.slice(i, j - i).columns, *found], names=[*rest.schema.names, *FOUND])

    return run


def lettered(text_col: str) -> Column:
    """Whether a text is there and has a letter."""
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model of the rows with a language and a text with a letter; none if there are no such rows.

    At most ``PER_LANGUAGE`` rows of a language are learnt from, those with the smallest hashes of id
    and text; rows that repeat count once, rows of one id with other texts each.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & lettered(text_col)).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    known = known.withColumn("h", F.xxhash64("id", "text"))
    counts = settle(known.groupBy("lang").agg(F.approx_count_distinct("h").alias("count")))
    n = counts.count()
    if not n:
        return None
    if n > TRAIN_ROWS:
        raise ValueError(f"{n} languages; at most {TRAIN_ROWS} can be learnt")
    each = max(1, min(PER_LANGUAGE, TRAIN_ROWS // n))
    low = (F.lit(LOW * each) / F.col("count") - 0.5) * 2.0**64  # hashes below hold about LOW times as many rows as are wanted
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    # at most TRAIN_ROWS languages, checked above
    few = known.select("lang", "h").join(F.broadcast(counts), "lang").filter(F.col("h") <= low).select("lang", "h").distinct()
    chosen = few.withColumn("rank", rank).filter(F.col("rank") <= each).select("lang", "h")
    # at most TRAIN_ROWS short rows, by the rank above
    sample = known.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))
    got = sample.select("lang", "text").mapInArrow(vectors, "lang string, shares binary").toPandas().sort_values(["lang", "shares"])
    if got.empty:
        return None
    languages = sorted(got["lang"].unique())
    shares = np.frombuffer(b"".join(got["shares"]), np.float32).reshape(-1, BUCKETS)
    return fit(languages, shares, np.searchsorted(languages, got["lang"].to_numpy(str)))


def with_language(docs: DataFrame, model: Model | None, text_col: str = "text", carry: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``; without the text unless ``carry``.

    Null texts and texts without a letter get ``und`` and score 0; so do all without a
    model.  Rows that repeat are judged each, equal losses go to the language that sorts
    first, and an empty table gives an empty one.  Columns of the new names are replaced,
    others kept.
    """
    docs = docs.drop(*FOUND)
    if model is None:
        out = docs.withColumns(dict(zip(FOUND, (F.lit(UNKNOWN), F.lit(0.0), F.lit(False)))))
        return out if carry else out.drop(text_col)
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(*others, F.col(text_col).alias("text"), lettered(text_col).alias("_lettered"))
    kept = T.StructType([f for f in rows.schema.fields if f.name != "_lettered" and (carry or f.name != "text")])
    schema = kept.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    out = rows.mapInArrow(apply(model, carry), schema)
    return out.withColumnRenamed("text", text_col) if carry else out
