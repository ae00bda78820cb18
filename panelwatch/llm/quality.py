"""Quality verdicts: gradient-boosted trees over document statistics.

Statistics of whole texts are counted in numpy on the executors.  The trees are grown on
at most ``TRAIN_ROWS`` labelled rows (those with the smallest hashed ids, so the choice
does not depend on the layout), flattened into node arrays and applied to all rows of a
batch level by level.  The score never falls with features marked +1 in ``MONOTONE`` and
never rises with those marked -1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm import scan
from panelwatch.llm.steps import settle

TRAIN_ROWS = 20_000
LOW = 1.5
TREES = 40
DEPTH = 3
BINS = 64
RATE = 0.2
MIN_HESSIAN = 5.0
#: Share of the good training rows that must score at least the threshold.
KEEP_GOOD = 0.998

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_chars"]
MONOTONE = {
    "log_words": 0,
    "word_length": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "digit_share": -1,
    "mark_share": -1,
    "line_words": 0,
}
FEATURES = list(MONOTONE)


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_LETTER = _table(bytes(range(65, 91)) + bytes(range(97, 123)))
_DIGIT = _table(bytes(range(48, 58)))
_MARK = _table(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False


def _per_doc(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[edges])


def _owned(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one document."""
    return scan.mix(h + (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def statistics(data: np.ndarray, offsets: np.ndarray, powers: scan.Powers) -> dict[str, np.ndarray]:
    docs = len(offsets) - 1
    starts, ends, firsts = scan.word_spans(data, offsets)
    words = scan.word_hashes(data, starts, ends, powers)
    owner = np.repeat(np.arange(docs), np.diff(firsts))
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[starts] += 1
    in_word[ends] -= 1
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    adjacent = ends[:-1] == starts[1:]  # the last word of a text and the first of the next
    in_word[starts[1:][adjacent]] = True

    repeats = np.zeros(len(words), bool)
    grams = scan.window_hashes(words, 3)
    if len(grams):
        at = np.flatnonzero(owner[2:] == owner[:-2])
        _, back, n = np.unique(_owned(grams[at], owner[at]), return_inverse=True, return_counts=True)
        for k in range(3):
            repeats[at[n[back] > 1] + k] = True

    cut = data == 10
    line_start = np.zeros(len(data) + 1, bool)
    line_start[offsets] = True
    line_start[1:] |= cut
    line_at = np.flatnonzero(line_start[:-1])
    line_end = np.append(line_at[1:], len(data))
    line_owner = np.searchsorted(offsets, line_at, "right") - 1
    bare_end = line_end - (cut[line_end - 1] if len(line_end) else 0)
    with_word = np.searchsorted(starts, line_at) < np.searchsorted(starts, line_end)
    line_at, bare_end, line_owner = line_at[with_word], bare_end[with_word], line_owner[with_word]
    h = scan.word_hashes(data, line_at, bare_end, powers)
    _, one = np.unique(_owned(h, line_owner), return_index=True)
    n_lines = np.bincount(line_owner, minlength=docs)

    return {
        "n_words": np.diff(firsts),
        "word_chars": _per_doc(in_word & _LEAD[data], offsets),
        "n_symbols": _per_doc(_SYMBOL[data], offsets),
        "n_dup_lines": n_lines - np.bincount(line_owner[one], minlength=docs),
        "n_repeat_words": _per_doc(repeats, firsts),
        "n_lines": n_lines,
        "n_upper": _per_doc(_UPPER[data], offsets),
        "n_letters": _per_doc(_LETTER[data] | (data >= 0xC0), offsets),
        "n_digits": _per_doc(_DIGIT[data], offsets),
        "n_marks": _per_doc(_MARK[data], offsets),
        "n_chars": _per_doc(_LEAD[data], offsets),
    }


def count_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: texts to their statistics; other columns pass."""
    powers = scan.Powers()
    for b in batches:
        data, offsets = scan.column(b, "text")
        rest = b.drop_columns(["text"])
        for i, j in scan.runs(offsets):
            got = statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], powers)
            columns = [pa.array(got[c].astype(np.int64)) for c in COUNTS]
            yield pa.RecordBatch.from_arrays([*rest.slice(i, j - i).columns, *columns], names=[*rest.schema.names, *COUNTS])


def features(counts) -> np.ndarray:
    """(rows, features) from a table of counts."""
    c = {k: np.asarray(counts[k], float) for k in COUNTS}
    of = lambda a, b: a / np.maximum(b, 1)
    by_name = {
        "log_words": np.log1p(c["n_words"]),
        "word_length": of(c["word_chars"], c["n_words"]),
        "symbol_share": of(c["n_symbols"], c["n_words"]),
        "dup_line_share": of(c["n_dup_lines"], c["n_lines"]),
        "repeat_share": of(c["n_repeat_words"], c["n_words"]),
        "upper_share": of(c["n_upper"], c["n_letters"]),
        "digit_share": of(c["n_digits"], c["n_chars"]),
        "mark_share": of(c["n_marks"], c["n_chars"]),
        "line_words": of(c["n_words"], c["n_lines"]),
    }
    return np.stack([by_name[f] for f in FEATURES], axis=1)


@dataclass
class Trees:
    """All nodes of all trees in flat arrays; a leaf is its own child on both sides."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int
    threshold: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """The chance of being good, for all rows at once."""
        if not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.start)))
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            right = x[rows, self.feature[node]] > self.cut[node]
            node = np.where(right, self.right[node], self.left[node])
        return 1 / (1 + np.exp(-(self.start + self.value[node].sum(axis=1))))


class _Grower:
    """One tree on binned features; leaves stay within bounds that keep the order of siblings."""

    def __init__(self, binned: np.ndarray, cuts: list[np.ndarray], signs: list[int], depth: int) -> None:
        self.binned, self.cuts, self.signs, self.depth = binned, cuts, signs, depth

    def grow(self, g: np.ndarray, h: np.ndarray, nodes: list[list]) -> int:
        return self._node(np.arange(len(g)), g, h, -np.inf, np.inf, self.depth, nodes)

    def _node(self, rows, g, h, low, high, depth, nodes) -> int:
        me = len(nodes)
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + 1.0), low, high))
        nodes.append([0, np.inf, me, me, value * RATE])
        best = self._best(rows, g, h, low, high) if depth else None
        if best:
            f, b, middle = best
            right = self.binned[rows, f] > b
            up = self.signs[f]
            bounds = ((low, middle), (middle, high)) if up > 0 else ((middle, high), (low, middle)) if up < 0 else ((low, high),) * 2
            l = self._node(rows[~right], g, h, *bounds[0], depth - 1, nodes)  # noqa: E741
            r = self._node(rows[right], g, h, *bounds[1], depth - 1, nodes)
            nodes[me] = [f, float(self.cuts[f][b]), l, r, 0.0]
        return me

    def _best(self, rows, g, h, low, high):
        best, most = None, 1e-6
        G, H = g[rows].sum(), h[rows].sum()
        for f, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            n = len(cuts) + 1
            gl = np.cumsum(np.bincount(self.binned[rows, f], g[rows], n))[:-1]
            hl = np.cumsum(np.bincount(self.binned[rows, f], h[rows], n))[:-1]
            gr, hr = G - gl, H - hl
            vl, vr = np.clip(-gl / (hl + 1), low, high), np.clip(-gr / (hr + 1), low, high)
            gain = -(gl * vl + 0.5 * (hl + 1) * vl**2) - (gr * vr + 0.5 * (hr + 1) * vr**2)
            v = np.clip(-G / (H + 1), low, high)
            gain -= -(G * v + 0.5 * (H + 1) * v**2)
            gain[(hl < MIN_HESSIAN) | (hr < MIN_HESSIAN) | (self.signs[f] * (vr - vl) < 0)] = 0
            b = int(np.argmax(gain))
            if gain[b] > most:
                best, most = (f, b, float((vl[b] + vr[b]) / 2)), gain[b]
        return best


def fit(x: np.ndarray, good: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees on (rows, features) and 0/1 labels; without both labels, no trees and no verdict."""
    share = np.clip(good.mean() if len(good) else 1.0, 1e-3, 1 - 1e-3)
    start, nodes, roots = float(np.log(share / (1 - share))), [], []
    if 0 < good.sum() < len(good):
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
        cuts = [c[c < v.max()] for c, v in zip(cuts, x.T)]
        binned = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T)], axis=1)
        grower, margin = _Grower(binned, cuts, list(MONOTONE.values()), depth), np.full(len(x), start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            roots.append(grower.grow(p - good, np.maximum(p * (1 - p), 1e-6), nodes))
            flat = _flat(nodes, roots[-1:], 0.0, depth)
            s = flat.score(x)
            margin += np.log(s / (1 - s))
    model = _flat(nodes, roots, start, depth)
    if roots:
        s = np.sort(model.score(x[good == 1]))
        model.threshold = float(min(0.5, s[int((1 - KEEP_GOOD) * len(s))]))
    return model


def _flat(nodes: list[list], roots: list[int], start: float, depth: int) -> Trees:
    columns = list(zip(*nodes)) if nodes else [[]] * 5
    kinds = (np.int64, float, np.int64, np.int64, float)
    return Trees(*(np.array(c, k) for c, k in zip(columns, kinds)), np.array(roots, np.int64), start, depth)


def apply(model: Trees):
    """Pandas function: counts to score and verdict; other columns pass."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["score"] = model.score(features(f)) if len(f) else pd.Series(dtype=float)
            f["kept"] = (f["score"] >= model.threshold) & ~f["base_failed"].astype(bool)
            yield f

    return run


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id of every row with its statistics, ``base_failed``, ``score`` and ``kept``.

    ``labels`` has the id and ``quality`` (1 good, 0 bad; rows with null are left out; of
    several labels of one id the worst counts).  Null and empty texts have no words and
    fail the base rules.  Rows that repeat are judged each; without labels of both kinds
    the base rules decide alone.  An empty table gives an empty table.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    counted = settle(texts.mapInArrow(count_statistics, ", ".join([f"id {kind}", *(f"{c} long" for c in COUNTS)])))
    known = labels.filter("quality is not null").groupBy(F.col(id_col).alias("id")).agg(F.min("quality").alias("quality"))
    known = settle(known.withColumn("h", F.xxhash64(F.col("id").cast("string"))))
    low = (LOW * TRAIN_ROWS / max(1, known.count()) - 0.5) * 2.0**64  # below it lie about LOW times as many as are wanted
    rows = counted.join(known.filter(F.col("h") <= low), "id").orderBy("h", *COUNTS).limit(TRAIN_ROWS).toPandas()
    model = fit(features(rows), rows["quality"].to_numpy(float))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed)
    out = counted.mapInPandas(apply(model), ", ".join(f"{n} {t}" for n, t in counted.dtypes) + ", score double, kept boolean")
    return out.withColumnRenamed("id", id_col)
