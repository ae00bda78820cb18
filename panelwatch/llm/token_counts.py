"""Token counts by a map-side lookup of pre-token lengths; no pre-token is shuffled.

A text is cut into pre-tokens at bytes that no piece of the model spans: before each run
of spaces and before each line feed.  Merges never cross such a cut, so the counts of the
pre-tokens add up to the library's count of the text.

Tier 1 is a broadcast table of 64-bit hashes and lengths of frequent pre-tokens, at most
``FREQUENT`` entries; tier 2 encodes the others once per worker and keeps them in a
bounded cache.  The table holds the heaviest of what all tasks report from the whole
corpus, ``REPORTED`` pre-tokens each; it only saves time and never changes a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm import scan

FREQUENT = 65_536
REPORTED = 2_048
LONGEST = 64
CACHED = 400_000

_FIRST = np.uint64(0xA0761D6478BD642F)


class Pieces:
    """Counts of a sentencepiece model for single pre-tokens."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def separable(self) -> bool:
        """Whether no piece of several characters holds a line feed or a space mark after another character."""
        mark = "▁"
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = [self.model.encode(t, out_type=str) for t in ("aÅb", " a  b ", "a\nb")]
        identity = probe[0][0].startswith(mark) and "".join(probe[1]) == f"{mark}{mark}a{mark}{mark}b{mark}" and len(self.model.encode("ﬁ", out_type=str)) > 0
        return identity and not any(mark in p.lstrip(mark) or "\n" in p for p in pieces)

    def whole(self, texts: list[str]) -> list[int]:
        return [len(t) for t in self.model.encode(texts, num_threads=1)]

    def parts(self, parts: list[tuple[bytes, bool]]) -> np.ndarray:
        """Lengths of pre-tokens, each with whether it begins its text."""
        texts, less = [], []
        for raw, first in parts:
            t = raw.decode("utf-8", "replace")
            if not first and t.startswith(" "):
                t = t[1:]
                less.append(0 if t else -1)
            else:
                less.append(0 if first else 1)
            texts.append(t)
        return np.array(self.whole(texts), np.int64) - np.array(less, np.int64)


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, and whether each begins a text."""
    space = data == 32
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    if len(data) > 3:  # the model's own space mark, written out in a text, merges with spaces behind it
        cut[3:] &= (data[:-3] != 0xE2) | (data[1:-2] != 0x96) | (data[2:-1] != 0x81)
    cut |= data == 10
    begins = offsets[:-1][np.diff(offsets) > 0]
    cut[begins] = True
    starts = np.flatnonzero(cut)
    first = np.zeros(len(data), bool)
    first[begins] = True
    return starts, np.append(starts[1:], len(data)), first[starts]


def _hashes(data, starts, ends, first, powers) -> np.ndarray:
    h = scan.word_hashes(data, starts, ends, powers)
    h[first] ^= _FIRST
    return h


def report_frequent(reported: int, longest: int):
    """Arrow function: the pre-tokens that a task has met most, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, kept_h, kept_n, kept_t = scan.Powers(), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, object)
        for b in batches:
            data, offsets = scan.column(b, "text")
            for i, j in scan.runs(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, first = pre_tokens(part, at)
                few = ~first & (ends - starts <= longest)
                starts, ends = starts[few], ends[few]
                h, one, n = np.unique(_hashes(part, starts, ends, np.zeros(len(starts), bool), powers), return_index=True, return_counts=True)
                top = np.argsort(-n, kind="stable")[: 2 * reported]
                raw = part.tobytes()
                t = np.empty(len(top), object)
                t[:] = [raw[starts[k] : ends[k]] for k in one[top]]
                all_h, back = np.unique(np.concatenate([kept_h, h[top]]), return_inverse=True)
                all_n = np.bincount(back, np.concatenate([kept_n, n[top]]), len(all_h)).astype(np.int64)
                all_t = np.empty(len(all_h), object)
                all_t[back] = np.concatenate([kept_t, t])
                best = np.argsort(-all_n, kind="stable")[: 4 * reported]
                kept_h, kept_n, kept_t = all_h[best], all_n[best], all_t[best]
        n = min(reported, len(kept_n))
        yield pa.RecordBatch.from_arrays([pa.array(list(kept_t[:n]), pa.binary()), pa.array(kept_n[:n])], names=["part", "n"])

    return run


def frequent_table(texts: DataFrame, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and token counts of the most frequent pre-tokens; at most ``FREQUENT``."""
    seen = texts.mapInArrow(report_frequent(REPORTED, LONGEST), "part binary, n long")
    top = seen.groupBy("part").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "part").limit(FREQUENT)
    parts = [bytes(r["part"]) for r in top.select("part").collect()]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    h = scan.word_hashes(data, ends - [len(p) for p in parts], ends, scan.Powers())
    n = Pieces(path).parts([(p, False) for p in parts])
    order = np.argsort(h)
    return h[order], n[order]


def count(path: str, table, longest_cache: int):
    """Arrow function: texts to their numbers of tokens; other columns pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, powers, cache = Pieces(path), scan.Powers(), {}
        known, sizes = table.value
        cuts = pieces.separable()
        for b in batches:
            data, offsets = scan.column(b, "text")
            total = np.zeros(b.num_rows, np.int64)
            for i, j in scan.runs(offsets):
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                if not cuts:
                    raw = part.tobytes()
                    total[i:j] = pieces.whole([raw[s:e].decode("utf-8", "replace") for s, e in zip(at[:-1], at[1:])])
                    continue
                starts, ends, first = pre_tokens(part, at)
                if not len(starts):
                    continue
                h = _hashes(part, starts, ends, first, powers)
                k = np.searchsorted(known, h)
                k[k == len(known)] = 0
                hit = known[k] == h if len(known) else np.zeros(len(h), bool)
                n = np.where(hit, sizes[k], 0) if len(known) else np.zeros(len(h), np.int64)
                miss = np.flatnonzero(~hit)
                u, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
                got = np.array([cache.get(x, -1) for x in u.tolist()], np.int64)
                new = np.flatnonzero(got < 0)
                if len(new):
                    raw = part.tobytes()
                    got[new] = pieces.parts([(raw[starts[m] : ends[m]], bool(first[m])) for m in miss[one[new]]])
                    if len(cache) + len(new) > longest_cache:
                        cache.clear()
                    cache.update(zip(u[new].tolist(), got[new].tolist()))
                n[miss] = got[back]
                sums = np.append(0, np.cumsum(n))
                total[i:j] = np.diff(sums[np.searchsorted(starts, at)])
            yield pa.RecordBatch.from_arrays([*b.drop_columns(["text"]).columns, pa.array(np.diff(offsets)), pa.array(total)],
                                             names=[*b.drop_columns(["text"]).schema.names, "n_bytes", "n_tokens"])

    return run


def with_token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row, as the model's library counts them.

    No begin, end or added special tokens; a special string within a text is ordinary text.
    Null and empty texts have no bytes and no tokens.  Rows that repeat are counted each;
    ids may be null; other columns are not read; an empty table gives an empty table.
    A model whose pieces span the cuts is applied to whole texts.
    """
    texts = docs.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(texts.select("text"), path))
    kind = docs.schema[id_col].dataType.simpleString()
    return texts.mapInArrow(count(path, table, CACHED), f"`{id_col}` {kind}, n_bytes long, n_tokens long")
