"""Token ids in packed rows of one length, as binary matrices.

Each task tokenizes its own documents, so nothing is shuffled.  Up to ``BLOCK_TOKENS``
tokens are packed together by best-fit decreasing: pieces in falling length go to the
open row with the least room that still holds them, found in a segment tree over rooms.
Documents longer than a row are split at row length; no token is dropped.

An output row is one row of an id matrix: ``input_ids`` (little-endian uint16, or uint32
for large vocabularies, filled up with the end mark), ``position_ids`` of the same width,
which restart at 0 with each piece, ``cu_seqlens`` (cumulative piece lengths from 0),
and for each piece the document and its first token there.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm import scan

ROW = 2048
BLOCK_TOKENS = 2 << 20


class RoomTree:
    """Which rooms (0 to ``row``) some open row has; finds the least one of at least a size."""

    def __init__(self, row: int) -> None:
        self.leaves = 1 << row.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(row + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = room + self.leaves
        while i and not self.any[i]:
            self.any[i] = 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes an open row with the least room >= ``size``: (room, row)."""
        i = size + self.leaves
        if not self.any[i]:
            while i > 1 and not (i % 2 == 0 and self.any[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        room = i - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.any[i] = 0
            i >>= 1
            while i and not (self.any[2 * i] or self.any[2 * i + 1]):
                self.any[i] = 0
                i >>= 1
        return room, row


def best_fit(sizes: np.ndarray, row: int) -> list[list[int]]:
    """Pieces (1 to ``row`` tokens) of each row, in the order they are laid; equal sizes keep their order."""
    rows: list[list[int]] = []
    tree = RoomTree(row)
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        if size == row:
            rows.append([piece])
            continue
        got = tree.take(size)
        if got:
            room, at = got
            rows[at].append(piece)
        else:
            room, at = row, len(rows)
            rows.append([piece])
        if room > size:
            tree.add(room - size, at)
    return rows


def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


_PACKED = (
    "shard int, block int, row int, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<{kind}>, doc_starts array<int>"
)


def pack(path: str, pattern: str, end_mark: int, row: int, width: str, block_tokens: int):
    """Arrow function over (id, text): packed rows."""

    def rows_of(shard: int, block: int, ids: pa.Array, texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(t) for t in texts])
        flat = np.concatenate(texts).astype(width) if texts else np.empty(0, width)
        firsts = np.append(0, np.cumsum(lengths))
        pieces = -(-lengths // row)
        doc = np.repeat(np.arange(len(lengths)), pieces)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * row
        sizes = np.minimum(row, lengths[doc] - start)
        packed = best_fit(sizes, row)
        counts = np.array([len(p) for p in packed])
        order = np.array([i for p in packed for i in p], np.int64)
        edges = np.append(0, np.cumsum(counts))
        ramp = np.arange(row, dtype=width)
        for a in range(0, len(packed), 256):
            z = min(a + 256, len(packed))
            matrix, places, cuts, used = np.full((z - a, row), end_mark, width), np.zeros((z - a, row), width), [], []
            for r in range(a, z):
                at, bounds = 0, [0]
                for i in order[edges[r] : edges[r + 1]].tolist():
                    n, s = int(sizes[i]), int(firsts[doc[i]] + start[i])
                    matrix[r - a, at : at + n] = flat[s : s + n]
                    places[r - a, at : at + n] = ramp[:n]
                    at += n
                    bounds.append(at)
                cuts.append(bounds)
                used.append(at)
            own = order[edges[a] : edges[z]]
            offsets = pa.array((edges[a : z + 1] - edges[a]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(z - a, shard, np.int32)),
                    pa.array(np.full(z - a, block, np.int32)),
                    pa.array(np.arange(a, z, dtype=np.int32)),
                    pa.array(used, pa.int32()),
                    pa.array([m.tobytes() for m in matrix], pa.binary()),
                    pa.array([m.tobytes() for m in places], pa.binary()),
                    pa.array(cuts, pa.list_(pa.int32())),
                    pa.ListArray.from_arrays(offsets, ids.take(pa.array(doc[own]))),
                    pa.ListArray.from_arrays(offsets, pa.array(start[own].astype(np.int32))),
                ],
                names=[c.split()[0] for c in _PACKED.split(", ")],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, block = encoding(path, pattern), TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0
        for b in batches:
            data, offsets = scan.column(b, "text")
            for k in range(b.num_rows):
                text = data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")
                texts.append(coder.encode_to_numpy(text, allowed_special=set(), disallowed_special=()))
                held += len(texts[-1])
                if held >= block_tokens or k == b.num_rows - 1:
                    ids.append(b.column(0).slice(k + 1 - (len(texts) - sum(map(len, ids))), len(texts) - sum(map(len, ids))))
                if held >= block_tokens:
                    yield from rows_of(shard, block, pa.concat_arrays(ids), texts)
                    ids, texts, held, block = [], [], 0, block + 1
        if texts:
            yield from rows_of(shard, block, pa.concat_arrays(ids), texts)

    return run


def packed_rows(docs: DataFrame, path: str, pattern: str, end_mark: int, id_col: str = "doc_id", text_col: str = "text",
                row: int = ROW, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The packed rows of all documents; see the module for the columns.

    ``shard`` is the input partition, ``block`` counts in it, ``row`` counts in the block.
    Null and empty texts have no tokens and no piece; repeated rows and null ids are packed
    like others; pieces of equal size keep their order.  An empty table gives an empty
    table; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    width = "<u2" if max(end_mark, row) < 1 << 16 else "<u4"
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(pack(path, pattern, end_mark, row, width, block_tokens), _PACKED.format(kind=kind))


def texts_back(rows: list[dict], path: str, pattern: str, wide: bool = False) -> dict:
    """id to text, put together from packed rows; what tests and readers of small files use."""
    coder, parts = encoding(path, pattern), {}
    for r in rows:
        ids, cuts = np.frombuffer(r["input_ids"], "<u4" if wide else "<u2"), r["cu_seqlens"]
        for doc, start, a, z in zip(r["doc_ids"], r["doc_starts"], cuts, cuts[1:]):
            parts.setdefault(doc, []).append((start, ids[a:z].tolist()))
    return {doc: coder.decode([t for _, piece in sorted(p) for t in piece]) for doc, p in parts.items()}
