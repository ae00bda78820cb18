"""Blocks of documents with word lists of their own, and sums that blocks ask for by key.

A block is one row of about ``BLOCK_TOKENS`` tokens of whole documents (a longer document
makes a block of its own): its distinct words as sorted 64-bit hashes, and each token as
its place in that list.  Blocks are of one kind each, so that counts by kind need one number.

A block asks for the sums of its keys over all blocks (``answered``): a request row holds
its keys of one part of the hash range with its own counts.  The requests of a part meet in
one task, which adds them up and answers each in its own order.  A key stands at most once
in a block, however often it occurs there, so none is hot; parts are cut by the number of
tokens, so a task holds a bounded number of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm import scan
from panelwatch.llm.steps import settle
from panelwatch.session import task_count

BLOCK_TOKENS = 1 << 18
KEYS_PER_PART = 1 << 20
#: What a Python step gets at once.
BATCH_BYTES = 16 << 20
MOST_TASKS = 50_000

START, END = np.uint64(0x6A09E667F3BCC908), np.uint64(0xBB67AE8584CAA73B)

BLOCKS = "block long, kind int, n_docs long, n_tokens long, ids array<long>, lengths binary, words binary, tokens binary"
REQUESTS = "part int, block long, kind int, keys binary, counts binary"
ANSWERS = "block long, part int, fresh long, trained binary, retained binary"


def small(a: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold them, the width first."""
    top = int(a.max()) if len(a) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + a.astype(f"<u{width}").tobytes()


def unsmall(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


class _Pending:
    """Documents of one kind that do not fill a block yet."""

    def __init__(self, kind: int) -> None:
        self.kind, self.size, self.ids, self.lengths, self.seqs = kind, 0, [], [], []

    def add(self, ids: list, lengths: np.ndarray, seq: np.ndarray) -> None:
        self.ids += ids
        self.lengths.append(lengths)
        self.seqs.append(seq)
        self.size += len(seq)

    def row(self, block: int) -> pa.RecordBatch:
        seq, lengths = np.concatenate(self.seqs), np.concatenate(self.lengths)
        words, tokens = np.unique(seq, return_inverse=True)
        values = [block, self.kind, len(lengths), len(seq), self.ids, small(lengths), words.tobytes(), tokens.astype(np.uint32).tobytes()]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        names = [c.split()[0] for c in BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)


def with_ends(hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with one end after each document, and the documents' numbers of tokens."""
    n = np.diff(firsts)
    return np.insert(hashes, firsts[1:], END), n + 1


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (id, kind, text) to block rows."""
    powers, pending, made = scan.Powers(), {}, 0
    task = TaskContext.get().partitionId() << 32
    for b in batches:
        data, offsets = scan.column(b, "text")
        ids, kinds = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
        for i, j in scan.runs(offsets):
            part, at = scan.lower(data[offsets[i] : offsets[j]]), offsets[i : j + 1] - offsets[i]
            starts, ends, firsts = scan.word_spans(part, at)
            seq, lengths = with_ends(scan.word_hashes(part, starts, ends, powers), firsts)
            for kind in np.unique(kinds[i:j]):
                own = kinds[i:j] == kind
                p = pending.setdefault(int(kind), _Pending(int(kind)))
                p.add([ids[i + k] for k in np.flatnonzero(own)], lengths[own], seq[np.repeat(own, lengths)])
                if p.size >= BLOCK_TOKENS:
                    yield pending.pop(int(kind)).row(task + made)
                    made += 1
    for p in pending.values():
        yield p.row(task + made)
        made += 1


def encoded(docs: DataFrame) -> DataFrame:
    """The settled blocks of (id long, kind int, text string) rows."""
    return settle(docs.select("id", "kind", "text").mapInArrow(encode, BLOCKS), BATCH_BYTES, "zstd")


class Block:
    """One block row as arrays."""

    def __init__(self, row: dict) -> None:
        self.block, self.kind, self.ids = row["block"], row["kind"], row["ids"]
        self.words = np.frombuffer(row["words"], np.uint64)
        self.tokens = np.frombuffer(row["tokens"], np.uint32)
        self.lengths = unsmall(row["lengths"])
        self.firsts = np.cumsum(self.lengths) - self.lengths

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes of each token with the ``k - 1`` before it (starts before the first), and each token's place there."""
        if k == 1:
            return self.words, self.tokens
        prev = seq = self.words[self.tokens]
        h = scan.mix(seq + np.uint64(k))
        for _ in range(k - 1):
            prev = self.after(prev, START)
            h = h * np.uint64(0xD6E8FEB86659FD93) + prev
        return np.unique(scan.mix(h), return_inverse=True)

    def after(self, values: np.ndarray, first) -> np.ndarray:
        """The value of the token before each token; ``first`` where a document begins."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.firsts] = first
        return out


def edges(parts: int) -> np.ndarray:
    """The first hash of each part but the first."""
    return np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)


def ask(keys_of: Callable[[Block], tuple[np.ndarray, np.ndarray]], parts: int):
    """Arrow function: block rows to request rows; ``keys_of`` gives sorted distinct keys and their counts in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner = edges(parts)
        for b in batches:
            for row in b.to_pylist():
                block = Block(row)
                keys, counts = keys_of(block)
                cut = np.concatenate(([0], np.searchsorted(keys, inner), [len(keys)]))
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array([block.block] * len(some), pa.int64()), pa.array([block.kind] * len(some), pa.int32()),
                     pa.array([keys[cut[p] : cut[p + 1]].tobytes() for p in some], pa.binary()),
                     pa.array([small(counts[cut[p] : cut[p + 1]]) for p in some], pa.binary())],
                    names=[c.split()[0] for c in REQUESTS.split(", ")],
                )

    return run


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The rows of one part at a time; they lie side by side."""
    part, held = None, []
    for b in batches:
        for r in b.to_pylist():
            if held and r["part"] != part:
                yield part, held
                held = []
            part = r["part"]
            held.append(r)
    if held:
        yield part, held


def answer(train: tuple[int, ...], retain: tuple[int, ...], both: tuple[int, ...]):
    """Arrow function: the requests of each part to answers.

    ``trained`` are the sums over blocks of the kinds ``train``; ``retained``, over the kinds ``retain``,
    go to blocks of the kinds ``both`` only.  ``fresh``, on one row of a part, counts its keys that ``train`` has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in by_part(batches):
            keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
            unique, place = np.unique(np.concatenate(keys), return_inverse=True)
            counts = [unsmall(r["counts"]) for r in rows]
            total = lambda kinds: np.bincount(
                place, np.concatenate([c if r["kind"] in kinds else np.zeros(len(c)) for r, c in zip(rows, counts)]), len(unique)
            ).astype(np.int64)
            trained, retained = total(train), total(retain)
            cut = np.cumsum([0] + [len(k) for k in keys])
            out = {"block": [], "part": [], "fresh": [], "trained": [], "retained": []}
            for n, r in enumerate(rows):
                own = place[cut[n] : cut[n + 1]]
                out["block"].append(r["block"])
                out["part"].append(part)
                out["fresh"].append(0 if n else int((trained > 0).sum()))
                out["trained"].append(small(trained[own]))
                out["retained"].append(small(retained[own]) if r["kind"] in both else None)
            yield pa.RecordBatch.from_pydict(out, schema=_ANSWERED)

    return run


_ANSWERED = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("fresh", pa.int64()), ("trained", pa.binary()), ("retained", pa.binary())])


def tasks(spark: SparkSession, n_tokens: int) -> int:
    """Partitions for steps over the keys of so many tokens."""
    return min(MOST_TASKS, max(task_count(spark), -(-n_tokens // (4 * KEYS_PER_PART))))


def answered(blocks: DataFrame, keys_of: Callable[[Block], tuple[np.ndarray, np.ndarray]], n_tokens: int, train: tuple[int, ...],
             retain: tuple[int, ...] = (), both: tuple[int, ...] = ()) -> DataFrame:
    """The settled answers to what every block asks."""
    requests = blocks.mapInArrow(ask(keys_of, max(1, -(-n_tokens // KEYS_PER_PART))), REQUESTS)
    asked = requests.repartition(tasks(blocks.sparkSession, n_tokens), "part").sortWithinPartitions("part")
    return settle(asked.mapInArrow(answer(train, retain, both), ANSWERS), BATCH_BYTES, "zstd")


def with_answers(blocks: DataFrame, answers: list[DataFrame], column: str, n_tokens: int) -> DataFrame:
    """Block rows (``level`` 0) and, behind each, the answers to it, by level and part."""
    empty = lambda **has: [has.get(f, F.lit(None)).cast(t).alias(f) for f, t in _VISITED.items()]
    rows = blocks.select(*empty(**{f: F.col(f) for f in blocks.columns if f in _VISITED}, level=F.lit(0)))
    for k, a in enumerate(answers):
        one = a.filter(F.col(column).isNotNull())
        rows = rows.unionByName(one.select(*empty(block=F.col("block"), level=F.lit(k + 1), part=F.col("part"), sums=F.col(column))))
    return rows.repartition(tasks(blocks.sparkSession, n_tokens), "block").sortWithinPartitions("block", "level", "part")


_VISITED = {"block": "long", "level": "int", "part": "int", "kind": "int", "ids": "array<long>", "lengths": "binary", "words": "binary",
            "tokens": "binary", "sums": "binary"}


def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, list[np.ndarray]]]:
    """Each block of ``with_answers``, with its sums by level in the order of its keys."""
    block, sums = None, {}
    for b in batches:
        for r in b.to_pylist():
            if r["level"] == 0:
                if block is not None:
                    yield block, [np.concatenate(sums[k]) for k in sorted(sums)]
                block, sums = Block(r), {}
            elif block is not None and r["block"] == block.block:
                sums.setdefault(r["level"], []).append(unsmall(r["sums"]))
    if block is not None:
        yield block, [np.concatenate(sums[k]) for k in sorted(sums)]
