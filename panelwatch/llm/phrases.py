"""Phrase collocations from suffix trees that are built group by group.

1. Blocks of documents (``blocks``) hold word lists of their own, per language.  They ask for
   the number of each word in the whole corpus; frequent words get numbers, and words below the
   least count cut phrases, for no phrase with one of them can reach it.
2. Vertical partitioning: each position has a window of the next ``DEPTH`` words at most, its
   suffix.  Suffixes go by prefix.  A word that starts more suffixes than a group's memory
   budget is split by the next word, and that prefix in turn; prefixes are dealt to slots, and
   slots packed into groups up to the budget.
3. Each group sorts its suffixes, which gives the subtree cut off at ``DEPTH``; the counts of
   inner nodes are sums of leaf totals.  A block sends each distinct suffix once, with its count.
4. A phrase's first parts are its ancestors in the tree; its rests are looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.llm import blocks as bl
from panelwatch.llm import scan
from panelwatch.llm.steps import settle

DEPTH = 4
LEAST = 30
SCALE = 2_000_000
PERCENT = 80
BEST = 2000
#: Suffixes of a group: what one task sorts in memory.
GROUP_SUFFIXES = 1 << 22
HELD_PREFIXES = 1 << 21
#: A prefix with more than this share of all words is kept in tables that every task gets.
HEAVY_SHARE = 1 << 16

_BREAK = np.zeros(256, bool)
_BREAK[[10, 11, 12, 13, *b".,;:!?"]] = True
_APART = _BREAK.copy()
_APART[[9, 32]] = True

BLOCKS = bl.BLOCKS + ", langs array<string>, lang_words array<long>, lang_of binary, sizes binary, texts binary"


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of many slices end to end."""
    ends = np.cumsum(sizes)
    return data[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


class _Pending:
    """Runs of documents that do not fill a block yet."""

    def __init__(self) -> None:
        self.size, self.langs, self.words, self.lang_of, self.sizes, self.texts, self.seqs = 0, {}, [], [], [], [], []
        self.counts: list[int] = []

    def lang(self, name: str) -> int:
        if name not in self.langs:
            self.langs[name] = len(self.langs)
            self.counts.append(0)
        return self.langs[name]

    def add(self, data: np.ndarray, at: np.ndarray, langs: list[str], powers: scan.Powers) -> None:
        starts, ends, firsts = scan.word_spans(data, at, _APART)
        per_doc = np.diff(firsts)
        numbers = np.array([self.lang(x) for x in langs], np.int64)
        for k, n in zip(numbers, per_doc):
            self.counts[k] += int(n)
        if not len(starts):
            return
        of = np.repeat(numbers, per_doc)
        salt = scan.mix(np.array([scan.word_hashes(*_one(x), powers)[0] for x in self.langs], np.uint64))
        h = scan.mix(scan.word_hashes(data, starts, ends, powers) + salt[of])
        # a break after a word that is the last of its document, or has a separating mark before the next word
        marks = np.concatenate(([0], np.cumsum(_BREAK[data])))
        last = np.zeros(len(starts), bool)
        last[:-1] = marks[starts[1:]] > marks[ends[:-1]]
        last[firsts[1:][per_doc > 0] - 1] = True
        words, one, place = np.unique(h, return_index=True, return_inverse=True)
        sizes = (ends - starts)[one]
        before = sum(map(len, self.words))
        seq = np.insert(place + before, np.flatnonzero(last) + 1, -1)
        self.words.append(words)
        self.lang_of.append(of[one])
        self.sizes.append(sizes)
        self.texts.append(gather(data, starts[one], sizes))
        self.seqs.append(seq)
        self.size += len(seq)

    def row(self, block: int) -> pa.RecordBatch:
        empty = [np.empty(0, np.int64)]
        words, one, place = np.unique(np.concatenate([*self.words, np.array([bl.END])]), return_index=True, return_inverse=True)
        sizes = np.concatenate([*(self.sizes or empty), [0]])
        starts = np.cumsum(sizes) - sizes
        texts = gather(np.concatenate(self.texts or [np.empty(0, np.uint8)]), starts[one], sizes[one])
        tokens = place[np.concatenate(self.seqs or empty)].astype(np.uint32)  # -1 is the end, the last of all words
        lang_of = np.concatenate([*(self.lang_of or empty), [0]])[one]
        values = [block, 0, 1, len(tokens), None, bl.small(np.array([len(tokens)])), words.tobytes(), tokens.tobytes(),
                  list(self.langs), self.counts, bl.small(lang_of), bl.small(sizes[one]), texts.tobytes()]
        return pa.RecordBatch.from_pylist([dict(zip(_BLOCKED.names, values))], schema=_BLOCKED)


def _one(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A whole text as one word; an empty one as a blank."""
    data = np.frombuffer(text.encode() or b" ", np.uint8)
    return data, np.array([0]), np.array([len(data)])


_BLOCKED = pa.schema(
    [("block", pa.int64()), ("kind", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64())),
     ("lengths", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary()), ("langs", pa.list_(pa.string())),
     ("lang_words", pa.list_(pa.int64())), ("lang_of", pa.binary()), ("sizes", pa.binary()), ("texts", pa.binary())]
)


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (lang, text) to block rows."""
    powers, pending, made = scan.Powers(), _Pending(), 0
    task = TaskContext.get().partitionId() << 32
    for b in batches:
        data, offsets = scan.column(b, "text")
        langs = b.column(0).to_pylist()
        for i, j in scan.runs(offsets):
            pending.add(scan.lower(data[offsets[i] : offsets[j]]), offsets[i : j + 1] - offsets[i], langs[i:j], powers)
            if pending.size >= bl.BLOCK_TOKENS:
                yield pending.row(task + made)
                pending, made = _Pending(), made + 1
    if pending.size:
        yield pending.row(task + made)


ASKED = "part int, block long, keys binary, counts binary, langs array<string>, lang_of binary, sizes binary, texts binary"


def ask_words(parts: int):
    """Arrow function: block rows to requests for word counts, with the words' texts and languages."""
    names = [c.split()[0] for c in ASKED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner = bl.edges(parts)
        for b in batches:
            for r in b.to_pylist():
                keys, tokens = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["tokens"], np.uint32)
                counts = np.bincount(tokens, minlength=len(keys))
                counts[keys == bl.END] = 0
                sizes, lang_of = bl.unsmall(r["sizes"]), bl.unsmall(r["lang_of"])
                at = np.concatenate(([0], np.cumsum(sizes)))
                cut = np.concatenate(([0], np.searchsorted(keys, inner), [len(keys)]))
                rows = []
                for p in np.flatnonzero(np.diff(cut)):
                    x, y = cut[p], cut[p + 1]
                    rows.append((int(p), r["block"], keys[x:y].tobytes(), bl.small(counts[x:y]), r["langs"], bl.small(lang_of[x:y]),
                                 bl.small(sizes[x:y]), r["texts"][at[x] : at[y]]))
                yield pa.RecordBatch.from_pylist([dict(zip(names, v)) for v in rows], schema=_ASKED)

    return run


_ASKED = pa.schema(
    [("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("langs", pa.list_(pa.string())),
     ("lang_of", pa.binary()), ("sizes", pa.binary()), ("texts", pa.binary())]
)
NUMBERED = "block long, part int, numbers binary, id long, n long, lang string, word string"
_NUMBERED = pa.schema(
    [("block", pa.int64()), ("part", pa.int32()), ("numbers", pa.binary()), ("id", pa.int64()), ("n", pa.int64()), ("lang", pa.string()), ("word", pa.string())]
)


def number_words(parts: int, least: int):
    """Arrow function: requests to answers (number of each key, 0 below ``least``) and one row per frequent word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in bl.by_part(batches):
            keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
            unique, one, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            n = np.bincount(place, np.concatenate([bl.unsmall(r["counts"]) for r in rows]), len(unique)).astype(np.int64)
            often = np.flatnonzero(n >= least)
            number = np.zeros(len(unique), np.int64)
            number[often] = np.arange(len(often)) * parts + part + 1
            cut = np.cumsum([0] + [len(k) for k in keys])
            out = [{"block": r["block"], "part": part, "numbers": bl.small(number[place[cut[k] : cut[k + 1]]])} for k, r in enumerate(rows)]
            for u in often:  # frequent words of one part, far fewer than its keys
                k = int(np.searchsorted(cut, one[u], "right")) - 1
                r, i = rows[k], one[u] - cut[k]
                if "at" not in r:
                    sizes = bl.unsmall(r["sizes"])
                    r["at"], r["of"] = np.concatenate(([0], np.cumsum(sizes))), bl.unsmall(r["lang_of"])
                text = r["texts"][r["at"][i] : r["at"][i + 1]].decode()
                out.append({"part": part, "id": int(number[u]), "n": int(n[u]), "lang": r["langs"][r["of"][i]], "word": text})
            for i in range(0, len(out), 1000):
                yield pa.RecordBatch.from_pylist(out[i : i + 1000], schema=_NUMBERED)

    return run


def next_of(w: np.ndarray) -> np.ndarray:
    return np.concatenate((w[1:], np.zeros(1, w.dtype)))


def number_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: blocks with their words' numbers to one row of token numbers each."""
    for block, (numbers,) in bl.visits(batches):
        yield pa.RecordBatch.from_arrays([pa.array([planes(numbers[block.tokens])], pa.binary())], names=["tokens"])


def token_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        for raw in b.column(0).to_pylist():
            yield unplanes(raw)


def suffixes(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct suffixes of a block as two numbers of two words each (0: no word), sorted, and their counts."""
    w = [tokens]
    for _ in range(DEPTH - 1):
        w.append(np.where(w[-1] > 0, next_of(w[-1]), 0).astype(np.uint64))
    w = [x[w[0] > 0] for x in w]
    return merged(w[0] << np.uint64(32) | w[1], w[2] << np.uint64(32) | w[3], np.ones(len(w[0]), np.int64))


def merged(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct suffixes with the sums of their counts."""
    if not len(hi):
        return hi, lo, n
    order = np.lexsort((lo, hi))
    hi, lo, n = hi[order], lo[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
    return hi[first], lo[first], np.add.reduceat(n, first)


class Prefixes:
    """Heavy prefixes of one, two and three words with their counts, and the group of each slot."""

    def __init__(self) -> None:
        none = np.empty(0, np.uint64)
        self.keys = [none, none, none]
        self.counts = [np.empty(0, np.int64)] * 3
        self.groups = np.zeros(1, np.int64)

    def find(self, level: int, keys: np.ndarray) -> np.ndarray:
        """The place of each key among the heavy prefixes of ``level`` + 1 words, -1 if it is none."""
        known = self.keys[level]
        if not len(known):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, at, -1)

    def heavy(self, hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
        """Places among the heavy prefixes, for one, two and three words; a longer one needs the shorter."""
        one = self.find(0, hi >> np.uint64(32))
        two = np.where(one >= 0, self.find(1, hi), -1)
        three = np.where(two >= 0, self.find(2, third(two, lo)), -1)
        return [one, two, three]

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each suffix: by its shortest prefix that is not heavy."""
        one, two, three = self.heavy(hi, lo)
        key = scan.mix(hi >> np.uint64(32))
        key = np.where(one >= 0, scan.mix(hi), key)
        key = np.where(two >= 0, scan.mix(scan.mix(hi) + (lo >> np.uint64(32))), key)
        key = np.where(three >= 0, scan.mix(scan.mix(hi) + scan.mix(lo)), key)
        return (key % np.uint64(len(self.groups))).astype(np.int64)


def third(two: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Key of a three-word prefix: the place of its first two words, and the third."""
    return np.maximum(two, 0).astype(np.uint64) << np.uint64(32) | lo >> np.uint64(32)


def prefix_counts(level: int, known: Prefixes):
    """Arrow function: prefixes of ``level`` + 1 words under heavy ones of ``level`` words, summed over a task's blocks.

    A task holds up to ``HELD_PREFIXES`` of them before it sends them on.
    """

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        key, n = (np.concatenate(x) for x in zip(*parts))
        own, place = np.unique(key, return_inverse=True)
        return own, np.bincount(place, n, len(own)).astype(np.int64)

    def rows(own: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], names=["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.empty(0, np.uint64), np.empty(0, np.int64))]
        for tokens in token_numbers(batches):
            hi, lo, n = suffixes(tokens)
            up = known.heavy(hi, lo)[level - 1]
            key = hi if level == 1 else third(up, lo)
            held.append((key[up >= 0], n[up >= 0]))
            if sum(len(k) for k, _ in held) > HELD_PREFIXES:
                held = [summed(held)]
                if len(held[0][0]) > HELD_PREFIXES // 2:
                    yield rows(*held.pop())
                    held = [(np.empty(0, np.uint64), np.empty(0, np.int64))]
        yield rows(*summed(held))

    return run


def slot_sums(level: int, known: Prefixes):
    """Arrow function: (prefix key, n) of light prefixes to sums of a task by slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(known.groups), np.int64)
        for b in batches:
            key, n = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()
            if level == 2:
                hi, lo = known.keys[1][(key >> np.uint64(32)).astype(np.int64)], key << np.uint64(32)
            else:
                hi, lo = (key << np.uint64(32) if level == 0 else key), np.zeros(len(key), np.uint64)
            light = known.find(level, key) < 0
            np.add.at(sums, known.slots(hi[light], lo[light]), n[light])
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["slot", "n"])

    return run


def partitioned(tokens: DataFrame, words: DataFrame, total: int) -> Prefixes:
    """Prefixes split where they are heavy, dealt to slots, and slots packed into groups.

    At most ``HEAVY_SHARE`` prefixes of each length are heavy, for their counts add up to ``total`` at most.
    """
    budget = max(GROUP_SUFFIXES, total // HEAVY_SHARE)
    known = Prefixes()
    tables = [words.select(F.col("id").alias("key"), "n")]
    for level in range(3):
        if level:
            if not len(known.keys[level - 1]):
                break
            tables.append(settle(tokens.mapInArrow(prefix_counts(level, known), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), bl.BATCH_BYTES))
        rows = tables[level].filter(F.col("n") > budget).collect()  # total / budget rows at most
        rows = sorted((r["key"] & (2**64 - 1), r["n"]) for r in rows)
        known.keys[level] = np.array([k for k, _ in rows], np.uint64)
        known.counts[level] = np.array([n for _, n in rows], np.int64)
    known.groups = np.zeros(1 << max(6, (8 * total // budget).bit_length()), np.int64)
    sums = np.zeros(len(known.groups), np.int64)
    for level, t in enumerate(tables):
        for r in t.mapInArrow(slot_sums(level, known), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
            sums[r["slot"]] += r["n"]
    group = held = 0
    for s, n in enumerate(sums):
        if held and held + n > budget:
            group, held = group + 1, 0
        known.groups[s], held = group, held + int(n)
    return known


def planes(a: np.ndarray) -> bytes:
    """32-bit numbers byte by byte: all lowest bytes, then the next; high zeros lie together."""
    return a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.uint64)


DEALT = "part int, w1 binary, w2 binary, w3 binary, w4 binary, counts binary"


def deal_suffixes(known: Prefixes):
    """Arrow function: blocks of token numbers to one row per group: its suffixes and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.uint64(0xFFFFFFFF)
        for tokens in token_numbers(batches):
            hi, lo, n = suffixes(tokens)
            group = known.groups[known.slots(hi, lo)]
            order = np.argsort(group, kind="stable")
            hi, lo, n, group = hi[order], lo[order], n[order], group[order]
            first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else []
            rows = []
            for i, j in zip(first, [*first[1:], len(group)]):
                h, k = hi[i:j], lo[i:j]
                w = (h >> np.uint64(32), h & low, k >> np.uint64(32), k & low)
                rows.append({"part": int(group[i]), "counts": bl.small(n[i:j])} | {f"w{x + 1}": planes(v) for x, v in enumerate(w)})
            yield pa.RecordBatch.from_pylist(rows, schema=_DEALT)

    return run


_DEALT = pa.schema([("part", pa.int32())] + [(f"w{k}", pa.binary()) for k in range(1, 5)] + [("counts", pa.binary())])
NODES = "depth int, w1 long, w2 long, w3 long, w4 long, a long, l1 long, l2 long, l3 long"


def subtree(hi: np.ndarray, lo: np.ndarray, n: np.ndarray, known: Prefixes, least: int) -> Iterator[dict[str, np.ndarray]]:
    """Nodes of two words and more with ``least`` occurrences, with the counts of their ancestors.

    ``hi``, ``lo`` are a group's sorted distinct suffixes, ``n`` their counts, the leaf totals.  A heavy
    prefix lies in several groups: it is no node here, and its count comes from ``known``.
    """
    low = np.uint64(0xFFFFFFFF)
    words = [hi >> np.uint64(32), hi & low, lo >> np.uint64(32), lo & low]
    heavy = known.heavy(hi, lo)
    totals, edge = [], np.zeros(len(hi), bool)
    edge[:1] = True
    for d, w in enumerate(words):
        edge[1:] |= w[1:] != w[:-1]
        first = np.flatnonzero(edge)
        total = np.repeat(np.add.reduceat(n, first), np.diff([*first, len(hi)]))
        if d < 3 and len(known.keys[d]):
            total = np.where(heavy[d] >= 0, known.counts[d][heavy[d]], total)
        totals.append(total)
        if d:
            own = first[(w[first] > 0) & (total[first] >= least)]
            if d < 3:
                own = own[heavy[d][own] < 0]
            zero = np.zeros(len(own), np.int64)
            yield {"depth": np.full(len(own), d + 1, np.int32), "a": total[own]} | {
                f"w{k + 1}": words[k][own].astype(np.int64) if k <= d else zero for k in range(4)
            } | {f"l{k + 1}": totals[k][own] if k < d else zero for k in range(3)}


def build_subtrees(known: Prefixes, least: int):
    """Arrow function: dealt suffixes to nodes, one group after the other."""
    names = [c.split()[0] for c in NODES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in bl.by_part(batches):
            w = [np.concatenate([unplanes(r[f"w{k}"]) for r in rows]) for k in range(1, 5)]
            n = np.concatenate([bl.unsmall(r["counts"]) for r in rows])
            hi, lo = w[0] << np.uint64(32) | w[1], w[2] << np.uint64(32) | w[3]
            del w, rows
            for nodes in subtree(*merged(hi, lo, n), known, least):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[c]) for c in names], names=names)

    return run


def heavy_nodes(known: Prefixes, least: int) -> list[tuple]:
    """The nodes that ``subtree`` leaves out."""
    one = dict(zip(known.keys[0].tolist(), known.counts[0].tolist()))
    pairs, rows = list(zip(known.keys[1].tolist(), known.counts[1].tolist())), []
    for key, n in pairs:
        x, y = key >> 32, key & 0xFFFFFFFF
        if y and n >= least:
            rows.append((2, x, y, 0, 0, n, one[x], 0, 0))
    for key, n in zip(known.keys[2].tolist(), known.counts[2].tolist()):
        pair, z = pairs[key >> 32], key & 0xFFFFFFFF
        if z and n >= least:
            rows.append((3, pair[0] >> 32, pair[0] & 0xFFFFFFFF, z, 0, n, one[pair[0] >> 32], pair[1], 0))
    return rows


def counted(docs: DataFrame, lang_col: str, text_col: str, least: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Settled tables of words (id, n, lang, word), of nodes, and of languages (lang, n); the number of all words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    blocks = settle(rows.mapInArrow(encode, BLOCKS), bl.BATCH_BYTES, "zstd")
    per = F.explode(F.arrays_zip("langs", "lang_words")).alias("x")
    langs = settle(blocks.select(per).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.lang_words").alias("n")))
    total = langs.agg(F.sum("n").alias("n")).first()["n"] or 0
    parts, n = max(1, -(-total // bl.KEYS_PER_PART)), bl.tasks(spark, total)
    asked = blocks.mapInArrow(ask_words(parts), ASKED).repartition(n, "part").sortWithinPartitions("part")
    numbered = settle(asked.mapInArrow(number_words(parts, least), NUMBERED), bl.BATCH_BYTES, "zstd")
    words = numbered.filter("id is not null").select("id", "n", "lang", "word")
    visited = bl.with_answers(blocks, [numbered.filter("id is null")], "numbers", total)
    tokens = settle(visited.mapInArrow(number_tokens, "tokens binary"), bl.BATCH_BYTES, "zstd")
    known = partitioned(tokens, words, total)
    groups = int(known.groups.max()) + 1
    dealt = tokens.mapInArrow(deal_suffixes(known), DEALT).repartition(max(groups, 1), "part").sortWithinPartitions("part")
    nodes = settle(dealt.mapInArrow(build_subtrees(known, least), NODES), bl.BATCH_BYTES)
    more = heavy_nodes(known, least)
    if more:
        nodes = nodes.unionByName(spark.createDataFrame(more, NODES))
    return words, nodes, langs, total


_KEY = ["w1", "w2", "w3", "w4"]


def scored(nodes: DataFrame, words: DataFrame, total: int, scale: int = SCALE) -> DataFrame:
    """Nodes with ``lang``, and ``l``, ``r``, ``score`` of their weakest cut (of equal ones the first).

    Rests with more than a ``HEAVY_SHARE``-th of all words, of which there are few, are looked up in a
    broadcast table; any other one has as few phrases as its count allows, so no key of the join is hot.
    """
    w = F.array("w1", "w2", "w3", "w4", *[F.lit(0).cast("long")] * 3)
    cut = lambda k: F.struct(
        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), *[w[k + i].alias(f"r{i + 1}") for i in range(3)]
    )
    cuts = nodes.select(*_KEY, "a", F.explode(F.filter(F.array(cut(1), cut(2), cut(3)), lambda c: c["r1"] > 0)).alias("cut"))
    cuts = settle(cuts.select(*_KEY, "a", "cut.*"))
    zero = F.lit(0).cast("long")
    rests = words.select(F.col("id").alias("r1"), zero.alias("r2"), zero.alias("r3"), F.col("n").alias("r"), "lang").unionByName(
        nodes.filter("depth < 4").select(
            F.col("w1").alias("r1"), F.col("w2").alias("r2"), F.col("w3").alias("r3"), F.col("a").alias("r"), F.lit(None).cast("string").alias("lang")
        )
    )
    key = ["r1", "r2", "r3"]
    often = F.broadcast(settle(rests.filter(F.col("r") > total // HEAVY_SHARE)))  # at most HEAVY_SHARE words, pairs, triples
    rare = rests.filter(F.col("r") <= total // HEAVY_SHARE)
    found = cuts.join(often, key).unionByName(cuts.join(often, key, "left_anti").join(rare, key))
    wide = lambda c: F.col(c).cast("decimal(28,0)")
    found = found.withColumn("whole", F.lit(scale).cast("decimal(10,0)") * F.col("a").cast("decimal(19,0)")).withColumn("parts", wide("l") + wide("r"))
    best = F.min(F.struct(F.expr("whole div parts").alias("score"), "k", "l", "r")).alias("best")
    return found.groupBy(*_KEY, "a").agg(best, F.max("lang").alias("lang")).select(*_KEY, "a", "lang", "best.l", "best.r", "best.score")


def absorbed(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Keys of phrases that lie in a longer one with ``percent`` of their occurrences or more."""
    zero = F.lit(0).cast("long")
    part = lambda i, n: F.struct(*[(F.col(f"w{i + k}") if k < n else zero).alias(f"w{k + 1}") for k in range(4)])
    of = {3: [part(1, 2), part(2, 2)], 4: [part(1, 2), part(2, 2), part(3, 2), part(1, 3), part(2, 3)]}
    inside = F.explode(F.when(F.col("depth") == 3, F.array(*of[3])).otherwise(F.array(*of[4]))).alias("part")
    longer = nodes.filter("depth > 2").select("a", inside).groupBy("part").agg(F.max("a").alias("longer")).select("part.*", "longer")
    wide = lambda c: F.col(c).cast("decimal(28,0)")
    return nodes.join(longer, _KEY).filter(100 * wide("longer") >= percent * wide("a")).select(*_KEY)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``best`` phrases of 2 to 4 words of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends, and these into words at
    blanks and tabs.  A phrase has ``a`` >= ``least`` occurrences within pieces; a cut into a first part
    (``l`` occurrences) and a rest (``r``) has the score ``floor(SCALE * a / (l + r))``, and the lowest
    counts.  Phrases that lie in a longer one with ``PERCENT`` of their occurrences go.  Ties of score
    and ``a`` go by the phrase's bytes.  Null texts are empty, null languages are ``und``; repeated
    rows count each time; a language without words or phrases has no rows, an empty table none; other columns are
    not read.  Words are equal if their 64-bit hashes are.
    """
    words, nodes, langs, total = counted(docs, lang_col, text_col, least)
    kept = scored(nodes, words, total).join(absorbed(nodes), _KEY, "left_anti")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    kept = settle(kept.withColumn("place", F.rank().over(first)).filter(F.col("place") <= best))
    named = kept.select(*_KEY, F.posexplode(F.array(*_KEY)).alias("at", "id")).filter("id > 0").join(words.select("id", "word"), "id")
    named = named.groupBy(*_KEY).agg(F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = kept.join(named, _KEY).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= best)
    return out.join(langs, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
