"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a seed (``SEED`` tokens in a row) are joined on
the executors against a broadcast block of the benchmark.  Each such pair is tiled: the
longest matches of unmarked tokens, found by running Karp-Rabin hashes of falling length,
are marked until none of ``SEED`` tokens is left.  The share of the item's tokens under
tiles, wherever in the document and in whatever order they lie, decides.

Tokens are runs of ASCII letters and digits and of characters beyond ASCII, in lower case
(A-Z).  Unicode punctuation and blanks and full-width ASCII marks end a token, and each
character of a script without spaces (Chinese, Japanese, Thai and others) is a token.  An
item of fewer than ``SEED`` tokens has all of them as its seed.  The
benchmark is a query set: its distinct texts are taken in blocks of about ``BLOCK_BYTES``, cut by
running bytes over hash buckets, one pass over the documents for each; so what is broadcast
stays bounded, however often an item repeats (a text longer than a block is one of its own).
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm import scan
from panelwatch.llm.steps import settle

SEED = 5
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20
BUCKETS = 1 << 14

_APART = np.ones(256, bool)
_APART[[c for c in range(128) if chr(c).isalnum()]] = False
_APART[128:] = False
_STEP = 0x9E3779B97F4A7C15

_WORD, _GAP, _SINGLE = 0, 1, 2
#: Code points of scripts that are written without spaces between words, by first and last.
_UNSPACED = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF),  # Thai, Lao, Burmese, Khmer, ...
    (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),  # Kana, Bopomofo, Han
    (0xA000, 0xA48F), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x323AF),
]


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Where the kind of the code points changes, and the kind from there on."""
    kind = np.zeros(0x110000, np.uint8)
    for first, last in _UNSPACED:
        kind[first : last + 1] = _SINGLE
    kind[[c for c in range(128, 0x20000) if unicodedata.category(chr(c))[0] in "PZ"]] = _GAP
    kind[[c for c in range(0xFF01, 0xFF5F) if not chr(c - 0xFEE0).isalnum()]] = _GAP
    edges = np.append(0, np.flatnonzero(np.diff(kind)) + 1)
    return edges, kind[edges]


_EDGES, _KINDS = _kinds()


def _wide(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, bytes and code point of all characters beyond ASCII; bytes that are not UTF-8 are left out."""
    at = np.flatnonzero(data >= 0xC2)
    lead = data[at].astype(np.int64)
    n = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point, ok = lead & (0xFF >> (n + 1)), at + n <= len(data)
    for k in (1, 2, 3):
        byte = data[np.minimum(at + k, len(data) - 1)].astype(np.int64)
        ok &= (n <= k) | (byte & 0xC0 == 0x80)
        point = np.where(n > k, point << 6 | byte & 0x3F, point)
    return at[ok], n[ok], point[ok]


def tokens(data: np.ndarray, offsets: np.ndarray, powers: scan.Powers) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts and the first token of each."""
    data = scan.lower(data)
    apart, edge = _APART[data], np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    at, n, point = _wide(data)
    kind = _KINDS[np.searchsorted(_EDGES, point, "right") - 1]
    for k in range(4):
        apart[at[(kind == _GAP) & (n > k)] + k] = True
    alone = kind == _SINGLE
    edge[at[alone]] = edge[(at + n)[alone]] = True
    starts, ends, firsts = scan.spans(apart, edge, offsets)
    return scan.word_hashes(data, starts, ends, powers), firsts


class KarpRabin:
    """Hashes of windows of any length over one token sequence."""

    def __init__(self, words: np.ndarray, powers: scan.Powers) -> None:
        self.n = len(words)
        up, self.down = powers.upto(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(words * up[:-1], out=self.sums[1:])

    def windows(self, s: int) -> list[int]:
        if s > self.n:
            return []
        return ((self.sums[s:] - self.sums[:-s]) * self.down[: self.n - s + 1]).tolist()


def tile(text: np.ndarray, item: np.ndarray, least: int, powers: scan.Powers) -> list[tuple[int, int, int]]:
    """Tiles (text position, item position, length), longest first; ties go to the earlier position."""
    text_hash, item_hash = KarpRabin(text, powers), KarpRabin(item, powers)
    t_words, p_words = text.tolist(), item.tolist()
    t_free, p_free = [True] * len(t_words), [True] * len(p_words)
    tiles: list[tuple[int, int, int]] = []

    def free_windows(free: list[bool], s: int) -> list[int]:
        run, at = 0, []
        for i, f in enumerate(free):
            run = run + 1 if f else 0
            if run >= s:
                at.append(i - s + 1)
        return at

    def scan_for(s: int) -> tuple[int, dict[int, list]]:
        """Matches of ``s`` tokens or more, by length; a match over 2 s ends the scan with its length."""
        where = defaultdict(list)
        hashes = item_hash.windows(s)
        for p in free_windows(p_free, s):
            where[hashes[p]].append(p)
        found: dict[int, list] = defaultdict(list)
        hashes = text_hash.windows(s) if where else []
        for t in free_windows(t_free, s) if where else []:
            for p in where.get(hashes[t], ()):
                k = 0
                while t + k < len(t_words) and p + k < len(p_words) and t_free[t + k] and p_free[p + k] and t_words[t + k] == p_words[p + k]:
                    k += 1
                if k > 2 * s:
                    return k, {}
                if k >= s:
                    found[k].append((t, p))
        return 0, found

    s = max(least, min(len(p_words), 20))
    while True:
        longer, found = scan_for(s)
        if longer:
            s = longer
            continue
        for k in sorted(found, reverse=True):
            for t, p in found[k]:
                if all(t_free[t : t + k]) and all(p_free[p : p + k]):
                    t_free[t : t + k] = p_free[p : p + k] = [False] * k
                    tiles.append((t, p, k))
        if found and any(True for _ in _left(scan_for, s)):
            continue
        if s == least:
            return tiles
        s = max(least, s // 2)


def _left(scan_for, s: int) -> Iterator[int]:
    """Whether the marks just made left matches of ``s`` tokens: parts of occluded ones."""
    longer, found = scan_for(s)
    if longer or found:
        yield s


def block_arrays(ids: list, texts: list[str], seed: int) -> tuple:
    """What is broadcast of a part of the benchmark: plain arrays of its tokens and, by length, sorted seeds.

    An item of fewer than ``seed`` tokens has one seed, all of it.
    """
    raw = [(t or "").encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)
    words, firsts = tokens(np.frombuffer(b"".join(raw), np.uint8), offsets, scan.Powers())
    sizes, seeds = np.diff(firsts), []
    for k in range(1, seed + 1):
        grams = scan.window_hashes(words, k)
        at = np.flatnonzero(scan.inside(firsts, k, len(grams)))
        owner = np.searchsorted(firsts, at, "right") - 1
        if k < seed:
            own = sizes[owner] == k
            at, owner = at[own], owner[own]
        if len(at):
            order = np.argsort(grams[at], kind="stable")
            seeds.append((k, grams[at][order], owner[order]))
    return ids, words, firsts, seeds


class Seeds:
    """The seeds of one length, on an executor, and the way from them to items."""

    def __init__(self, length: int, seeds: np.ndarray, owner: np.ndarray) -> None:
        self.length, self.seeds, self.owner = length, seeds, owner
        self.known = np.zeros(1 << 20, bool)
        self.known[(seeds >> np.uint64(44)).astype(np.int64)] = True

    def shared(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of each shared seed and the item that has it; a row for each item."""
        at = np.flatnonzero(self.known[(grams >> np.uint64(44)).astype(np.int64)])
        low, high = np.searchsorted(self.seeds, grams[at], "left"), np.searchsorted(self.seeds, grams[at], "right")
        n = high - low
        place = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.owner[place]


class Block:
    """Part of the benchmark, on an executor: its items' tokens and their seeds."""

    def __init__(self, ids: list, words: np.ndarray, firsts: np.ndarray, seeds: list[tuple]) -> None:
        self.ids = ids
        self.items = [words[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
        self.seeds = [Seeds(*s) for s in seeds]


_HIT = "rid long, pattern string, covered int, item_tokens int, tiles array<struct<doc_start: int, item_start: int, length: int>>"


def find_tiles(block, seed: int, coverage: float, least: int):
    """Arrow function over (rid, text): the items of ``least`` tokens or more that a text covers to at least ``coverage``."""
    tile_type = pa.list_(pa.struct([("doc_start", pa.int32()), ("item_start", pa.int32()), ("length", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, powers = Block(*block.value), scan.Powers()
        for batch in batches:
            data, offsets = scan.column(batch, "text")
            rid = batch.column(0)
            out: list[list] = [[], [], [], [], []]
            for i, j in scan.runs(offsets):
                words, firsts = tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], powers)
                for seeds in b.seeds:
                    k = seeds.length
                    grams = scan.window_hashes(words, k)
                    at, item = seeds.shared(grams) if len(grams) else (np.empty(0, np.int64),) * 2
                    doc = np.searchsorted(firsts, at, "right") - 1
                    ok = at + k <= firsts[doc + 1]
                    at, item, doc = at[ok], item[ok], doc[ok]
                    order = np.lexsort((at, item, doc))
                    at, item, doc = at[order], item[order], doc[order]
                    cuts = np.flatnonzero((np.diff(item) != 0) | (np.diff(doc) != 0)) + 1
                    for a, z in zip([0, *cuts], [*cuts, len(at)]) if len(at) else ():
                        pattern = b.items[item[a]]
                        places = np.unique(at[a:z]) if k == seed else at[a : a + 1]  # the first place of a short item holds all of it
                        stretches = 1 + int((np.diff(places) > 1).sum())
                        if len(pattern) < least or len(places) + stretches * (k - 1) < coverage * len(pattern):
                            continue  # no tile lies outside the stretches under shared seeds
                        cover = np.zeros(len(pattern) + 1, bool)
                        tiles = _tiles(words, places, pattern, k, powers, int(firsts[doc[a]]))
                        for _, p, n in tiles:
                            cover[p : p + n] = True
                        covered = int(cover.sum())
                        if covered >= coverage * len(pattern):
                            row = (rid[i + int(doc[a])].as_py(), b.ids[item[a]], covered, len(pattern), [{"doc_start": t, "item_start": p, "length": n} for t, p, n in tiles])
                            for c, v in zip(out, row):
                                c.append(v)
            if out[0]:
                columns = [pa.array(out[0], pa.int64()), pa.array(out[1]), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32()), pa.array(out[4], tile_type)]
                yield pa.RecordBatch.from_arrays(columns, names=["rid", "pattern", "covered", "item_tokens", "tiles"])

    return run


def _tiles(words: np.ndarray, at: np.ndarray, pattern: np.ndarray, seed: int, powers: scan.Powers, origin: int) -> list[tuple[int, int, int]]:
    """Tiles of one text, looking only at stretches under shared seeds: no tile lies elsewhere."""
    cuts = np.flatnonzero(np.diff(at) > 1) + 1
    parts, places = [], []
    for piece in np.split(at, cuts):
        a, z = int(piece[0]), int(piece[-1]) + seed
        parts += [words[a:z], np.zeros(1, np.uint64)]
        places += [np.arange(a, z + 1)]
    where = np.concatenate(places) - origin
    return [(int(where[t]), p, k) for t, p, k in tile(np.concatenate(parts), pattern, seed, powers)]


def _blocks(patterns: DataFrame) -> list[tuple[int, int]]:
    """Ranges of hash buckets of about ``BLOCK_BYTES`` of text each; one bucket of more is a range alone."""
    sizes = patterns.groupBy("bucket").agg(F.sum(F.octet_length("text")).alias("size"))
    out, first, held = [], 0, 0
    for r in sorted(sizes.collect()):  # BUCKETS rows at most
        if held and held + r["size"] > BLOCK_BYTES:
            out.append((first, r["bucket"]))
            first, held = r["bucket"], 0
        held += r["size"]
    return [*out, (first, BUCKETS)]


def _items(benchmark: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """(item_id, pattern): each item with the digest that stands for its text."""
    text = F.col(item_text)
    return benchmark.filter(text.isNotNull()).select(F.col(item_col).alias("item_id"), F.md5(text.cast("binary")).alias("pattern"))


def covered_texts(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", seed: int = SEED, coverage: float = COVERAGE, least: int = 1) -> DataFrame:
    """(rid, pattern, covered, item_tokens, tiles) of every document row and every distinct benchmark text it covers.

    ``rid`` is ``xxhash64`` of id and text, ``pattern`` the md5 of the benchmark text; ``tiles`` count in tokens of
    the text and of the item.  Null and empty texts, on either side, and items without a token match nothing; an
    item of fewer than ``seed`` tokens matches where a text has all of them in a row, unless it has fewer than
    ``least``: an item of one common word marks every document with it, which a caller may not
    want.  Repeated rows have equal hits (once for each row).  Empty tables give an empty table;
    other columns are not read.
    """
    spark = docs.sparkSession
    rid = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("rid")
    texts = docs.select(rid, F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter(F.length("text") > 0)
    patterns = benchmark.select(F.col(item_text).alias("text")).filter(F.length("text") > 0).distinct()
    patterns = settle(patterns.withColumn("bucket", F.pmod(F.xxhash64("text"), F.lit(BUCKETS)).cast("int")))
    found = None
    for first, past in _blocks(patterns):
        part = patterns.filter((F.col("bucket") >= first) & (F.col("bucket") < past)).select(F.md5(F.col("text").cast("binary")).alias("id"), "text")
        part = part.orderBy("id").collect()
        block = spark.sparkContext.broadcast(block_arrays([r["id"] for r in part], [r["text"] for r in part], seed))
        hits = texts.mapInArrow(find_tiles(block, seed, coverage, least), _HIT)
        found = hits if found is None else found.unionByName(hits)
    return found


def contaminations(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(rid, item_id, covered, item_tokens, tiles): ``covered_texts`` for each item, equal items each."""
    items = _items(benchmark, options.get("item_col", "item_id"), options.get("item_text", "text"))
    hits = covered_texts(docs, benchmark, **options)
    return hits.join(items, "pattern").select("rid", "item_id", "covered", "item_tokens", "tiles")


def marked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``contaminated``, and the best covered item: ``item_id``, ``coverage``, ``tiles``.

    Of equally covered items the smallest is named; without one these are null.  Columns
    of these names in ``docs`` are replaced, others kept.
    """
    item_col = options.get("item_col", "item_id")
    items = _items(benchmark, item_col, options.get("item_text", "text")).groupBy("pattern").agg(F.min("item_id").alias("item_id"))
    hits = settle(covered_texts(docs, benchmark, id_col=id_col, text_col=text_col, **options))
    hits = hits.join(items, "pattern").withColumn("coverage", F.col("covered") / F.col("item_tokens"))
    order = F.struct(-F.col("coverage"), F.col("item_id"))
    best = settle(hits.groupBy("rid").agg(F.min_by(F.struct("item_id", "coverage", "tiles"), order).alias("_best")))
    rid = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    own = docs.drop("contaminated", item_col, "coverage", "tiles").withColumn("rid", rid)
    out = own.join(best, "rid", "left").drop("rid")
    return out.select(
        *[c for c in out.columns if c != "_best"],
        F.col("_best").isNotNull().alias("contaminated"),
        F.col("_best.item_id").alias(item_col),
        F.col("_best.coverage").alias("coverage"),
        F.col("_best.tiles").alias("tiles"),
    )
