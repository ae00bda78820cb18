"""Removal of repeated byte strings with suffix arrays, across all documents.

A byte goes if a string of ``window`` bytes that covers it also starts anywhere else.

1. Every window has one anchor: the smallest-hashed ``ANCHOR``-byte gram in it.  Equal
   windows have equal anchors, so a stretch of windows that share an anchor occurrence
   (a passage, at most 2 * window bytes) is compared only with passages of the same
   anchor.  An anchor met once proves its windows unique.  In a text that repeats with a short
   period (rules of dashes, padding) equal passages follow each other: the first two of a run stand
   for it, and the windows of the others repeat without a comparison.
2. Equal passages are counted before anything else moves: all their windows repeat.
3. Unequal passages of one anchor go to a shard.  A shard sorts its suffixes by
   Larsson-Sadakane refinement and gets the common prefixes of neighbours by Kasai's
   lemma; a prefix of ``window`` bytes or more marks both.
4. An anchor with more than ``SHARD_PASSAGES`` unequal passages is cut into shards;
   sorted window digests of its shards are then merged by binary search.

Spans are unions of marked windows.  Anchors met very often are counted by Spark with
map-side sums, the others in numpy, one partition at a time; both give the same marks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm import scan
from panelwatch.llm.steps import deal, row_key, settle, slices, tasks

WINDOW = 200
ANCHOR = 40
SHARD_BYTES = 1 << 18
SHARD_PASSAGES = 1024
ROWS_PER_TASK = 250_000
#: Anchors with more occurrences would fill a task alone; Spark's partial sums count them.
OFTEN = ROWS_PER_TASK

_PLACE = np.uint64((1 << 31) - 1)  # positions: no text has more bytes
_MOST = 255  # windows in one place
_MARK, _PASSAGE, _WINDOWS = 0, 1, 2
_RUNS = "key long, content long, rid long, at long"
_FOUND = "kind int, rid long, at long, key long, sub int, shards int, single boolean"
_SHARDED = "kind int, rid long, at long, key long, bucket int, digests binary, rids binary, ats binary"


def place(start: np.ndarray, count: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """First window, number of windows (under 256) and row tag in one integer."""
    return (start.astype(np.int64) << 32) | (count.astype(np.int64) << 24) | tag


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    n = len(h) - w + 1
    if n <= 0:
        return h[:0]
    x = np.concatenate([h, np.full(-len(h) % w, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def passages(data: np.ndarray, offsets: np.ndarray, window: int, powers: scan.Powers) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, first window and past-last window of each passage."""
    roll = scan.Rolling(data, powers)
    grams = scan.mix(roll.grams(ANCHOR))
    order = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(order, window - ANCHOR + 1)
    n = len(least)
    if not n:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    inside = np.ones(n, bool)
    for edge in offsets[1:-1]:
        inside[max(0, edge - window + 1) : edge] = False
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    last = np.ones(n, bool)
    last[:-1] = new[1:] | ~inside[1:]
    first = np.flatnonzero(new & inside)
    past = np.flatnonzero(last & inside) + 1
    anchor = (least[first] & _PLACE).astype(np.int64)
    return grams[anchor], scan.mix(roll.of(first, past + window - 1)), first, past


def fold_runs(key: np.ndarray, content: np.ndarray, first: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which passages to compare, and the other windows: first window and number of windows of each place.

    From the third on, equal passages in a row are left out: each of their windows equals one of the second's.
    """
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1]) & (first[1:] == past[:-1]) & (np.diff(past) == np.diff(first))
    spare = same.copy()
    spare[1:] &= same[:-1]
    edge = np.diff(np.concatenate([[False], spare, [False]]).astype(np.int8))
    start, end = first[np.flatnonzero(edge == 1)], past[np.flatnonzero(edge == -1) - 1]
    pieces = -(-(end - start) // _MOST)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = np.repeat(start, pieces) + nth * _MOST
    return ~spare, at, np.minimum(np.repeat(end, pieces) - at, _MOST)


def anchor_runs(window: int):
    """Arrow function: rows (rid, tag, text) to their passages; places that repeat by themselves have no key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = scan.Powers()
        for b in batches:
            data, offsets = scan.column(b, "text")
            rid, tag = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for i, j in scan.runs(offsets):
                at = offsets[i : j + 1] - offsets[i]
                key, content, first, past = passages(data[offsets[i] : offsets[j]], at, window, powers)
                if not len(key):
                    continue
                keep, again, count = fold_runs(key, content, first, past)
                key, content, first, past = key[keep], content[keep], first[keep], past[keep]
                start = np.concatenate([first, again])
                doc = np.searchsorted(at, start, "right") - 1
                where = place(start - at[doc], np.concatenate([past - first, count]), tag[i:j][doc])
                none = pa.nulls(len(again), pa.int64())
                columns = [pa.concat_arrays([pa.array(c.view(np.int64)), none]) for c in (key, content)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(rid[i:j][doc]), pa.array(where)], names=["key", "content", "rid", "at"])

    return run


def _edges(*sorted_columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(sorted_columns[0]), bool)
    new[:1] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def compare_passages(shard_passages: int):
    """Arrow function over all passages of whole anchors: marks of equal ones, and those left to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got:
            return
        key, content, rid, at = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in got]) for i in range(4))
        o = np.lexsort((content, key))
        key, content, rid, at = key[o], content[o], rid[o], at[o]
        if not len(key):
            return
        new_key, new_content = _edges(key), _edges(key, content)
        group = np.cumsum(new_content) - 1
        copies = np.bincount(group)
        of_key = np.cumsum(new_key) - 1
        contents = np.bincount(of_key[new_content])[of_key]
        equal = copies[group] > 1
        left = new_content & (contents > 1)
        shards = -(-contents // shard_passages)
        n, m = int(equal.sum()), int(left.sum())
        none = pa.nulls(n, pa.int64())
        yield from slices(
            [
                pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, _MARK, np.int32)), pa.array(rid[equal]), pa.array(at[equal]), none, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_())],
                    names=_names(_FOUND),
                ),
                pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(m, _PASSAGE, np.int32)),
                        pa.array(rid[left]),
                        pa.array(at[left]),
                        pa.array(key[left]),
                        pa.array(np.mod(content[left], shards[left]).astype(np.int32)),
                        pa.array(shards[left].astype(np.int32)),
                        pa.array(copies[group][left] == 1),
                    ],
                    names=_names(_FOUND),
                ),
            ]
        )

    return run


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def compare_often(found: DataFrame, shard_passages: int) -> DataFrame:
    """What ``compare_passages`` gives, for anchors whose passages are too many for one task."""
    contents = found.groupBy("key", "content").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "at")).alias("one"))
    contents = settle(contents)
    keys = contents.groupBy("key").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1")
    marks = found.join(contents.filter("copies > 1").select("key", "content"), ["key", "content"])
    none = [F.lit(None).cast(t).alias(c) for c, t in (("key", "long"), ("sub", "int"), ("shards", "int"), ("single", "boolean"))]
    shards = F.ceil(F.col("contents") / shard_passages).cast("int")
    left = contents.join(keys, "key").select(
        F.lit(_PASSAGE).alias("kind"),
        "one.rid",
        "one.at",
        "key",
        F.pmod("content", shards).cast("int").alias("sub"),
        shards.alias("shards"),
        (F.col("copies") == 1).alias("single"),
    )
    return marks.select(F.lit(_MARK).alias("kind"), "rid", "at", *none).unionByName(left)


def suffix_array(data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, their ranks, and eight bytes from each position.

    ``data`` holds passages, each ended by 255; ``end`` is each position's end mark.
    Larsson-Sadakane: suffixes sorted by ``h`` bytes are refined by the ranks ``h``
    bytes on; only groups that still tie are sorted again.
    """
    n = len(data)
    here = np.arange(n)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.zeros(n, np.uint64)
    for j in range(8):
        eight = (eight << np.uint64(8)) | padded[j : j + n].astype(np.uint64)
    short = np.flatnonzero(end - here < 7)
    beyond = (8 * (7 - (end - here)[short])).astype(np.uint64)
    eight[short] = (eight[short] >> beyond) << beyond
    marks = np.flatnonzero(end == here)
    eight[marks] = np.uint64(255 << 56) | np.arange(len(marks), dtype=np.uint64)

    pos = np.argsort(eight)
    new = _edges(eight[pos])
    group = np.maximum.accumulate(np.where(new, here, 0))
    rank = np.empty(n, np.int64)
    rank[pos] = group
    h = 8
    while True:
        alone = new & np.append(new[1:], True)
        pos, group = pos[~alone], group[~alone]
        if not len(pos):
            break
        both = (group.astype(np.uint64) << np.uint64(32)) | rank[np.minimum(pos + h, end[pos])].astype(np.uint64)
        o = np.argsort(both)
        pos, group, both = pos[o], group[o], both[o]
        new = _edges(both)
        i = np.arange(len(pos))
        first = np.maximum.accumulate(np.where(_edges(group), i, 0))
        group = group + np.maximum.accumulate(np.where(new, i, 0)) - first
        rank[pos] = group
        h *= 2
    order = np.empty(n, np.int64)
    order[rank] = here
    return order, rank, eight


def common_prefixes(data: np.ndarray, end: np.ndarray, order: np.ndarray, eight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each suffix's predecessor in the order (-1: none) and their common prefix, by position.

    Kasai's lemma: if both are preceded by the same byte, the value is that of the
    position before, less one.  Only the other positions compare bytes.
    """
    n = len(data)
    here = np.arange(n)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    starts = np.zeros(n, bool)
    starts[0] = True
    starts[1:] = end[:-1] == here[:-1]
    has = before >= 0
    other = np.maximum(before, 0)
    follows = has & ~starts & ~starts[other]
    follows[follows] = data[here[follows] - 1] == data[other[follows] - 1]
    value = np.zeros(n, np.int64)
    todo = np.flatnonzero(has & ~follows)
    a, b = todo, before[todo]
    most = np.minimum(end[a] - a, end[b] - b)
    done = np.zeros(len(todo), np.int64)
    active = np.arange(len(todo))
    while len(active):
        i, j = a[active] + done[active], b[active] + done[active]
        x = eight[np.minimum(i, end[a[active]])] ^ eight[np.minimum(j, end[b[active]])]
        same = x == 0
        bytes_equal = np.argmax(x.astype(">u8").view(np.uint8).reshape(-1, 8) != 0, axis=1)
        done[active] += np.where(same, 8, bytes_equal)
        active = active[same & (done[active] < most[active])]
    value[todo] = np.minimum(done, most)
    base = np.maximum.accumulate(np.where(follows, 0, here))
    value = np.where(follows, value[base] - (here - base), value)
    return before, value


def repeated(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One shard: the passages' bytes with end marks, their starts, and which positions repeat."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    past = np.cumsum(sizes)
    data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    end = np.repeat(past - 1, sizes)
    order, _, eight = suffix_array(data, end)
    before, value = common_prefixes(data, end, order, eight)
    hit = np.flatnonzero(value >= window)
    again = np.zeros(len(data), bool)
    again[hit] = True
    again[before[hit]] = True
    return data, past - sizes, again


def shard_marks(window: int, shard_bytes: int):
    """Arrow function over passages with whole (key, sub) groups side by side."""
    names = _names(_SHARDED)

    def rows(kind, rid, at, key=None, bucket=None, digests=None, rids=None, ats=None):
        n = len(rid)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, kind, np.int32)),
                pa.array(rid, pa.int64()),
                pa.array(at, pa.int64()),
                pa.array(key, pa.int64()) if key else pa.nulls(n, pa.int64()),
                pa.array(bucket, pa.int32()) if bucket else pa.nulls(n, pa.int32()),
                *(pa.array(c, pa.binary()) if c else pa.nulls(n, pa.binary()) for c in (digests, rids, ats)),
            ],
            names=names,
        )

    def shard(got: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, sub, shards, single, rid, at, texts = (list(c) for c in zip(*got))
        data, starts, again = repeated(texts, window)
        rid, at, single = np.array(rid, np.int64), np.array(at, np.int64), np.array(single, bool)
        first, tag = at >> 32, at & 0xFFFFFF
        hit = np.flatnonzero(again)
        owner = np.searchsorted(starts, hit, "right") - 1
        hit, owner = hit[single[owner]], owner[single[owner]]
        if len(hit):
            new = np.ones(len(hit), bool)
            new[1:] = (np.diff(hit) != 1) | (np.diff(owner) != 0)
            f = np.flatnonzero(new)
            count = np.diff(np.append(f, len(hit)))
            who = owner[f]
            yield rows(_MARK, rid[who], place(first[who] + hit[f] - starts[who], count, tag[who]))
        split = [i for i, s in enumerate(shards) if s > 1]
        if split:
            yield from windows(data, starts, split, key, sub, shards, single, rid, first, tag, texts)

    def windows(data, starts, split, key, sub, shards, single, rid, first, tag, texts) -> Iterator[pa.RecordBatch]:
        """Sorted window digests of the parts of a cut anchor, by digest range."""
        digest = scan.mix(scan.Rolling(data, scan.Powers()).grams(window))
        parts: dict[tuple, list[int]] = {}
        for i in split:
            parts.setdefault((key[i], sub[i], shards[i]), []).append(i)
        for (k, _, n), members in parts.items():
            members = np.array(members)
            counts = np.array([len(texts[i]) - window + 1 for i in members])
            who = np.repeat(members, counts)
            where = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            d, one = np.unique(digest[starts[who] + where], return_index=True)
            who, where = who[one], where[one]
            at = np.where(single[who], place(first[who] + where, np.ones(len(who), np.int64), tag[who]), -1)
            bucket = (d >> np.uint64(40)).astype(np.int64) * n >> 24
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            pieces = list(zip(np.split(bucket, cuts), np.split(d, cuts), np.split(rid[who], cuts), np.split(at, cuts)))
            m = len(pieces)
            yield rows(
                _WINDOWS, [0] * m, [0] * m, [k] * m, [int(p[0][0]) for p in pieces],
                [p[1].tobytes() for p in pieces], [p[2].tobytes() for p in pieces], [p[3].tobytes() for p in pieces],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
                if size >= shard_bytes and row[:2] != last:
                    yield from shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[-1])
                last = row[:2]
        if held:
            yield from shard(held)

    return run


def merge_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function over digest ranges of cut anchors, equal (key, bucket) side by side.

    Each shard's sorted digests are searched in what the shards before have; both
    owners of an equal window are marked.
    """

    def out(marks: list[np.ndarray]) -> pa.RecordBatch:
        rid, at = (np.concatenate(c) for c in zip(*marks))
        own = at >= 0
        return pa.RecordBatch.from_arrays([pa.array(rid[own]), pa.array(at[own])], names=["rid", "at"])

    group, seen, marks = None, None, []
    for b in batches:
        for key, bucket, *parts in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
            d, rid, at = np.frombuffer(parts[0], np.uint64), *(np.frombuffer(p, np.int64) for p in parts[1:])
            if group != (key, bucket):
                if marks:
                    yield out(marks)
                group, seen, marks = (key, bucket), (d, rid, at), []
                continue
            i = np.searchsorted(seen[0], d)
            hit = seen[0][np.minimum(i, len(seen[0]) - 1)] == d
            if hit.any():
                marks += [(rid[hit], at[hit]), (seen[1][i[hit]], seen[2][i[hit]])]
            seen = tuple(np.insert(old, i[~hit], new[~hit]) for old, new in zip(seen, (d, rid, at)))
    if marks:
        yield out(marks)


def cut_passages(window: int):
    """Arrow function: a text and the passages wanted of it to one row per passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = scan.column(b, "text")
            wanted = b.column(b.schema.get_field_index("wanted"))
            flat, owner = wanted.flatten(), np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy()))
            fields = {f.name: flat.field(i) for i, f in enumerate(flat.type)}
            at = fields["at"].to_numpy(zero_copy_only=False)
            start = offsets[owner] + (at >> 32)
            size = ((at >> 24) & 0xFF) + window - 1
            raw = data.tobytes()
            texts = pa.array([raw[s : s + n] for s, n in zip(start.tolist(), size.tolist())], pa.binary())
            rid = b.column(b.schema.get_field_index("rid")).take(pa.array(owner))
            yield from slices(
                [pa.RecordBatch.from_arrays([fields["key"], fields["sub"], fields["shards"], fields["single"], rid, fields["at"], texts],
                                            names=["key", "sub", "shards", "single", "rid", "at", "passage"])], 5_000
            )

    return run


def join_spans(window: int):
    """Arrow function: the marks of a row to its spans [start, end), merged and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = b.column(b.schema.get_field_index("marks"))
            where = marks.offsets.to_numpy()
            flat = marks.flatten().to_numpy(zero_copy_only=False)
            base = where[0]
            spans = []
            for i in range(len(marks)):
                at = flat[where[i] - base : where[i + 1] - base]
                start = np.sort(at) >> 32
                end = start + ((np.sort(at) >> 24) & 0xFF) + window - 1
                end = np.maximum.accumulate(end)
                new = np.ones(len(start), bool)
                new[1:] = start[1:] > end[:-1]
                f = np.flatnonzero(new)
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(start[f], end[np.append(f[1:] - 1, len(end) - 1)])])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, kind)], names=["rid", "tag", "spans"])

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   shard_passages: int = SHARD_PASSAGES, often: int = OFTEN) -> DataFrame:
    """``docs`` with ``spans``: the byte ranges [start, end) to remove, in order, apart from each other.

    Null and empty texts, and texts shorter than ``window`` bytes, have no spans.  Rows
    that repeat with id and text count as occurrences of their own: each loses all bytes
    that some window covers.  Null ids are allowed.  An empty table gives an empty table.
    A column ``spans`` in ``docs`` is replaced; other columns are kept.
    """
    if not ANCHOR < window < 256 + ANCHOR:
        raise ValueError(f"window must lie between {ANCHOR} and {256 + ANCHOR}")
    named = docs.drop("spans")
    keyed = named.select(*row_key(id_col, text_col), F.col(text_col).alias("text")).filter(F.octet_length("text") >= window)
    runs = settle(keyed.mapInArrow(anchor_runs(window), _RUNS))
    found, alone = runs.filter("key IS NOT NULL"), runs.filter("key IS NULL").select("rid", "at")
    often_keys = settle(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > often).select("key"))
    few = found.join(often_keys, "key", "left_anti")
    few = few.repartition(tasks(runs, ROWS_PER_TASK), "key").mapInArrow(compare_passages(shard_passages), _FOUND)
    many = compare_often(found.join(often_keys, "key"), shard_passages)
    first = settle(few.unionByName(many))

    items = F.collect_set(F.struct("at", "key", "sub", "shards", "single")).alias("wanted")
    left = first.filter(F.col("kind") == _PASSAGE)
    wanted = left.withColumn("tag", F.col("at").bitwiseAND(F.lit(0xFFFFFF))).groupBy("rid", "tag").agg(items)
    cut = keyed.join(wanted, ["rid", "tag"]).select("rid", "text", "wanted").mapInArrow(
        cut_passages(window), "key long, sub int, shards int, single boolean, rid long, at long, passage binary"
    )
    n = tasks(left, 4 * SHARD_PASSAGES)
    sharded = settle(deal(cut, n, "key", "sub").mapInArrow(shard_marks(window, SHARD_BYTES), _SHARDED))

    merged = sharded.filter(F.col("kind") == _WINDOWS).select("key", "bucket", "digests", "rids", "ats")
    merged = deal(merged, n, "key", "bucket").mapInArrow(merge_shards, "rid long, at long")
    marks = first.filter(F.col("kind") == _MARK).select("rid", "at").unionByName(alone)
    marks = marks.unionByName(sharded.filter(F.col("kind") == _MARK).select("rid", "at")).unionByName(merged)
    by_row = marks.withColumn("tag", F.col("at").bitwiseAND(F.lit(0xFFFFFF))).groupBy("rid", "tag").agg(F.collect_set("at").alias("marks"))
    spans = by_row.mapInArrow(join_spans(window), "rid long, tag long, spans array<struct<start: long, end: long>>")
    spans = settle(spans.select(F.col("rid").alias("_rid"), F.col("tag").alias("_tag"), "spans"))

    rid, tag = row_key(id_col, text_col)
    out = named.withColumns({"_rid": rid, "_tag": tag}).join(spans, ["_rid", "_tag"], "left").drop("_rid", "_tag")
    empty = F.array().cast("array<struct<start: long, end: long>>")
    return out.withColumn("spans", F.coalesce("spans", empty))


def kept_bytes(text: str = "text", spans: str = "spans"):
    """The bytes of a text outside its spans, end to end, as a binary expression."""
    raw = f"cast(coalesce(`{text}`, '') as binary)"
    return F.expr(
        f"""aggregate(`{spans}`, struct(cast('' as binary) as kept, 0L as at),
            (a, s) -> struct(concat(a.kept, substring({raw}, cast(a.at + 1 as int), cast(s.start - a.at as int))) as kept, s.end as at),
            a -> concat(a.kept, substring({raw}, cast(a.at + 1 as int))))"""
    )
