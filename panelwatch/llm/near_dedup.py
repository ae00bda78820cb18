"""Near-duplicate groups by an inverted join on MinHash signature coordinates.

1. Each text becomes its set of 5-word shingles and a signature of ``COORDINATES``
   minima.  Texts with equal sets form one class and go on as one.
2. A class posts under its coordinate-value pairs.  Two classes that agree in at least
   ``MATCHES`` coordinates must share one of each other's ``COORDINATES - MATCHES + 1``
   rarest pairs (prefix), so only these are posted, and pairs met once are skipped.
3. In each posting list the most central class is compared with all others: links are
   linear in the postings.  Agreements are counted on whole signatures; a pair with
   enough of them is confirmed on the full sets.
4. Lists that still hold classes of different components are compared in full, in
   blocks, each pair in the first list that both share; a task gives back no more links
   than it has members.

``MATCHES`` follow from the percentage (``matches_at``): a pair just at it misses them with
a chance of at most ``MISS``.  At 0.85 these are 42 of 64 coordinates (1 in 33,000; 1 in
4 * 10^7 at 0.9), at 0.80 they are 37 (1 in 71,000).
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm import scan
from panelwatch.llm.components import components
from panelwatch.llm.steps import deal, settle, slices, tasks

COORDINATES = 64
PERCENT = 85
#: Greatest chance that a pair just at the percentage agrees in too few coordinates.
MISS = 1 / 30_000
#: Members of a posting list that one task compares with as many others.
BLOCK = 512
PAIRS_PER_LEADER_TASK = 256
ROWS_PER_TASK = 50_000

_RNG = np.random.default_rng(7)
_FLIP = _RNG.integers(0, 2**64, COORDINATES, dtype=np.uint64)
_SCALE = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def matches_at(percent: int) -> int:
    """The most agreements that a pair at ``percent`` misses with a chance of at most ``MISS``."""
    p, missed = percent / 100, 0.0
    for k in range(COORDINATES):
        missed += comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if missed > MISS:
            return max(1, k)
    return COORDINATES


def _sets(b: pa.RecordBatch, powers: scan.Powers) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, shingle sets end to end, and their offsets."""
    data, offsets = scan.column(b, "text")
    for i, j in scan.runs(offsets):
        part, at = scan.lower(data[offsets[i] : offsets[j]]), offsets[i : j + 1] - offsets[i]
        starts, ends, firsts = scan.word_spans(part, at)
        sets, edges = scan.shingle_sets(scan.word_hashes(part, starts, ends, powers), firsts)
        yield i, j, sets, edges


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def digests(sets: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, whatever its order."""
    return tuple(scan.mix(_sums(scan.mix(sets ^ np.uint64(s)), edges)).view(np.int64) for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (rid, id, text) to set size, set digest and signature (null without words)."""
    powers = scan.Powers()
    for b in batches:
        for i, j, sets, edges in _sets(b, powers):
            n = np.diff(edges)
            some = np.flatnonzero(n)
            sig = np.zeros((j - i, COORDINATES), np.uint32)
            if len(some):
                for c in range(COORDINATES):
                    sig[some, c] = np.minimum.reduceat((sets ^ _FLIP[c]) * _SCALE[c], edges[some]) >> np.uint64(32)
            one, two = digests(sets, edges)
            packed = pa.array([s.tobytes() if k else None for s, k in zip(sig, n)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(n), pa.array(one), pa.array(two), packed],
                names=["rid", "id", "n", "node", "check", "sig"],
            )


def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (node, sig) to one row per coordinate-value pair."""
    coordinate = np.arange(COORDINATES, dtype=np.int64) << 32
    for b in batches:
        sig = _matrix(b.column(1))
        node = np.repeat(b.column(0).to_numpy(zero_copy_only=False), COORDINATES)
        pair = (coordinate[None, :] | sig.astype(np.int64)).ravel()
        yield from slices([pa.RecordBatch.from_arrays([pa.array(node), pa.array(pair)], names=["node", "pair"])])


def _matrix(sigs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def similar_size(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n, m) >= percent * np.maximum(n, m)


def enough_matches(matches: int, percent: int):
    """Arrow function over pairs (a, b, sig_a, sig_b, n_a, n_b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ok = (_matrix(b.column(2)) == _matrix(b.column(3))).sum(axis=1) >= matches
                ok &= similar_size(b.column(4).to_numpy(), b.column(5).to_numpy(), percent)
                yield b.select([0, 1]).filter(pa.array(ok))

    return run


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (node, text) to (node, set), where the text is the node's."""
    powers = scan.Powers()
    for b in batches:
        node = b.column(0).to_numpy(zero_copy_only=False)
        for i, j, sets, edges in _sets(b, powers):
            own = np.flatnonzero(digests(sets, edges)[0] == node[i:j])
            packed = pa.array([sets[edges[k] : edges[k + 1]].tobytes() for k in own], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(node[i:j][own]), packed], names=["node", "shingles"])


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirm_pairs(percent: int):
    """Arrow function over (a, part, b, shingles), sorted so that a's own row (b null) comes first in its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = own = None
        for batch in batches:
            a, b = [], []
            for x, y, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                s = np.frombuffer(raw, np.uint64)
                if y is None:
                    leader, own = x, s
                elif leader == x and linked(own, s, percent):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


class _List:
    """Members of one posting list, or of two blocks of it."""

    def __init__(self, rows: list[dict]) -> None:
        self.node = np.array([r["node"] for r in rows])
        self.component = np.array([r["component"] for r in rows])
        self.n = np.array([r["n"] for r in rows])
        self.side = np.array([r["side"] for r in rows])
        self.leader = np.array([r["leader"] for r in rows])
        self.prefix = np.array([r["prefix"] for r in rows], np.int64).view(np.uint64)
        self.sig = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint32).reshape(-1, COORDINATES)
        self.coordinate = rows[0]["pair"] >> 32

    def candidates(self, matches: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each member with those after it that it must be compared with here."""
        i, n = np.arange(len(self.node)), len(self.node)
        earlier = np.uint64((1 << int(self.coordinate)) - 1)
        two_blocks = self.side.min() != self.side.max()
        bits = np.uint64(1) << np.arange(COORDINATES, dtype=np.uint64)
        for k in range(n):
            if self.leader[k]:
                continue
            ok = (i > k) & (self.component != self.component[k]) & ~self.leader
            ok &= similar_size(self.n, self.n[k], percent)
            if two_blocks:
                ok &= self.side != self.side[k]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            same = self.sig[at] == self.sig[k]
            good = same.sum(axis=1) >= matches
            at, same = at[good], same[good]
            if len(at):
                shared = (same * bits).sum(axis=1, dtype=np.uint64) & self.prefix[at] & self.prefix[k]
                at = at[(shared & earlier) == 0]
            if len(at):
                yield k, at


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (pair, i, j) at a time; they lie side by side."""
    held: list[dict] = []
    for b in batches:
        for r in b.to_pylist():
            if held and (r["pair"], r["i"], r["j"]) != (held[0]["pair"], held[0]["i"], held[0]["j"]):
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def who_compares(matches: int, percent: int):
    """Arrow function: the members of each list that have someone to be compared with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _lists(batches):
            need = np.zeros(len(rows), bool)
            for k, at in _List(rows).candidates(matches, percent):
                need[k] = True
                need[at] = True
            some = [rows[k] for k in np.flatnonzero(need)]
            if some:
                yield pa.RecordBatch.from_pylist(some, schema=batch_schema())

    return run


def batch_schema() -> pa.Schema:
    return pa.schema(
        [("pair", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int32()), ("node", pa.int64()), ("component", pa.int64()),
         ("n", pa.int64()), ("leader", pa.bool_()), ("prefix", pa.int64()), ("sig", pa.binary())]
    )


_LISTED = "pair long, i int, j int, side int, node long, component long, n long, leader boolean, prefix long, sig binary"


def compare_lists(matches: int, percent: int):
    """Arrow function: links between members of one list, a spanning forest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _lists(batches):
            members = _List(rows)
            sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
            root = np.unique(members.component, return_inverse=True)[1]
            a, b = [], []
            for k, at in members.candidates(matches, percent):
                for m in at:
                    if root[m] != root[k] and linked(sets[k], sets[m], percent):
                        root[root == root[m]] = root[k]
                        a.append(int(members.node[k]))
                        b.append(int(members.node[m]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def sets_of(texts: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) for the wanted nodes, from one document of each."""
    wanted = classes.join(nodes, "node", "left_semi").select("rid", "node")
    sets = settle(texts.join(wanted, "rid").select("node", "text").mapInArrow(full_sets, "node long, shingles binary"))
    return sets.groupBy("node").agg(F.first("shingles").alias("shingles")) if sets.count() > wanted.count() else sets


def star_links(lists: DataFrame, classes: DataFrame, texts: DataFrame, matches: int, percent: int) -> DataFrame:
    """Links between each list's most central class and its other members."""
    pairs = lists.filter("node != leader").groupBy(F.col("leader").alias("a"), F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("met"))
    side = lambda x: classes.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n").alias(f"n_{x}"))
    near = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sig_a", "sig_b", "n_a", "n_b")
    near = settle(near.mapInArrow(enough_matches(matches, percent), "a long, b long"))
    nodes = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    sets = sets_of(texts, classes, nodes)
    parts = near.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_LEADER_TASK).cast("int").alias("parts"))
    near = near.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts").cast("int"))
    members = near.join(sets.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "shingles")
    own = near.select("a", "part").distinct().join(sets.withColumnRenamed("node", "a"), "a")
    own = own.select("a", "part", F.lit(None).cast("long").alias("b"), "shingles")
    n = tasks(near, 2000)
    both = members.unionByName(own).repartition(n, "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return both.mapInArrow(confirm_pairs(percent), "a long, b long")


def rest_links(lists: DataFrame, found: DataFrame, classes: DataFrame, texts: DataFrame, matches: int, percent: int) -> DataFrame:
    """Links that the stars left: between classes of different components in one list."""
    named = lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = named.groupBy("pair").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("members"))
    mixed = mixed.filter("x != y and members > 2").select("pair", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    named = named.join(mixed, "pair").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = named.select("*", other).select(
        "pair",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        F.col("block").alias("side"),
        "node",
        "component",
        (F.col("node") == F.col("leader")).alias("leader"),
        "prefix",
    )
    spread = spread.join(classes.select("node", "n", "sig"), "node").select(*[c.split()[0] for c in _LISTED.split(", ")])
    n = tasks(lists, ROWS_PER_TASK)
    need = settle(deal(spread, n, "pair", "i", "j").mapInArrow(who_compares(matches, percent), _LISTED))
    sets = sets_of(texts, classes, need.select("node").distinct())
    ready = deal(need.join(sets, "node").select(*need.columns, "shingles"), tasks(need, 2000), "pair", "i", "j")
    return ready.mapInArrow(compare_lists(matches, percent), "a long, b long")


def posting_lists(classes: DataFrame, matches: int) -> DataFrame:
    """(pair, node, prefix, leader) of all posting lists with two members or more.

    ``prefix`` has a bit for each coordinate under which the class is posted.
    """
    posted = classes.select("node", "sig").mapInArrow(post, "node long, pair long")
    often = posted.groupBy("pair").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    shared = posted.join(often, "pair").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("met", "pair"))).alias("rare"), F.sum("met").alias("central")
    )
    rest = F.greatest(F.lit(0), F.size("rare") - F.lit(matches - 1))
    posts = shared.select("node", "central", F.slice("rare", F.lit(1), rest).alias("rare")).filter("size(rare) > 0")
    bit = lambda x, r: x.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(r["pair"], 32).cast("int")))
    posts = posts.withColumn("prefix", F.aggregate("rare", F.lit(0).cast("long"), bit))
    posts = settle(posts.select("node", "central", "prefix", F.explode("rare.pair").alias("pair")))
    leaders = posts.groupBy("pair").agg(F.max(F.struct("central", "node"))["node"].alias("leader"), F.count(F.lit(1)).alias("members"))
    return settle(posts.join(leaders.filter("members > 1"), "pair").select("pair", "node", "prefix", "leader"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, matches: int | None = None) -> DataFrame:
    """One row per document row: rid, the id, n_shingles, component_id (smallest id of the group), kept, stays.

    ``rid`` is ``xxhash64`` of id and text, to join back to the rows.  Null and empty texts
    and texts without words have no shingles and stay alone.  Rows that repeat share their
    class; a null id never names a group that has another id, and a group of null ids only
    has a null component and is kept.  ``stays`` marks one row of each group also where ids
    repeat or are null (all rows of its ``rid``, if whole rows repeat).  An empty table gives an empty table; columns other
    than the two named are not read.  Without ``matches`` these follow from ``percent``.
    """
    matches = matches_at(percent) if matches is None else matches
    rid = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("rid")
    texts = docs.select(rid, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = settle(texts.mapInArrow(signatures, "rid long, id long, n long, node long, check long, sig binary"))
    some = signed.filter("n > 0")
    smallest = F.min(F.struct(F.col("id").isNull(), "id", "rid"))
    names = some.groupBy("node", "check", "n").agg(smallest.alias("least")).select("node", "check", "n", "least", "least.rid")
    sigs = some.select("rid", "node", "sig").dropDuplicates(["rid", "node"]) if some.count() != some.select("rid").distinct().count() else some.select("rid", "node", "sig")
    classes = settle(names.join(sigs, ["rid", "node"]))

    lists = posting_lists(classes, matches)
    stars = settle(star_links(lists, classes, texts.select("rid", "text"), matches, percent))
    found = settle(components(stars))
    rest = settle(rest_links(lists, found, classes, texts.select("rid", "text"), matches, percent))
    if not rest.isEmpty():
        found = settle(components(stars.unionByName(rest)))

    groups = classes.select("node", "check", "least").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = settle(groups)
    least = groups.groupBy("component").agg(F.min("least").alias("one"))
    groups = groups.join(least, "component").select("node", "check", F.col("one.id").alias("component_id"), F.col("one.rid").alias("stay"))
    out = signed.select("rid", "id", "n", "node", "check").join(groups, ["node", "check"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        "rid",
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
        F.coalesce(F.col("rid") == F.col("stay"), F.lit(True)).alias("stays"),
    )
