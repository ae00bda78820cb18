"""Isolation forest on Spark (Liu, Ting & Zhou 2008) with tree Shapley values.

Training draws a sample whose size depends on the model alone, so it costs one
filtered pass whatever the table's size; each tree grows in its own group.  Scoring and attribution run where the rows are, against a broadcast
forest of at most ``trees * (2 * sample - 1)`` nodes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch import schemas as S
from panelwatch import session
from panelwatch.operators.series import _join_same
from panelwatch.session import settle

SMALL_TASK, LARGE_TASK = 2_000, 200_000  # rows per attribution task: worth a start; enough
CHUNK = 2_000  # rows that a walk of a tree takes along
NODES = "tree_id int, node_id int, feature int, split double, left int, right int, n int, depth int"


def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows: the depth a leaf still hides."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    long = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    nodes: DataFrame  # one row per node, columns NODES
    features: list[str]
    sample: int  # rows per tree actually used


# -- sampling -----------------------------------------------------------------


def _waiting(ids: Sequence[str], weight: Column, *salt: Column) -> Column:
    """-ln(u)/w with u a hash of the row's identity: the smallest k are a weighted sample."""
    h = F.substring(F.md5(F.concat_ws("|", *salt, *[F.col(c) for c in ids]).cast("binary")), 1, 13)
    u = (F.conv(h, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
    return F.try_divide(-F.ln(u), weight)


def _draw(*of) -> float:
    """The number in (0, 1) that a text stands for, as ``_waiting`` hashes rows."""
    return (int(hashlib.md5("|".join(map(str, of)).encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def _wait_limit(df: DataFrame, weight: str | None, n: int, sample: int) -> float | None:
    """A waiting time below which every tree is certain to find ``sample`` rows.

    The expected number of rows below it is eight standard deviations too many.
    None stands for no limit, where the table is hardly larger than the sample.
    """
    enough = sample + 8 * math.sqrt(sample) + 16
    if n <= enough:
        return None
    if weight is None:
        return -math.log1p(-enough / n)
    base = enough / df.agg(F.sum(weight)).first()[0]
    limits = [base * 4.0**k for k in range(32)]
    w = F.col(weight)
    below = df.agg(*[F.sum(F.lit(1.0) - F.exp(-w * t)).alias(f"t{i}") for i, t in enumerate(limits)]).first()
    return next((t for t, rows in zip(limits, below) if rows >= enough), None)


def tree_samples(
    df: DataFrame,
    features: Sequence[str],
    ids: Sequence[str],
    trees: int,
    sample: int,
    seed: int,
    weight: str | None = None,
) -> tuple[DataFrame, int]:
    """(tree_id, features) with ``sample`` rows per tree, drawn without replacement.

    A row waits an exponential time for each tree; a tree takes the rows that
    wait least.  Laid end to end, a row's waits up to the limit are one Poisson
    process, so its first arrival, a single hash, tells for most rows that no
    tree wants them.  Waits hash the row's identity: a recomputed task draws the
    same, and the shuffle moves about trees * sample rows whatever the table.
    """
    df = df.select(*ids, *features, *([weight] if weight else []))
    w = F.lit(1.0)
    if weight:
        w = F.col(weight)
        df = df.filter(w > 0)
    n = df.count()
    if n == 0:
        raise ValueError("no rows with positive weight to fit on")
    limit = _wait_limit(df, weight, n, sample)
    rows = df.withColumn("__first", _waiting(ids, w, F.lit(seed)))
    if limit is None:
        rows = rows.withColumn("__from", F.lit(0))
        wait = F.col("__first")
    else:
        rows = rows.filter(F.col("__first") < limit * trees)
        at = F.floor(F.col("__first") / F.lit(limit)).cast("int")
        rows = rows.withColumn("__from", F.least(at, F.lit(trees - 1)))
        wait = F.col("__first") - F.col("__from") * F.lit(limit)
    drawn = rows.withColumn("tree_id", F.explode(F.sequence("__from", F.lit(trees - 1))))
    later = _waiting(ids, w, F.lit(seed), F.col("tree_id"))
    drawn = drawn.withColumn("__wait", F.when(F.col("tree_id") == F.col("__from"), wait).otherwise(later))
    if limit is not None:
        drawn = drawn.filter(F.col("__wait") < limit)
    first = W.partitionBy("tree_id").orderBy("__wait", *ids)
    drawn = drawn.withColumn("__rn", F.row_number().over(first)).filter(F.col("__rn") <= sample)
    return drawn.select("tree_id", "__rn", *features), min(n, sample)


def _limits(df: DataFrame, by: Sequence[str], weight: str | None, sample: int) -> DataFrame:
    """Per ``by`` its rows ``__n`` and ``_wait_limit`` as ``__limit`` (null: none), in grouped sums."""
    enough = sample + 8 * math.sqrt(sample) + 16
    n = F.count(F.lit(1)).alias("__n")
    if weight is None:
        sizes = df.groupBy(*by).agg(n)
        return settle(sizes.withColumn("__limit", F.when(F.col("__n") > enough, -F.log1p(-F.lit(enough) / F.col("__n")))))
    totals = settle(df.groupBy(*by).agg(n, (F.lit(enough) / F.sum(weight)).alias("__base")))
    w, steps = F.col(weight), [4.0**k for k in range(32)]
    below = [F.sum(F.lit(1.0) - F.exp(-w * F.col("__base") * t)) for t in steps]
    met = _join_same(df.select(*by, weight), totals, by).groupBy(*by).agg(
        F.first("__n").alias("__n"), F.first("__base").alias("__base"), F.array(*below).alias("__below")
    )
    first = F.array_position(F.transform("__below", lambda x: x >= enough), F.lit(True))
    step = F.when(first > 0, F.col("__base") * F.pow(F.lit(4.0), first - 1))
    return settle(met.select(*by, "__n", F.when(F.col("__n") > enough, step).alias("__limit")))


def tree_samples_by(
    df: DataFrame, features: Sequence[str], by: Sequence[str], ids: Sequence[str], trees: int, sample: int, seed: int, weight: str | None = None
) -> DataFrame:
    """(by, tree_id, __n, __rn, features): ``tree_samples`` of each group of rows with equal ``by``.

    A row hashes as it does for one forest; only the limit is its group's.
    """
    extra = [c for c in by if c not in ids]
    df = df.select(*ids, *extra, *[f for f in features if f not in (*ids, *extra)], *([weight] if weight else []))
    w = F.lit(1.0)
    if weight:
        w = F.col(weight)
        df = df.filter(w > 0)
    rows = _join_same(df.withColumn("__first", _waiting(ids, w, F.lit(seed))), _limits(df, by, weight, sample), by)
    limit, last = F.col("__limit"), F.lit(trees - 1)
    rows = rows.filter(limit.isNull() | (F.col("__first") < limit * trees))
    rows = rows.withColumn("__from", F.when(limit.isNull(), 0).otherwise(F.least(F.floor(F.col("__first") / limit).cast("int"), last)))
    wait = F.when(limit.isNull(), F.col("__first")).otherwise(F.col("__first") - F.col("__from") * limit)
    drawn = rows.withColumn("tree_id", F.explode(F.sequence("__from", last)))
    later = _waiting(ids, w, F.lit(seed), F.col("tree_id"))
    drawn = drawn.withColumn("__wait", F.when(F.col("tree_id") == F.col("__from"), wait).otherwise(later))
    drawn = drawn.filter(limit.isNull() | (F.col("__wait") < limit))
    first = W.partitionBy(*by, "tree_id").orderBy("__wait", *ids)
    drawn = drawn.withColumn("__rn", F.row_number().over(first)).filter(F.col("__rn") <= sample)
    return drawn.select(*by, "tree_id", "__n", "__rn", *[f for f in features if f not in by])


# -- growing ------------------------------------------------------------------


def _grow(x: np.ndarray, seed: int | str, tree: int, limit: int) -> list[tuple]:
    """Random splits until rows are alone, equal, or the depth limit is reached.

    Draws hash the node's place (the root is 1, the children of k are 2k and 2k + 1), so
    any engine with md5 grows the same tree.
    """
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, 1, None, None)]
    while stack:
        rows, depth, place, parent, side = stack.pop()
        me = len(nodes)
        nodes.append([me, -1, 0.0, -1, -1, len(rows), depth])
        if parent is not None:
            nodes[parent][side] = me
        if depth >= limit or len(rows) < 2:
            continue
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if not len(usable):
            continue
        f = int(usable[int(_draw(seed, tree, place, "feature") * len(usable))])
        split = float(lo[f] + _draw(seed, tree, place, "split") * (hi[f] - lo[f]))
        if split >= hi[f]:  # the draw hit the maximum exactly
            split = float(lo[f])
        go_left = x[rows, f] <= split
        nodes[me][1:3] = [f, split]
        stack.append((rows[~go_left], depth + 1, 2 * place + 1, me, 4))
        stack.append((rows[go_left], depth + 1, 2 * place, me, 3))
    return [tuple(v) for v in nodes]


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    ids: Sequence[str] = ("series_key", "date"),
    trees: int = S.FOREST_TREES,
    sample: int = S.FOREST_SAMPLE,
    seed: int = S.FOREST_SEED,
    weight: str | None = None,
) -> Forest:
    features = list(features)
    drawn, used = tree_samples(df, features, ids, trees, sample, seed, weight)
    limit = max(1, math.ceil(math.log2(max(used, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree_id"].iloc[0])
        x = pdf.sort_values("__rn")[features].to_numpy(dtype=float)
        rows = _grow(x, seed, tree, limit)
        out = pd.DataFrame(rows, columns=["node_id", "feature", "split", "left", "right", "n", "depth"])
        out.insert(0, "tree_id", tree)
        return out

    drawn = drawn.repartition(min(trees, df.sparkSession.sparkContext.defaultParallelism), "tree_id")
    return Forest(drawn.groupBy("tree_id").applyInPandas(grow, NODES), features, used)


# -- the forest in a task -----------------------------------------------------


class _Trees:
    """The forest as flat arrays; child links are absolute, leaves point to themselves."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree_id", "node_id"], ignore_index=True)
        sizes = nodes.groupby("tree_id").size()
        offset = nodes["tree_id"].map(sizes.cumsum() - sizes).to_numpy()
        me = np.arange(len(nodes))
        leaf = (nodes["feature"] < 0).to_numpy()
        self.leaf = leaf
        self.feature = np.where(leaf, 0, nodes["feature"]).astype(np.int32)
        self.split = nodes["split"].to_numpy()
        self.left = np.where(leaf, me, nodes["left"] + offset)
        self.right = np.where(leaf, me, nodes["right"] + offset)
        self.n = nodes["n"].to_numpy(dtype=float)
        self.length = np.where(leaf, nodes["depth"] + average_path(self.n), 0.0)
        self.roots = np.flatnonzero(nodes["node_id"] == 0)
        self.depth = int(nodes["depth"].max())

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.split[at], self.left[at], self.right[at])
            total += self.length[at]
        return total / len(self.roots)

    def shapley(self, x: np.ndarray) -> np.ndarray:
        """Path-dependent Shapley values of the mean path length (Lundberg et al. 2020).

        A leaf's game, over the features of its path, gives feature j its value times
        ``(h_j - s_j)`` times the integral over y in (0, 1) of the product of ``s_i (1 - y) + h_i y``
        over the other features: ``h`` tells whether the row meets the feature's splits, ``s`` is their
        share of the rows.  The integrand is a polynomial, so Gauss-Legendre nodes integrate it
        exactly.  One walk of a tree carries the products down and their sums over leaves up, so the
        cost is rows x nodes x half the depth, and the memory rows x half the depth for each level.
        """
        most = min(self.depth, x.shape[1])
        at, weight = np.polynomial.legendre.leggauss(max(1, (most + 1) // 2))
        self.y, self.weight = (at + 1) / 2, weight / 2
        phi = np.zeros((x.shape[1], len(x)))
        for i in range(0, len(x), CHUNK):
            columns = np.ascontiguousarray(x[i : i + CHUNK].T)
            for root in self.roots:
                product = np.ones((len(self.y), columns.shape[1]))
                self._walk(root, columns, product, {}, phi[:, i : i + CHUNK])
        return phi.T / len(self.roots)

    def _walk(self, node: int, columns: np.ndarray, product: np.ndarray, path: dict, phi: np.ndarray) -> np.ndarray:
        """Sums over the leaves below of value times product; adds what the edges below give to ``phi``."""
        if self.leaf[node]:
            return product * self.length[node]
        f = int(self.feature[node])
        below = columns[f] <= self.split[node]
        before = path.get(f)
        total = 0.0
        for child, side in ((self.left[node], below), (self.right[node], ~below)):
            share = self.n[child] / self.n[node]
            if before is None:
                hit, s, inner = side, share, product
            else:
                hit, s, inner = side & before[0], share * before[1], product / before[2]
            factor = s * (1 - self.y)[:, None] + self.y[:, None] * hit
            sums = self._walk(child, columns, inner * factor, {**path, f: (hit, s, factor)}, phi)
            phi[f] += (hit - s) * (self.weight @ (sums / factor))
            if before is not None:  # the edge above no longer speaks for these leaves
                phi[f] -= (before[0] - before[1]) * (self.weight @ (sums / before[2]))
            total = total + sums
        return total


def _matrix(cols) -> np.ndarray:
    cols = cols if isinstance(cols, tuple) else (cols,)
    return np.column_stack([c.to_numpy(dtype=float) for c in cols])


def _broadcast(forest: Forest):
    sc = forest.nodes.sparkSession.sparkContext
    return sc.broadcast(forest.nodes.toPandas())  # bounded by trees * (2*sample - 1) rows


def score_forest(df: DataFrame, forest: Forest, name: str = "scores_if") -> DataFrame:
    """Adds the raw anomaly score 2**(-E[path]/c(sample)), in (0, 1).

    Only the feature columns cross to Python.
    """
    shared = _broadcast(forest)
    scale = float(average_path(max(forest.sample, 2)))

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = _Trees(shared.value)
        for cols in batches:
            x = _matrix(cols)
            yield pd.Series(np.power(2.0, -trees.path_lengths(x) / scale))

    return df.withColumn(name, score(*[F.col(f) for f in forest.features]))


# -- one forest per group -----------------------------------------------------

GROUP_ROWS = 50_000  # rows of one group that a task scores beside a copy of the group's forest
MODEL, PART = "__model", "__part"


@dataclass
class Forests:
    models: DataFrame  # one row per group: ``by``, __n rows, ``__model``
    by: list[str]
    features: list[str]


def fit_forests(
    df: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = ("series_key",),
    ids: Sequence[str] = ("series_key", "date"),
    trees: int = S.FOREST_TREES,
    sample: int = S.FOREST_SAMPLE,
    seed: int = S.FOREST_SEED,
    weight: str | None = None,
    kept: DataFrame | None = None,
) -> Forests:
    """A forest for each group of rows with equal ``by``; nulls make a group too.

    ``kept`` (by, kept) lists the features that a group's forest sees, all of ``features`` if not
    given.  The draws of a group's trees hash the group's values too.  A group without rows of
    positive weight has no forest.
    """
    features, by = list(features), list(by)
    drawn = tree_samples_by(df, features, by, ids, trees, sample, seed, weight)
    every = F.array(*[F.lit(f) for f in features])
    drawn = drawn.withColumn("kept", every) if kept is None else _join_same(drawn, kept.select(*by, "kept"), by, "left")
    drawn = drawn.withColumn("kept", F.coalesce("kept", every))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        tree, own = int(first["tree_id"]), [features.index(f) for f in first["kept"]]
        x = pdf.sort_values("__rn")[features].to_numpy(dtype=float)[:, own]
        salt = "|".join([str(seed), *[str(first[c]) for c in by if not pd.isna(first[c])]])
        rows = _grow(x, salt, tree, max(1, math.ceil(math.log2(max(min(int(first["__n"]), sample), 2)))))
        out = pd.DataFrame(rows, columns=["node_id", "feature", "split", "left", "right", "n", "depth"])
        out["feature"] = [own[f] if f >= 0 else -1 for f in out["feature"]]
        out["tree_id"] = tree
        return pd.DataFrame([[*[first[c] for c in by], int(first["__n"]), out[[c.split()[0] for c in NODES.split(", ")]].to_numpy(float).tobytes()]])

    keys = T.StructType([df.schema[c] for c in by]).add("__n", "long")
    shape = T.StructType(list(keys.fields)).add("nodes", "binary")
    drawn = drawn.repartition(session.task_count(df.sparkSession), *by, "tree_id")
    grown = drawn.groupBy(*by, "tree_id").applyInPandas(lambda pdf: grow(pdf).set_axis(shape.names, axis=1), shape)
    # trees x (2 sample - 1) nodes of a group
    models = grown.groupBy(*by).agg(F.first("__n").alias("__n"), F.sort_array(F.collect_list("nodes")).alias(MODEL))
    return Forests(settle(models), by, features)


def _unpacked(model: list[bytes]) -> pd.DataFrame:
    names = [c.split()[0] for c in NODES.split(", ")]
    cells = np.concatenate([np.frombuffer(t).reshape(-1, len(names)) for t in model])
    whole = {n: int for n in names if n != "split"}
    return pd.DataFrame(cells, columns=names).astype(whole)


def _beside(df: DataFrame, forests: Forests, new: Sequence[str], make, group_rows: int) -> DataFrame:
    """``df`` with double columns that ``make(model, n)``, a function of a matrix, gives for each group's rows.

    A group's rows are dealt to parts of about ``group_rows``, each headed by a copy of the group's
    forest, so a hot group is spread; a task holds one forest and one batch.  Rows of a
    group without a forest get nulls.
    """
    columns, by, features = df.columns, forests.by, forests.features
    parts = F.greatest(F.lit(1), F.ceil(F.col("__n") / group_rows)).cast("int").alias("__parts")
    sizes = settle(df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).select(*by, parts))
    spread = F.pmod(F.xxhash64(*columns), F.col("__parts")).cast("int")
    rows = _join_same(df, sizes, by).withColumn(PART, spread).drop("__parts")
    heads = _join_same(forests.models, sizes, by).withColumn(PART, F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    both = rows.unionByName(heads.select(*by, "__n", MODEL, PART), allowMissingColumns=True)
    n = session.task_count(df.sparkSession)
    both = both.repartition(n, *by, PART).sortWithinPartitions(*by, PART, F.col(MODEL).isNull())
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in new]])
    at = [columns.index(f) for f in features]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = fn = None
        for b in batches:
            keys = list(zip(*[b.column(columns.index(c)).to_pylist() for c in by], b.column(b.schema.get_field_index(PART)).to_pylist()))
            model = b.column(b.schema.get_field_index(MODEL))
            cut = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or model[i - 1].is_valid], len(keys)]
            for i, j in zip(cut, cut[1:]):
                if i == j:
                    continue
                if model[i].is_valid:
                    group, fn = keys[i], make(_Trees(_unpacked(model[i].as_py())), b.column(b.schema.get_field_index("__n"))[i].as_py())
                    continue
                own = [b.column(k).slice(i, j - i) for k in range(len(columns))]
                if keys[i] == group:
                    x = np.column_stack([own[k].to_numpy(zero_copy_only=False).astype(float) for k in at])
                    out = fn(x).reshape(j - i, len(new))
                else:
                    out = np.full((j - i, len(new)), np.nan)
                cells = [pa.array(c, pa.float64(), from_pandas=True) for c in out.T]
                yield pa.RecordBatch.from_arrays([*own, *cells], names=[*columns, *new])

    return both.mapInArrow(run, schema)


def score_forests(
    df: DataFrame, forests: Forests, name: str = "scores_if", sample: int = S.FOREST_SAMPLE, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Adds each row's raw anomaly score by its own group's forest."""

    def make(trees: _Trees, n: int):
        scale = float(average_path(max(min(n, sample), 2)))
        return lambda x: np.power(2.0, -trees.path_lengths(x) / scale)

    return _beside(df, forests, [name], make, group_rows)


def forests_attribution(df: DataFrame, forests: Forests, prefix: str = "shap_", group_rows: int = SMALL_TASK) -> tuple[DataFrame, list[str]]:
    """Adds one column per feature: the absolute Shapley value by the row's own group's forest."""
    names = [prefix + f for f in forests.features]

    def make(trees: _Trees, n: int):
        return lambda x: np.abs(trees.shapley(x))

    return _beside(df, forests, names, make, group_rows), names


def forest_attribution(
    df: DataFrame, forest: Forest, ids: Sequence[str] = ("series_key", "date"), prefix: str = "shap_"
) -> tuple[DataFrame, list[str]]:
    """Adds one column per feature: the absolute Shapley value of its path length.

    Costs rows x nodes of all trees, so pass only the rows that are wanted.  That is
    far more than moving a row, so rows are first spread evenly over the cluster.
    """
    shared = _broadcast(forest)
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(math.ceil(n / SMALL_TASK), max(4 * cores, n // LARGE_TASK)))
    df = df.repartition(tasks, *ids)
    names = [prefix + f for f in forest.features]
    out = T.StructType([T.StructField(n, T.DoubleType()) for n in names])

    @F.pandas_udf(out)
    def attribute(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        trees = _Trees(shared.value)
        for cols in batches:
            yield pd.DataFrame(np.abs(trees.shapley(_matrix(cols))), columns=names)

    with_values = df.withColumn("__shap", attribute(*[F.col(f) for f in forest.features]))
    return with_values.select(*df.columns, *[F.col("__shap")[n].alias(n) for n in names]), names
