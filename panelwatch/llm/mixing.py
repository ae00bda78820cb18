"""Mixing sources to target weights, cut at exact word budgets.

Targets fill up by weight and stop at ``MOST`` times a source's size; the excess goes to
the others by weight.  Documents get hash-random keys; sorted by key, a source is taken
round after round, and its last round ends at the word where the budget ends.  Running
sums are taken within hash ranges of a source and carried over by the sums of the ranges,
so a source with a third of all rows is spread over as many tasks as its rows need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.llm.steps import settle

WEIGHTS = (1, 2, 3)
MOST = 3
ROWS_PER_RANGE = 4_000
SEED = "mix-1"
_SPACES = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{_SPACES}|{_SPACES}\z", "")
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, _SPACES))).cast("long")


def random_key(id_col: str, text_col: str, seed: str = SEED) -> Column:
    """Hex digits that depend on seed, id and text alone; the first eight deal out the ranges."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))


def targets(sized: DataFrame, source: str = "source", size: str = "size", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, n_rows, weight, target) of every source; null is a source, the last.

    One task shares out the budget over all sources, a row each; meant for up to some millions of them.

    Sources by how soon they are full: one is full if its share of what those before leave
    reaches its limit.  From the first that is not on, all share the rest by weight: the
    level rises up to there and falls behind it.
    """
    per = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long"))
    per = per.withColumn("cap", most * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    past, all_ = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = lambda total, c: F.sum(total).over(all_) - F.coalesce(F.sum(c).over(past), F.lit(0))
    level = left("source_size", "cap").cast("double") / left("weight", "weight").cast("double")
    per = per.withColumn("level", level)
    per = per.withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    shared = F.max(F.when(~F.col("full"), F.col("level"))).over(all_)
    per = per.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * shared))
    return per.select("source", "source_size", "n_rows", "weight", "target")


def with_taken(docs: DataFrame, source: str = "source", size: str = "size", key: str = "key", weights: tuple[int, ...] = WEIGHTS,
               most: int = MOST, narrow: DataFrame | None = None) -> DataFrame:
    """``docs`` (with word counts and keys) with ``source_size``, ``target`` and ``taken``.

    ``narrow``, if given, has the source, size and key of the same rows; sums are taken of it,
    so wide rows are read once.

    ``taken`` counts the words of a row that the mix has, over all rounds: whole rounds take
    every word, the last one only words before the budget's end, so the words taken of a
    source are its target rounded down.  Rows without words take none.  Rows of equal key
    and size are interchangeable.  Null sources are one source.  Columns of these names in
    ``docs`` are replaced, others kept; an empty table gives an empty table.
    """
    docs = docs.drop("source_size", "target", "taken")
    counted = docs if narrow is None else narrow
    plan = targets(counted, source, size, weights, most).select(
        F.col("source").alias("_s"), "source_size", "target", F.ceil(F.col("n_rows") / ROWS_PER_RANGE).alias("_ranges")
    )
    plan = settle(plan)
    range_ = F.expr(f"shiftright(cast(conv(substr({key}, 1, 8), 16, 10) as long) * _ranges, 32)")  # no overflow below 2**31 ranges
    dealt = lambda df: df.join(plan, df[source].eqNullSafe(F.col("_s"))).withColumn("_range", range_)
    rows = dealt(docs)
    totals = dealt(counted).groupBy("_s", "_range").agg(F.sum(size).alias("_words"))
    before = Window.partitionBy("_s").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    past = totals.select(
        F.col("_s").alias("_ps"), F.col("_range").alias("_pr"), F.coalesce(F.sum("_words").over(before), zero).alias("_past")
    )
    past = settle(past)
    rows = rows.join(past, F.col("_s").eqNullSafe(F.col("_ps")) & (F.col("_range") == F.col("_pr")))
    inside = Window.partitionBy("_s", "_range").orderBy(key, size).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_past") + F.coalesce(F.sum(size).over(inside), zero)
    rounds = F.expr("coalesce(cast(floor(target) as long) div nullif(source_size, 0), 0)")
    rest = F.floor("target").cast("long") - rounds * F.col("source_size")
    cut = F.greatest(zero, F.least(F.col(size), rest - start))
    out = rows.withColumn("taken", rounds * F.col(size) + cut)
    return out.select(*docs.columns, "source_size", "target", "taken")


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words of a text, a blank between them."""
    return F.array_join(F.slice(F.split(F.regexp_replace(text, rf"^{_SPACES}", ""), _SPACES), F.lit(1), n), " ")


def copies(mixed: DataFrame, text_col: str = "text", size: str = "size") -> DataFrame:
    """One row for each time a document is taken; the last one may have its first words only."""
    rows = mixed.filter("taken > 0").withColumn("_left", F.col("taken") % F.col(size))
    times = F.ceil(F.col("taken") / F.col(size)).cast("int")
    rows = rows.withColumn("_time", F.explode(F.sequence(F.lit(1), times))).withColumn("_last", F.col("_time") == times)
    text = F.when(F.col("_last") & (F.col("_left") > 0), first_words(F.col(text_col), F.col("_left").cast("int"))).otherwise(F.col(text_col))
    return rows.withColumn(text_col, text).drop("_left", "_time", "_last")
