"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of id and text checksum.  The number goes through a
Feistel network over a grid of ``a`` x ``b`` cells that holds all ``n`` rows and few more;
a number that lands beyond the rows walks on through the network until it is back (cycle
walking).  Place p goes to shard p mod S, slot p div S, so shard sizes differ by one at
most, slots have no gaps, and the place of a row can be computed from its number alone.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.llm.steps import settle

ROUND_KEYS = [1013904223, 1664525, 22695477, 1140671485, 214013, 69069]
_MASK = 2147483647
RADIX_CHOICES = 512


def grid(n: int) -> tuple[int, int]:
    """Sides of the grid: near the root of ``n``, chosen so that few cells lie beyond ``n``."""
    low = max(1, isqrt(n) - RADIX_CHOICES)
    a = min(range(isqrt(n), low - 1, -1), key=lambda a: -n % a) if n else 1
    return a, max(1, -(-n // a))


def scramble(x: str, key: int | str, dialect: str = "spark") -> str:
    """The round function as SQL text; all products stay below 2^62."""
    xor = (lambda a, b: f"xor({a}, {b})") if dialect == "duckdb" else (lambda a, b: f"(({a}) ^ ({b}))")
    div = "//" if dialect == "duckdb" else "div"
    t = f"((({x}) + {key}) % 2147483647 * 1103515245 % 2147483647)"
    t = f"({xor(t, f'({t} {div} 32768)')} * 747796405 % 2147483647)"
    return xor(t, f"({t} {div} 8192)")


def step_sql(x: str, a: int, b: int) -> str:
    """The whole network on ``x`` as one Spark expression, for the few numbers that walk."""
    keys = ", ".join(f"{k}L" for k in ROUND_KEYS)
    return (
        f"aggregate(array({keys}), struct({x} div {b}L as l, {x} % {b}L as r, true as left), "
        f"(s, k) -> if(s.left, struct((s.l + {scramble('s.r', 'k')}) % {a}L as l, s.r as r, false as left), "
        f"struct(s.l as l, (s.r + {scramble('s.l', 'k')}) % {b}L as r, true as left)), s -> s.l * {b}L + s.r)"
    )


def permuted(rows: DataFrame, number: str, n: int) -> DataFrame:
    """``rows`` with ``place``: the row number sent through the permutation of 0 to n - 1.

    A walk leaves the cells beyond ``n`` after at most as many steps as there are such cells.
    """
    a, b = grid(n)
    out = rows.withColumns({"_l": F.expr(f"{number} div {b}L"), "_r": F.expr(f"{number} % {b}L")})
    for i, k in enumerate(ROUND_KEYS):
        side, other, size = ("_l", "_r", a) if i % 2 == 0 else ("_r", "_l", b)
        out = out.withColumn("_f", F.expr(scramble(other, f"{k}L"))).withColumn(side, F.expr(f"({side} + _f) % {size}L"))
    out = out.withColumn("place", F.expr(f"_l * {b}L + _r")).drop("_l", "_r", "_f")
    beyond = a * b - n
    if beyond:
        walk = f"aggregate(sequence(1, {beyond}), place, (x, i) -> if(x < {n}L, x, {step_sql('x', a, b)}))"
        out = out.withColumn("place", F.expr(f"if(place < {n}L, place, {walk})"))
    return out


def numbered(rows: DataFrame, *order: Column) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` from 0 in the given order, and how many there are.

    Rows are dealt by ranges of the order and written; counts of the parts give each part's
    first number.  Where the ranges lie has no influence on the numbers.
    """
    dealt = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    dealt = settle(dealt)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    past = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("_part", F.coalesce(F.sum("_n").over(past), F.lit(0)).cast("long").alias("_first"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    out = dealt.join(firsts, "_part").withColumn("row_number", F.col("_first") + rank)
    return out.drop("_part", "_first"), dealt.count()


def with_size(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes plus 1) and ``text_crc32``; null texts have 1 and 0."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.withColumns({"size": (F.octet_length(raw) + 1).cast("long"), "text_crc32": F.crc32(raw)})


def sharded(docs: DataFrame, shards: int, id_col: str = "doc_id") -> DataFrame:
    """``docs`` (with size and checksum) with ``row_number``, ``place``, ``shard`` and ``slot``.

    The order is id (null last), then checksum, then size; rows equal in all three take
    neighbouring numbers in any order, which no result tells apart unless their other
    columns differ.  Columns of these names in ``docs`` are replaced, others kept.  An empty
    table gives an empty table.
    """
    docs = docs.drop("row_number", "place", "shard", "slot")
    rows, n = numbered(docs, F.col(id_col).asc_nulls_last(), F.col("text_crc32").asc(), F.col("size").asc())
    out = permuted(rows, "row_number", n)
    return out.withColumns({"shard": F.expr(f"cast(place % {shards} as int)"), "slot": F.expr(f"place div {shards}")})


def placed_again(row_number: int, n: int) -> int:
    """The place of one row number, without Spark."""
    a, b = grid(n)

    def scrambled(x: int, k: int) -> int:
        t = (x + k) % _MASK * 1103515245 % _MASK
        t = (t ^ t // 32768) * 747796405 % _MASK
        return t ^ t // 8192

    x = row_number
    while True:
        left, right = divmod(x, b)
        for i, k in enumerate(ROUND_KEYS):
            if i % 2 == 0:
                left = (left + scrambled(right, k)) % a
            else:
                right = (right + scrambled(left, k)) % b
        x = left * b + right
        if x < n:
            return x
