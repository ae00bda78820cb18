"""From raw documents to packed token ids, in five stages.

Every stage works on all that its predecessor kept, and each but the last returns the
columns of its input.  Stages are written as Parquet to the shared folder and read again,
so a lost executor costs part of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.llm import decontamination, language, mixing, near_dedup
from panelwatch.llm.queries import packed, sized, table
from panelwatch.llm.steps import settle


REST = "__rest"


def set_aside(docs: DataFrame, *used: str) -> DataFrame:
    """``used`` columns, and all others as one, so that no operator's own columns meet theirs."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*rest, F.lit(0).alias(REST)).alias(REST))


def put_back(rows: DataFrame, columns: list[str], *used: str) -> DataFrame:
    return rows.select(*[F.col(c) if c in used else F.col(REST)[c].alias(c) for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those between two languages, go.

    If no document with a letter has a ``lang``, there is no model: only those without a letter go.
    """
    model = language.train(docs)
    if model is None:
        return docs.filter(language.lettered("text"))
    found = language.with_language(set_aside(docs, "text"), model)
    return put_back(found.filter((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous")), docs.columns, "text")


#: Similarity of word shingles, in percent, from which documents are near duplicates here; op9 alone has 85.
NEAR_PERCENT = 80


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (``NEAR_PERCENT`` of their shingles or more) stays."""
    groups = near_dedup.near_groups(docs, percent=NEAR_PERCENT)
    gone = settle(groups.filter(~F.col("stays")).select("rid").distinct())
    again = settle(groups.filter("stays and n_shingles > 0").groupBy("rid").count().filter("count > 1").select("rid"))
    rows = set_aside(docs, "doc_id", "text").withColumn("rid", F.xxhash64(F.col("doc_id").cast("string"), "text")).join(gone, "rid", "left_anti")
    if not again.isEmpty():  # whole rows that repeat
        rows = rows.join(again, "rid", "left_anti").unionByName(rows.join(again, "rid", "left_semi").dropDuplicates(["rid"]))
    return put_back(rows, docs.columns, "doc_id", "text")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go."""
    leaks = settle(decontamination.covered_texts(docs, table(spark, sf_dir, "benchmark")).select("rid").distinct())
    rows = set_aside(docs, "doc_id", "text").withColumn("rid", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    return put_back(rows.join(leaks, "rid", "left_anti"), docs.columns, "doc_id", "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents repeat, go, or end where a budget ends."""
    used = ("doc_id", "text", "source")
    wide = sized(set_aside(docs, *used))
    narrow = settle(wide.select("source", "size", "key"))
    mixed = put_back(mixing.copies(mixing.with_taken(wide, narrow=narrow)), docs.columns, *used)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of packed token ids."""
    return packed(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("source_mix", mix_sources),
    ("packed_ids", pack_tokens),
]

#: Trained classifiers and a tokenizer are not SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
