"""Steps of a job: tables in the shared folder, task counts from measured rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch import session

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def settle(df: DataFrame, batch_bytes: int | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The shuffle files of the step go once its table is there; later steps read the
    table, also when executors were lost meanwhile.  ``batch_bytes`` limits what
    Python steps get at once, for rows that hold whole blocks.
    """
    conf = df.sparkSession.conf
    wanted = {CLEANUP: "true"}
    if batch_bytes:
        wanted[BATCH] = str(batch_bytes)
    if compression:
        wanted["spark.sql.parquet.compression.codec"] = compression
    before = {k: conf.get(k, "false" if k == CLEANUP else None) for k in wanted}
    for k, v in wanted.items():
        conf.set(k, v)
    try:
        return session.settle(df)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def tasks(df: DataFrame, rows_each: int) -> int:
    """Partitions for a Python step over ``df``, a settled table: from its row count."""
    return max(session.task_count(df.sparkSession), -(-df.count() // rows_each))


def deal(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Rows with equal keys side by side in one of ``n`` partitions."""
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def row_key(id_col: str, text_col: str) -> list:
    """Two columns that stand for a row: 64 and 24 bits over its id and whole text."""
    return [
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("rid"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).bitwiseAND(F.lit(0xFFFFFF)).alias("tag"),
    ]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Output batches of at most ``rows`` rows."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
