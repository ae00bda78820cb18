"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "panelwatch", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs assume; a cluster supplies the master."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def task_count(spark: SparkSession) -> int:
    """Partitions for a shuffle ahead of work that is heavy for its bytes.

    Named in a ``repartition`` this number stays; partitions merged by size alone
    would leave windows and Python steps over small rows to a few cores.
    """
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if spark.sparkContext.master.split("[")[0] != "local":  # local-cluster has executors of its own
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelwatch-"))
    return spark.sparkContext.getCheckpointDir()


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables of this application, when no frame on them is needed any more.

    Only paths that ``scratch_path`` has given out go; the number of them is returned.
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, for use by several jobs.

    The table outlives executors, later jobs read only the columns they need, and
    its size is known, so Spark broadcasts it only if it is small.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
