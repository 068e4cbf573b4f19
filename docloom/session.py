"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions, coalesces small shuffle partitions and turns a
# sort-merge join into a broadcast only after it has measured the side.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Documents may be large: a batch for Python is bounded by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # Recording the Python call site of every expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "docloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="docloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/docloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Reliable checkpoint: the result survives the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, limit: int) -> None:
    """From now on Arrow batches for Python hold about ``limit`` bytes at most; a smaller limit stays.

    Spark's own, 64 MB, is that of one copy in one worker, and a worker makes several of a batch.
    """
    now = spark.conf.get(BATCH_BYTES).removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= limit:
        spark.conf.set(BATCH_BYTES, str(limit))


def spread(df, *keys: str):
    """Hash-partition ``df`` over all cores when its scan has fewer splits than there are cores.

    For heavy per-row work on a table that arrives as a few unsplittable files. A table of many
    files passes through untouched, so at scale this costs nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
