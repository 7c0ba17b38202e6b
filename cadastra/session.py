"""Session settings the library is tuned for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimension joins are left to Spark: a side is broadcast only when its size is known to be below this.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # Large enough for a national registry's opted-in keys: establishments of other companies are
    # dropped by a runtime Bloom filter before they are shuffled. Its size is bounded by maxNumBits.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4g",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "20000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "40000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "160000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "320000000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "cadastra", **conf: str) -> SparkSession:
    """Create a session; on a cluster leave ``master`` out and let spark-submit decide."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir`` or set on the context.

    Only a local-mode session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="cadastra-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def release(spark: SparkSession) -> None:
    """Has the driver collect its garbage after a job that wrote what it made: Spark keeps the shuffle files of plans that nothing refers
    to until then, which may be for as long as the session lasts."""
    spark._jvm.System.gc()
