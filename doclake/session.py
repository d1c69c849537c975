"""Session settings the operators are written for, and the one place lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does three jobs here: it merges small shuffle partitions, turns a shuffle join
# into a broadcast once the real size is known to be small, and splits the partition of a hot key in
# a join (see operators.joins). All but the forced split are Spark's defaults.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply :data:`SCALE_CONF` to a session builder."""
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    return builder


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints: the cluster's ``spark.checkpoint.dir`` if it names one.

    Only a local session may fall back to a temporary folder; on a cluster that folder would vanish
    with its machine, so a missing setting is an error there.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="doclake-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the checkpoint folder, so lost executors cannot change it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
