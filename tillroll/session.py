"""SparkSession construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tillroll job wants: AQE re-plans joins (broadcast when the
# measured side is small, split skewed partitions) and coalesces tiny
# shuffle partitions; timestamps are wall-clock (no zone shifts).
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of DataFrames that went out of scope are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # RDD-based library shuffles (FP-growth moves FP-trees) use Kryo.
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    app_name: str = "tillroll",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with tillroll's defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home and return it.

    On a cluster the location comes from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session with nothing configured gets a
    private scratch folder; a cluster session without the setting is an
    error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpoints survive executor loss"
        )
    scratch = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()
