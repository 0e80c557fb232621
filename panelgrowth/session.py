"""SparkSession helpers.

The checkpoint directory is read from the session (``spark.checkpoint.dir``).
Only a local-mode session without that setting gets a fresh scratch folder;
a cluster session without it is an error, because a machine-local folder is
not visible to every executor.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    # checkpoint files are removed once their DataFrames are unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # no broadcast from file-size estimates; explicit hints are placed only
    # after a row-count check, and AQE may broadcast a side it has measured
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "2MB",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app: str = "panelgrowth", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.setdefault("spark.driver.memory", "16g")
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` when the session names one; otherwise, in
    local mode only, creates a fresh folder under the system temp dir and
    records it in the session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder "
                "(HDFS/S3/ABFS) that every executor can reach")
        configured = tempfile.mkdtemp(prefix="panelgrowth-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
