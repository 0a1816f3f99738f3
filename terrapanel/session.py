"""Session construction and lineage helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants; callers may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def scale_settings(input_bytes: int, split_bytes: int = 512 * 1024 * 1024,
                   max_shuffle_partitions: int | None = None) -> dict[str, str]:
    """Partition settings sized to the input.

    Scans read ``split_bytes`` splits.  The largest shuffle of this package
    is the row-level enrichment of the readings (the pruned columns, a
    fraction of the input), so about 1 GB of input per reducer keeps shuffle
    partitions at a few hundred MB.  The driver tracks map outputs per (map
    task, reducer): a caller whose driver is small may bound the count.  AQE coalesces partitions of
    the small aggregates and splits skewed ones (a key holding a third of the
    rows is cut into advisory-sized pieces).
    """
    n = max(200, int(input_bytes // (1024 ** 3)))
    if max_shuffle_partitions is not None:
        n = min(n, max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "terrapanel",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with adaptive execution switched on."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    ``spark.checkpoint.dir`` is read from the session.  Only a local-mode
    session (tests) may fall back to a private temporary folder; on a cluster
    an unset directory is an error, because a machine-local folder would not
    survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="terrapanel-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS)"
    )


def application_key(spark: SparkSession) -> str:
    """Identifies the running application (and session object) for per-session caches."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - remote session
        app = spark.conf.get("spark.app.id", "remote")
    return f"{app}/{id(spark)}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage.

    Used after expensive, reused stages (model fits) so that a lost executor
    re-reads the checkpoint instead of recomputing the whole plan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
