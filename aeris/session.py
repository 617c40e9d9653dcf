"""Session helpers: tuned defaults that only fill gaps, never override cluster settings."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Defaults applied only when the session does not already define them.
DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "aeris", master: str | None = None, shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local / test session builder. On a cluster use the provided session and call
    :func:`apply_defaults` instead."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # checkpoints written to cut lineage are removed once their DataFrame is garbage-collected
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the tuned defaults only where the session leaves them unset."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent and Spark runs in this one process (``local[...]``, as in
    tests), a fresh folder is created and registered. On a cluster an absent setting raises
    ``ValueError``: a machine-local folder would be invisible to the other executors."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="aeris-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder
