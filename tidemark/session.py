"""Session settings the library relies on, and the shared folder its tables live in."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    # Bad casts and bad date keys must fail the stage, not turn into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Hot keys: split oversized join partitions at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where an aggregate above could have used the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffled rows are wide, and disk is scarcer than CPU: a third smaller than Spark's default.
    "spark.io.compression.codec": "zstd",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a single-machine session may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_dir(spark)
