"""A local session with the settings the jobs are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pagewinnow") -> SparkSession:
    """Local mode only; on a cluster use the session the cluster hands you."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # rows reach the page aggregate sorted by page, so it can stream one page
        # at a time instead of holding many collected pages in a hash map
        .config("spark.sql.execution.replaceHashWithSortAgg", "true")
        # the work is regular expressions over text, so small partitions pay off
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate files.

    Only a local session may go without and gets a temporary folder; elsewhere
    executors would each write to their own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="pagewinnow-")


def durable(df: DataFrame) -> DataFrame:
    """Work a narrow frame out once, through the reliable checkpoint folder.

    Uses the folder the cluster names in ``spark.checkpoint.dir`` (or one
    already set on the context), so the rows survive lost executors.  Without
    either the frame stays lazy and is worked out again by each reader.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not folder:
            return df
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
