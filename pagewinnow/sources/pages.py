"""Page sources: a table of pages, or a directory tree of HTML files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pagewinnow.functions.text import quoted
from pagewinnow.session import durable

PAGE_COLUMNS = ("page_id", "url", "html")
#: folders are listed by at most so many tasks for each core; the scan's partitions of few files that a task reads
LISTED, PARTS = 16, 32


def read_pages(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Parquet pages ``page_id, url, html``.

    A file of one row group is read by one task, and all work before the first
    exchange stays in that task.  ``min_partitions`` spreads such a small input
    first; a table that has as many splits is left as it is.
    """
    pages = spark.read.parquet(path).select(*PAGE_COLUMNS)
    if min_partitions is None or pages.rdd.getNumPartitions() >= min_partitions:
        return pages
    return pages.repartition(min_partitions)


def read_page_tree(spark: SparkSession, root: str, glob: str = "*.html") -> DataFrame:
    """Every HTML file under a directory, raw bytes, keyed by relative path.

    ``page_id`` is the file's place among the sorted relative paths, so ids
    never clash; they change when files are added.  Only paths are sorted and
    numbered, at once, and the numbers are joined to the files.
    """
    files = _files(spark, root, glob)
    # the scan takes few files to a partition, however small they are
    parts = files.rdd.getNumPartitions()
    files = files.coalesce(max(4 * spark.sparkContext.defaultParallelism, parts // PARTS))
    folder = root.rstrip("/") + "/"
    # from the root's first place on, which is the leading one
    relative = F.expr(f"substr(path, locate({quoted(folder)}, path) + {len(folder)})")
    # worked out first: dealing out by ranges reads its rows twice
    numbers = numbered(durable(files.select(relative.alias("path"))), "path", "page_id")
    files = files.select(relative.alias("path"), F.col("content").alias("html"))
    return files.join(numbers, "path").select("page_id", F.lit(None).cast("string").alias("url"), "html", "path")


def _files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """All files below a folder.  A task lists many folders, not one: each has to be told all settings first."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    most = spark.conf.get(name)
    spark.conf.set(name, str(min(int(most), LISTED * spark.sparkContext.defaultParallelism)))
    try:
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob)
            .load(root)
        )
    finally:
        spark.conf.set(name, most)


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2 … in the order of ``key``, without bringing the rows together.

    Rows are dealt out by ranges of the key and numbered within each; where a
    range begins follows from the counts of those before it.
    """
    dealt = rows.repartitionByRange(key).sortWithinPartitions(key)
    dealt = durable(dealt.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id")))
    # the upper bits of such an id are the partition, the lower ones the place in it
    place = F.col("_id") - F.shiftleft(F.col("_part").cast("long"), 33)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # a row for each partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    return dealt.join(begins, "_part").select(*rows.columns, (F.col("_begin") + place).alias(name))
