"""Registered queries on tables that are folders of files."""

import pytest
from pyspark.sql import functions as F

from pagewinnow.catalog.queries import REGISTERED, _in_batches
from tests.conftest import article


@pytest.fixture
def tables(spark, tmp_path):
    """The same rows as one file a table and as folders of several."""
    texts = [article(f"<p>Body number {n} of them all.</p>") for n in (0, 1, 1, 2, 0, 3, 2)]
    pages = spark.createDataFrame([(i, None, t) for i, t in enumerate(texts)], "page_id BIGINT, url STRING, html STRING")
    docs = pages.select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    for name, rows in (("pages", pages), ("documents", docs)):
        rows.repartition(3).write.parquet(str(tmp_path / f"folders/{name}.parquet"))
        rows.coalesce(1).write.parquet(str(tmp_path / f"one/{name}"))
        (part,) = (tmp_path / f"one/{name}").glob("part-*.parquet")
        (tmp_path / "files").mkdir(exist_ok=True)
        (tmp_path / f"files/{name}.parquet").write_bytes(part.read_bytes())
    return str(tmp_path / "files"), str(tmp_path / "folders")


@pytest.mark.parametrize("name", ["stream_dedup", "stream_extract", "stream_tally"])
def test_a_stream_of_a_folder_has_the_rows_of_the_file(spark, tables, name):
    of_file, of_folder = (sorted(map(str, REGISTERED[name](spark, d).collect())) for d in tables)
    assert of_file == of_folder and of_file


def test_a_part_of_many_partitions_is_one_batch_and_no_single_file(spark, tmp_path):
    parts = [spark.range(100 * k, 100 * k + 100, numPartitions=4) for k in range(3)]
    batches, files = [], []

    def start(live):
        def one_batch(batch, batch_id):
            batches.append(sorted(r.id for r in batch.collect()))
            files.append(batch.select(F.input_file_name()).distinct().count())

        return live.writeStream.foreachBatch(one_batch).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()

    _in_batches(spark, parts, "parts", start)
    assert batches == [list(range(100 * k, 100 * k + 100)) for k in range(3)]
    assert files == [4, 4, 4]
