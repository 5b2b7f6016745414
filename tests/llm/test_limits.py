"""What workers and disks hold while an operator runs."""

import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from plotwise.llm import phrases
from plotwise.llm.spark import ARROW_BYTES, BATCH_BYTES, in_arrow, stored
from plotwise.session import FREED


@pytest.fixture
def unset(spark):
    spark.conf.unset(BATCH_BYTES)
    yield
    spark.conf.unset(BATCH_BYTES)


def counting():
    import pyarrow as pa

    def read(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    return read


def test_large_rows_make_batches_of_few(spark, unset):
    rows = spark.range(0, 24, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    counts = [r["n"] for r in in_arrow(rows, counting(), "n long").collect()]
    assert sum(counts) == 24 and max(counts) <= ARROW_BYTES >> 20


def test_a_bound_of_the_session_stays(spark, unset):
    spark.conf.set(BATCH_BYTES, str(1 << 20))
    in_arrow(spark.range(1), counting(), "n long")
    assert spark.conf.get(BATCH_BYTES) == str(1 << 20)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    before, given = shuffle_files(spark), spark.conf.get(FREED)
    rows = stored(spark.range(1000).repartition(7, "id"), "freed")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and rows.count() == 1000
    assert spark.conf.get(FREED) == given


@pytest.mark.parametrize("size", [200, 70_000])
def test_index_blobs_compress(size):
    values = (np.random.default_rng(3).zipf(1.3, 40_000) % size).astype(np.int64)
    blob = phrases._blob(values, size)
    assert (phrases._whole(blob) == values).all()
    plain = values.astype(np.uint16 if size < 2**16 else np.int32).tobytes()
    assert len(blob) == len(plain) + 4
    assert len(pa.compress(blob, codec="zstd", asbytes=True)) < 0.95 * len(pa.compress(plain, codec="zstd", asbytes=True))


def test_indexes_lie_compressed(spark):
    docs = spark.createDataFrame([("en", "one two three " * 50)], "lang string, text string")
    made = in_arrow(docs, phrases._index_shards(phrases._arrow(phrases.SHARD), 1 << 20), phrases.SHARD)
    with phrases._shards(made) as shards:
        files = [f.removeprefix("file://") for f in shards.inputFiles()]
        kinds = {pq.ParquetFile(f).metadata.row_group(0).column(c).compression for f in files for c in range(5)}
        assert shards.count() == 1
    assert kinds == {"ZSTD"}
