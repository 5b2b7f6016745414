"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job expects. Sizes suit both a laptop run and a large cluster;
# the shuffle width is the only one to raise with the data (AQE merges the excess).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot compiles no method above 8000 bytes; many rules in one stage make longer ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8, **conf) -> SparkSession:
    builder = SparkSession.builder.appName("plotwise")
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else built."""
    for key, value in JOB_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


SHUFFLE_BYTES = 8 << 20  # of the input for one partition of a shuffle
WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def widen(spark: SparkSession, size: int) -> None:
    """Let shuffles begin with a partition for every SHUFFLE_BYTES of an input of that size.

    So partitions grow in number with the input and not in size. AQE merges those that turn out
    small; a width that is set already, or the session's shuffle width, is only ever raised.
    """
    given = spark.conf.get(WIDTH, None) or spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(WIDTH, str(max(int(given), -(-size // SHUFFLE_BYTES))))


def file_system(spark: SparkSession, path: str):
    """The store a path lies in, and the path as it names it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def _until_the_end(spark: SparkSession, folder: str) -> str:
    """A folder that is removed when the application ends."""
    files, place = file_system(spark, folder)
    files.mkdirs(place)
    files.deleteOnExit(place)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = _until_the_end(spark, tempfile.mkdtemp(prefix="plotwise-"))
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody used before, inside the shared folder; it goes when the application ends."""
    own = f"{shared_folder(spark)}/plotwise-{spark.sparkContext.applicationId}"
    return f"{_until_the_end(spark, own)}/{label}-{uuid.uuid4().hex}"


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Writes in here drop their shuffle files when they end, not when the driver collects its garbage.

    What is written cuts lineage, so nothing reads them again.
    """
    given = spark.conf.get(FREED)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, given)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written as Parquet to the shared folder and read back.

    Cuts lineage like a checkpoint; later readers take only the columns they need, and the shuffle
    files behind the rows go with the write.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
