"""What the operators of this package share on the Spark side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plotwise.session import scratch_path, shuffles_freed

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; the fast lower() serves texts of ASCII only."""
    plain = F.char_length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the folder all executors share and read back.

    Cuts lineage so that a lost executor costs a re-read only. The files go when the
    application ends, those of the shuffles behind them with the write.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW_BYTES = 4 << 20  # of a batch that goes to a Python worker; one row at least
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_arrow(df: DataFrame, read, schema) -> DataFrame:
    """mapInArrow in batches of bounded bytes, unless the session bounds them itself.

    A batch of 10,000 rows may be large: it is held by the executor and its worker, on both ways.
    """
    conf = df.sparkSession.conf
    conf.set(BATCH_BYTES, conf.get(BATCH_BYTES, str(ARROW_BYTES)))
    return df.mapInArrow(read, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_row_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with equal keys the one with the largest hash, its columns unchanged."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    parts = [F.to_json(F.struct(c)) for c in columns]
    picked = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max_by(F.struct(*columns), F.xxhash64(*parts)).alias("_one"))
    return picked.select("_one.*")
