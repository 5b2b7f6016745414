"""Rows clustered along a space-filling curve, and a manifest that says which files a filter needs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plotwise.session import stored

BITS = 8  # of each column's place on the curve
ROWS_PER_FILE = 1_000_000
TASKS, FILES_A_TASK = 64, 64  # ranges are written by 64 tasks, more where each would write over 64 files
ERROR = 0.002  # of the quantiles that bound a column's places


def _number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    return value.cast("double")


def _place(value: Column, bounds: list[float]) -> Column:
    """How many of the sorted bounds lie below a value; 0 for NULL. A step halves what is left of them."""
    array = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
    halves = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(bounds).bit_length()))] or [F.lit(1)])
    found = F.aggregate(
        halves, F.lit(0), lambda at, half: at + F.when(F.get(array, at + half - 1) < value, half).otherwise(F.lit(0))
    )
    return found.cast("long")


def curve(df: DataFrame, columns: list[str]) -> Column:
    """A row's number on the Z-order curve of the columns, each cut into 256 parts of equal share.

    The bounds of the parts are approximate quantiles: 255 numbers a column, whatever the data.
    """
    numbers = {c: _number(df, c) for c in columns}
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    found = df.select(*[v.alias(c) for c, v in numbers.items()]).approxQuantile(columns, shares, ERROR)
    places = [_place(numbers[c], sorted(b)) for c, b in zip(columns, found)]  # equal bounds count each

    def dealt(place: Column, i: int) -> Column:
        def bits(p: Column) -> Column:
            one = [F.shiftleft(F.shiftright(p, bit).bitwiseAND(F.lit(1)), bit * len(places) + i) for bit in range(BITS)]
            return reduce(lambda a, b: a.bitwiseOR(b), one)

        # the array's one member gives the place a name, so it is looked up once, not for each bit
        return F.get(F.transform(F.array(place), bits), F.lit(0))

    bits = [dealt(place, i) for i, place in enumerate(places)]
    # rows that lack a column lie by themselves: no range of it needs them
    gaps = [F.shiftleft(numbers[c].isNull().cast("long"), BITS * len(places) + i) for i, c in enumerate(columns)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits + gaps)


def write_clustered(df: DataFrame, columns: list[str], path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Rows by range of the curve under path/rows, and what each file holds of the columns under path/manifest.

    Rows near in all columns share a file, so a filter on any of them leaves most files out.
    """
    spark = df.sparkSession
    df = stored(df, "to-cluster")  # read by the count, the quantiles, the ranges' bounds and the write
    files = max(1, -(-df.count() // rows_per_file))
    placed = df.withColumn("_z", curve(df, columns))
    ranges = placed.repartitionByRange(max(1, min(files, max(TASKS, -(-files // FILES_A_TASK)))), "_z").sortWithinPartitions("_z").drop("_z")
    ranges.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    kept = spark.read.parquet(f"{path}/rows").withColumn("_file", F.col("_metadata.file_path"))
    bounds = [f(_number(df, c)).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    gaps = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    kept.groupBy("_file").agg(*bounds, *gaps, F.count("*").alias("rows")).write.parquet(f"{path}/manifest")


def files_for(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> list[str]:
    """Files that may hold rows within the inclusive ranges (None: open on that side); NULLs are in no range.

    The manifest has a row per file.
    """
    manifest = spark.read.parquet(f"{path}/manifest")
    for column, (low, high) in ranges.items():
        if low is not None:
            manifest = manifest.where(F.col(f"max_{column}") >= F.lit(float(low)))
        if high is not None:
            manifest = manifest.where(F.col(f"min_{column}") <= F.lit(float(high)))
    return sorted(r["_file"] for r in manifest.select("_file").collect())


def read_clustered(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> DataFrame:
    """The files that the ranges need, and no others; filter the rows as usual."""
    schema = spark.read.parquet(f"{path}/rows").schema
    files = files_for(spark, path, ranges)
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
