"""Staged JSON-lines files: what discovery and detail jobs hand to the loaders.

Two layouts are read. `run_<stamp>/staged/<portal>_<kind>.jsonl` is how existing dumps
lie; our own sink writes `<kind>/run=<stamp>/portal=<name>/` so that many tasks can
write one portal and a re-run replaces exactly its own partition.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plotwise import schemas
from plotwise.functions.text import empty_to_null
from plotwise.session import file_system, shuffles_freed

CORRUPT = "_corrupt"
DUMP_PATH = r"run_([^/]+)/staged/([^/]+)_(urls|listings|failures)\.jsonl"
KINDS = {
    "urls": schemas.STAGED_URLS,
    "listings": schemas.STAGED_LISTINGS,
    "failures": schemas.STAGED_FAILURES,
}


def _json(spark: SparkSession, schema: T.StructType):
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(with_bad).option("columnNameOfCorruptRecord", CORRUPT)


POSITION = ("_file", "_at", "_line")


def with_split(df: DataFrame) -> DataFrame:
    """A row's file, and its split's place in the file."""
    return df.withColumns(
        {"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.file_block_start")}
    )


def with_position(df: DataFrame) -> DataFrame:
    """Where a row stood: its file, its split's place in the file, its place in the split.

    Compared as order columns these give the input order, however splits become tasks:
    Spark's row numbers rise within a split. A stream gets the split as it is read and the
    row number in its batch.
    """
    split = df if "_file" in df.columns else with_split(df)
    return split.withColumn("_line", F.monotonically_increasing_id())


def corrupt_line() -> Column:
    """The corrupt-record column, tied to a second column: Spark refuses to read it alone."""
    return F.coalesce(F.col(CORRUPT), F.nullif(F.substring("url", 1, 0), F.lit("")))


def from_path(df: DataFrame) -> DataFrame:
    """Add run and portal, taken from the file's path."""
    path = F.col("_metadata.file_path")
    return df.withColumns(
        {
            "run": F.regexp_extract(path, DUMP_PATH, 1),
            "portal": F.regexp_extract(path, DUMP_PATH, 2),
            CORRUPT: corrupt_line(),
        }
    )


def dump_glob(base: str, kind: str, portal: str = "*", run: str = "*") -> str:
    return f"{base}/run_{run}/staged/{portal}_{kind}.jsonl"


def read_dumps(spark: SparkSession, base: str, kind: str, portal: str = "*") -> DataFrame:
    """Every run's files as one scan, duplicates kept, with run and portal columns.

    A line that is not a JSON object is kept in the _corrupt column; a line that is a
    list of objects counts as those objects.
    """
    return from_path(_json(spark, KINDS[kind]).json(dump_glob(base, kind, portal)))


def latest_dump_paths(
    spark: SparkSession, base: str, kind: str, portal: str = "*"
) -> dict[str, str]:
    """Each portal's newest file. Only names are listed: no file is opened.

    The names fold to one per portal in Spark; portals are as many as the registry has.
    """
    try:
        files = spark.read.format("binaryFile").load(dump_glob(base, kind, portal))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    listed = files.select(
        F.regexp_extract("path", DUMP_PATH, 1).alias("run"),
        F.regexp_extract("path", DUMP_PATH, 2).alias("portal"),
        # a file, or the folder a Spark job wrote under that name
        F.regexp_extract("path", rf"^(.*{DUMP_PATH})", 1).alias("path"),
    )
    newest = listed.groupBy("portal").agg(F.max_by("path", "run").alias("path"))
    return {r["portal"]: r["path"] for r in newest.collect()}


def read_latest_dumps(spark: SparkSession, base: str, kind: str, portal: str = "*") -> DataFrame:
    paths = latest_dump_paths(spark, base, kind, portal)
    if not paths:
        raise FileNotFoundError(f"no {kind} file of portal {portal!r} in any run under {base}")
    return from_path(_json(spark, KINDS[kind]).json(sorted(paths.values())))


def latest_run(df: DataFrame, portal: str = "portal", run: str = "run") -> DataFrame:
    """Rows of each portal's last run, for data already in one table.

    The run of a portal folds before the shuffle and the list of runs is tiny, so Spark
    broadcasts it on its measured size.
    """
    newest = df.groupBy(portal).agg(F.max(run).alias(run))
    return df.join(newest, [portal, run], "left_semi")


def only_objects(df: DataFrame) -> DataFrame:
    """Rows that came from a JSON object line."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def named_urls(df: DataFrame) -> DataFrame:
    """Staged URLs with an address; duplicates are kept."""
    return df.where(empty_to_null(F.col("url")).isNotNull())


# --- sinks --------------------------------------------------------------------


def write_staged(df: DataFrame, path: str, ran: DataFrame | None = None) -> None:
    """Replace the (run, portal) partitions present in df; others stay. Files are gzipped JSON lines.

    `ran` names the (run, portal) that were worked on: those without rows are cleared, so
    nothing of an earlier try is left. They are as many as the registry has portals.
    """
    keys = ["run", "portal"]
    with shuffles_freed(df.sparkSession):
        (
            df.hint("rebalance", *[F.col(k) for k in keys])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "gzip")
            .partitionBy(*keys)
            .json(path)
        )
    if ran is None:
        return
    empty = ran.select(*keys).distinct().join(df.select(*keys).distinct(), keys, "left_anti")
    for row in empty.collect():
        files, place = file_system(df.sparkSession, f"{path}/run={row['run']}/portal={row['portal']}")
        files.delete(place, True)


def write_staged_urls(
    urls: DataFrame, base: str, discovered_at: Column, ran: DataFrame | None = None
) -> None:
    staged = urls.select(
        "url", discovered_at.cast("string").alias("discovered_at"), "run", "portal"
    )
    write_staged(staged, f"{base}/urls", ran)


def urls_of_run(spark: SparkSession, base: str, portal: str, run: str) -> DataFrame:
    """A portal's URLs staged by this run if it has a file, else those of every run."""
    own = dump_glob(base, "urls", portal, run)
    try:
        chosen = from_path(_json(spark, KINDS["urls"]).json(own))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        chosen = read_dumps(spark, base, "urls", portal)
    return named_urls(only_objects(chosen))


def read_staged(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """Our own layout; run and portal are partition columns, so filters prune files."""
    keys = [T.StructField(k, T.StringType()) for k in ("run", "portal")]
    schema = T.StructType([*KINDS[kind].fields, T.StructField(CORRUPT, T.StringType()), *keys])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(f"{base}/{kind}").withColumn(CORRUPT, corrupt_line())
