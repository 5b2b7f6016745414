"""A Spark data source for staged runs: `run_<stamp>/staged/<portal>_<kind>.jsonl` as lines.

    spark.dataSource.register(StagedRuns)
    spark.read.format("staged_runs").option("kind", "urls").load(base)

Planning lists names and opens no file. Filters on run and portal choose files; with the
option `run`, a portal that has no file in that run is read from all of its runs. Each file is
a partition, a large one several. A line comes as text with its place; Spark's own JSON
functions read it (`records`).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition

import plotwise
from plotwise.functions.text import empty_to_null
from plotwise.sources.staged import CORRUPT, KINDS

# Python workers get the reader's module with it.
cloudpickle.register_pickle_by_value(plotwise)

NAME = "staged_runs"
LINES = "run string, portal string, file string, at long, value string"
SPLIT_BYTES = 128 << 20  # of a file for one partition
READ_BYTES = 4 << 20  # of a file held at a time
PATH = re.compile(r"/run_([^/]+)/staged/([^/]+)_(urls|listings|failures)\.jsonl(?:/part-[^/]*)?$")


@dataclass(frozen=True)
class Split(InputPartition):
    """The lines that begin in a range of bytes of a file."""

    run: str
    portal: str
    file: str
    start: int
    end: int


@dataclass(frozen=True)
class File:
    run: str
    portal: str
    path: str
    size: int
    changed: int  # nanoseconds


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def listed(base: str, kind: str, runs: set[str] | None = None, portals: set[str] | None = None) -> list[File]:
    """Files of a kind in the folders of the runs, by run and portal. Folders of other runs are not listed."""
    from pyarrow import fs

    store, root = _store(base)
    found = []
    for folder in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        run = folder.base_name.removeprefix("run_")
        if run == folder.base_name or (runs is not None and run not in runs):
            continue
        for info in store.get_file_info(fs.FileSelector(f"{folder.path}/staged", recursive=True, allow_not_found=True)):
            m = PATH.search(info.path)
            if info.is_file and m and m[3] == kind and (portals is None or m[2] in portals):
                found.append(File(m[1], m[2], info.path, info.size, info.mtime_ns or 0))
    return sorted(found, key=lambda f: (f.run, f.portal, f.path))


def chosen(files: list[File], run: str) -> list[File]:
    """A portal's files of the run if it has any, else those of all its runs."""
    own = {f.portal for f in files if f.run == run}
    return [f for f in files if f.run == run or f.portal not in own]


def splits(files: list[File], most: int) -> list[Split]:
    return [Split(f.run, f.portal, f.path, a, min(a + most, f.size)) for f in files for a in range(0, f.size, most)]


def lines_of(base: str, split: Split):
    """(place, line) of the lines that begin in the split; a line that began before it is not its own."""
    store, _ = _store(base)
    with store.open_input_file(split.file) as f:
        # a line belongs to the split its first byte lies in; from the byte before, the first
        # mark ends the line that is another's
        at = max(split.start - 1, 0)
        f.seek(at)
        held, place, skipping = b"", 0, split.start > 0
        while at < split.end:
            cut = held.find(b"\n", place)
            while cut < 0:
                more = f.read(READ_BYTES)
                if not more:
                    break
                held, place, searched = held[place:] + more, 0, len(held) - place
                cut = held.find(b"\n", searched)
            line = held[place:] if cut < 0 else held[place:cut]
            place = len(held) if cut < 0 else cut + 1
            if cut < 0 and not line:
                return
            if not skipping:
                yield at, line
            skipping = False
            at += len(line) + 1


class _Reader:
    """What the batch and the stream reader share: how a split becomes Arrow batches."""

    def __init__(self, options: dict):
        self.base, self.kind = options["path"].rstrip("/"), options.get("kind", "listings")
        self.run = options.get("run")
        self.most = int(options.get("split_bytes", SPLIT_BYTES))

    def read(self, split: Split):
        import pyarrow as pa

        def batch(rows):
            n = len(rows)
            names = [[v] * n for v in (split.run, split.portal, split.file)]
            texts = [line.rstrip(b"\r").decode("utf-8", "replace") for _, line in rows]
            return pa.RecordBatch.from_arrays(
                [*[pa.array(v, pa.string()) for v in names], pa.array([at for at, _ in rows], pa.int64()), pa.array(texts, pa.string())],
                names=["run", "portal", "file", "at", "value"],
            )

        held, size = [], 0
        for at, line in lines_of(self.base, split):
            if line.strip():
                held.append((at, line))
                size += len(line)
            if size >= READ_BYTES:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)


class RunsReader(_Reader, DataSourceReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.asked: dict[str, set[str] | None] = {"run": None, "portal": None}

    def pushFilters(self, filters):
        """Equality and lists of runs and portals are answered by the choice of files."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            # with a fallback, what a run filter leaves must not change what the choice sees
            if name not in self.asked or (name == "run" and self.run):
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            before = self.asked[name]
            self.asked[name] = values if before is None else before & values

    def partitions(self):
        files = listed(self.base, self.kind, self.asked["run"], self.asked["portal"])
        # a query without any file still has a partition
        return splits(chosen(files, self.run) if self.run else files, self.most) or [Split("", "", "", 0, 0)]

    def read(self, split):
        return super().read(split) if split.end else iter(())


class RunsStream(_Reader, DataSourceStreamReader):
    """Files in the order they were finished: the offset is the last one's time and path."""

    def _files(self) -> list[File]:
        return sorted(listed(self.base, self.kind), key=lambda f: (f.changed, f.path))

    def initialOffset(self):
        return {"changed": 0, "path": ""}

    def latestOffset(self):
        files = self._files()
        return {"changed": files[-1].changed, "path": files[-1].path} if files else self.initialOffset()

    def partitions(self, start, end):
        first, last = ((o["changed"], o["path"]) for o in (start, end))
        return splits([f for f in self._files() if first < (f.changed, f.path) <= last], self.most)

    def commit(self, end):
        pass


class StagedRuns(DataSource):
    """Options: path, kind (urls, listings or failures), run (prefer its files), split_bytes."""

    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return LINES

    def reader(self, schema):
        return RunsReader(dict(self.options))

    def streamReader(self, schema):
        return RunsStream(dict(self.options))


def read_lines(spark: SparkSession, base: str, kind: str, run: str | None = None, **options) -> DataFrame:
    """Lines of staged files with run, portal, file and place in it; see StagedRuns."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StagedRuns)
    reader = spark.read.format(NAME).options(kind=kind, **options)
    return (reader.option("run", run) if run else reader).load(base)


def stream_lines(spark: SparkSession, base: str, kind: str, **options) -> DataFrame:
    spark.dataSource.register(StagedRuns)
    return spark.readStream.format(NAME).options(kind=kind, **options).load(base)


def records(lines: DataFrame, kind: str) -> DataFrame:
    """The fields of each line beside its run, portal and place; a line that is no object is kept as corrupt."""
    schema = T.StructType([*KINDS[kind].fields, T.StructField(CORRUPT, T.StringType())])
    # a list counts as no record here; Spark's option keeps the text of what it cannot read
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    is_object = F.ltrim("value").startswith("{")
    read = lines.withColumn("_read", F.when(is_object, parsed)).select("run", "portal", "file", "at", "value", "_read.*")
    return read.withColumn(CORRUPT, F.when(is_object, F.col(CORRUPT)).otherwise(F.col("value"))).drop("value")


def run_urls(spark: SparkSession, base: str, run: str, portals: list[str] | None = None) -> DataFrame:
    """Each portal's staged URLs of the run, or of all runs where it has none; duplicates kept."""
    lines = read_lines(spark, base, "urls", run)
    if portals is not None:
        lines = lines.where(F.col("portal").isin(portals))
    rows = records(lines, "urls").where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return rows.where(empty_to_null(F.col("url")).isNotNull())
