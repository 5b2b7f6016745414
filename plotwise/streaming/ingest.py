"""Staged files as they arrive: each is read once and folded into the state of its listing."""

from __future__ import annotations

import json

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor

import plotwise
from plotwise import schemas
from plotwise.plans.loaders import DUMP, load, writable
from plotwise.sources.staged import CORRUPT, KINDS, POSITION, dump_glob, from_path, with_split

# Python workers get the processor's module with it.
cloudpickle.register_pickle_by_value(plotwise)

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "listings"
KEY, TIME = "url", "scraped_at"
SPLIT = POSITION[:2]  # the file, and the split's place in it
NAMES = [n for n in schemas.LISTINGS.names if n != KEY]
RANK = "_rank"
HELD_BYTES = 64 << 20  # of rows held in a Python task at a time, as Arrow
PARTS = 8  # tasks that fold a batch's rows, for each that holds states
BUCKET, BUCKETS = "_bucket", 1 << 15  # urls of a bucket share a state; a checkpoint's number of them is fixed
TOLD = "_told"  # the ranks of a kept listing, each once and in order

# Times, dates and VARIANTs are kept as numbers and JSON texts.
_KEPT = {T.TimestampType: T.LongType(), T.DateType: T.IntegerType(), T.VariantType: T.StringType()}
FIELDS = [T.StructField(f.name, _KEPT.get(type(f.dataType), f.dataType)) for f in schemas.LISTINGS if f.name != KEY]
# Beside the values: where each came from, and the latest row of all, as texts that sort.
LISTING = T.StructType([*FIELDS, T.StructField("ranks", T.ArrayType(T.StringType())), T.StructField("newest", T.StringType())])
RANKED = T.StructType([T.StructField(KEY, T.StringType()), *FIELDS, T.StructField(RANK, T.StringType())])
ARRIVING = T.StructType([T.StructField(KEY, T.StringType()), *LISTING.fields])
KEPT = T.StructType([T.StructField(STATE, T.StringType())])  # the listings of a bucket, as JSON


def stream_staged(
    spark: SparkSession, base: str, kind: str = "listings", files_per_batch: int = 1000
) -> DataFrame:
    """New files of any run and portal, with the file's run and portal."""
    schema = T.StructType([*KINDS[kind].fields, T.StructField(CORRUPT, T.StringType())])
    arriving = (
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(dump_glob(base, kind))
    )
    return with_split(from_path(arriving))


def _sortable(number: Column) -> Column:
    return F.lpad((number + F.lit(1 << 61)).cast("string"), 19, "0")


def observed(arriving: DataFrame, now: Column) -> DataFrame:
    """Rows by the dump rules: url, the fields as they are kept, a split, and the start of a rank.

    Rows rank by their time, then by run, file and place in the file; blank texts are NULL.
    """
    rows = writable(load(arriving, DUMP, now, passing=("run", "portal", *SPLIT)), now)
    rows = rows.withColumn("source", F.col("portal"))
    file, at = SPLIT
    split = F.concat_ws("\x01", "run", file, _sortable(F.col(at)))
    values = []
    for field in schemas.LISTINGS:
        if field.name == KEY:
            continue
        value = F.col(field.name) if field.name in rows.columns else F.lit(None).cast(field.dataType)
        if isinstance(field.dataType, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(field.dataType, T.DateType):
            value = F.unix_date(value)
        elif isinstance(field.dataType, T.VariantType):
            value = F.to_json(value)
        elif isinstance(field.dataType, T.StringType):
            value = F.when(F.trim(value) != "", value)
        values.append(value.alias(field.name))
    return rows.select(KEY, *values, split.alias("_split"), _sortable(F.unix_micros(TIME)).alias("_time"))


def folded(held: list | None, row) -> list:
    """Two observations of a listing as one, in either order: each field as its later one says.

    A row is the values of NAMES, their ranks, and the latest rank.
    """
    if held is None:
        return [*row[:-2], list(row[-2]), row[-1]]
    ranks = held[-2]
    for i, rank in enumerate(row[-2]):
        if rank is not None and (ranks[i] is None or rank > ranks[i]):
            held[i], ranks[i] = row[i], rank
    held[-1] = max(held[-1], row[-1])
    return held


def _ranked(batches):
    """The rows with their rank, in the order of their file; a task reads a split whole, from its start."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lines: dict = {}
    for batch in filter(len, batches):
        *columns, split, time = batch.columns
        found = split.dictionary_encode()
        codes, line = found.indices.to_numpy(), np.zeros(len(batch), dtype=np.int64)
        for code, name in enumerate(found.dictionary.to_pylist()):
            at = np.flatnonzero(codes == code)
            line[at] = lines.get(name, 0) + 1 + np.arange(len(at))
            lines[name] = lines.get(name, 0) + len(at)
        place = pc.utf8_lpad(pc.cast(pa.array(line), pa.string()), width=19, padding="0")
        rank = pc.binary_join_element_wise(time, split, place, "\x01", null_handling="replace", null_replacement="None")
        yield pa.RecordBatch.from_arrays([*columns, rank], names=[KEY, *NAMES, RANK])


def _tables(batches):
    """The rows as Arrow tables of about HELD_BYTES."""
    import pyarrow as pa

    held, size = [], 0
    for batch in filter(len, batches):
        held.append(batch)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _last(table, by_url: bool = True):
    """The table in the order of url and rank, where its urls end, and for each url and column of
    NAMES the place of the last row that says something, or -1. Without by_url a row is its own url."""
    import numpy as np
    import pyarrow.compute as pc

    if by_url:
        table = table.take(pc.sort_indices(table, sort_keys=[(KEY, "ascending"), (RANK, "ascending")]))
    at, first = np.arange(len(table)), np.ones(len(table), dtype=bool)
    if by_url:
        code = table[KEY].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        first[1:] = code[1:] != code[:-1]
    start = np.flatnonzero(first)
    end = np.append(start[1:], len(table)) - 1
    last = np.empty((len(end), len(NAMES)), dtype=np.int64)
    for i, name in enumerate(NAMES):
        said = table[name].is_valid().to_numpy()
        last[:, i] = np.maximum.accumulate(np.where(said, at, -1))[end]
    last[last < start[:, None]] = -1
    return table, end, last


def _numbered(fold: bool):
    def run(batches):
        """Rows with their rank. Of a url that comes often in a task only rows that still say something travel."""
        import numpy as np
        import pyarrow.compute as pc

        for table in _tables(_ranked(batches)):
            if fold and 2 * pc.count_distinct(table[KEY]).as_py() < len(table):
                table, end, last = _last(table)
                kept = np.unique(np.append(last, end))
                table = table.take(kept[kept >= 0])
            yield from table.to_batches(max_chunksize=10_000)

    return run


def _observations(fold: bool):
    def run(batches):
        """Rows of ARRIVING: folded, or each row as it is."""
        import numpy as np
        import pyarrow as pa

        schema = to_arrow_schema(ARRIVING)
        for table in _tables(batches):
            table, end, last = _last(table, fold)
            taken = lambda name, at: table[name].combine_chunks().take(pa.array(at, mask=at < 0))
            offsets = pa.array(np.arange(0, last.size + 1, len(NAMES)), pa.int32())
            ranks = pa.ListArray.from_arrays(offsets, taken(RANK, last.ravel()))
            columns = [taken(KEY, end), *[taken(n, last[:, i]) for i, n in enumerate(NAMES)], ranks, taken(RANK, end)]
            folded_rows = pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
            yield from folded_rows.to_batches(max_chunksize=2_000)

    return run


def _as_text(listings: dict) -> str:
    """Listings by url as JSON: the fields that say something; a rank is written once and named by its place."""
    kept = []
    for url, (*values, ranks, newest) in listings.items():
        told = sorted({newest, *(r for r in ranks if r is not None)})
        place = {r: i for i, r in enumerate(told)}
        said = {n: v for n, v in zip(NAMES, values) if v is not None}
        kept.append({KEY: url, **said, "ranks": [place.get(r) for r in ranks], TOLD: told})
    return json.dumps(kept, ensure_ascii=False)


def _from_text(text: str) -> dict:
    """Listings by url, each as folded() takes it."""
    listings = {}
    for kept in json.loads(text):
        told = kept[TOLD]
        ranks = [None if i is None else told[i] for i in kept["ranks"]]
        listings[kept[KEY]] = [*map(kept.get, NAMES), ranks, told[-1]]
    return listings


class ListingState(StatefulProcessor):
    """One state per bucket of urls: of each its fields, where each came from, and the latest row's rank.

    Python asks for a state and gives it back with a call each, which costs far more than what is in it,
    so urls share one. Folding does not depend on the order of arrival, so neither does the table on how files
    become batches. With ignore_late a row older than the listing it meets changes nothing.
    """

    def __init__(self, ignore_late: bool = False):
        self.ignore_late = ignore_late

    def init(self, handle) -> None:
        self.state = handle.getValueState(STATE, KEPT)

    def handleInputRows(self, key, rows, timerValues):
        held = self.state.get()  # one call: asking whether it exists costs as much as reading it
        listings = {} if held is None else _from_text(held[0])
        time = NAMES.index(TIME)
        known = {url: listing[time] for url, listing in listings.items()}
        for row in rows:
            said = json.loads(row[1])
            url, row = said[KEY], [*map(said.get, NAMES), said["ranks"], said["newest"]]
            if self.ignore_late and known.get(url) is not None and row[time] < known[url]:
                continue
            listings[url] = folded(listings.get(url), row)
        if listings:
            self.state.update((_as_text(listings),))
            yield Row(**{BUCKET: key[0]})  # the sink keeps nothing: the table is the states

    def close(self) -> None:
        pass


def ingest_listings(arriving: DataFrame, checkpoint: str, now: Column, ignore_late: bool = False):
    """Start the job: load each batch by the dump rules, fold its rows into the states of the listings.

    The checkpoint holds what was read and the states; a batch that fails is run again
    from the states before it, so nothing counts twice and nothing is lost, and Spark lets one
    writer at a time use a checkpoint. Returns the running query; it ends when all files
    present are in. `listings` reads the table.
    """
    spark = arriving.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    # a batch's rows are folded before they meet the states, a row for a url and batch; late rows are
    # told row by row, so they are not folded
    fold = not ignore_late
    tasks = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = observed(arriving, now).mapInArrow(_numbered(fold), RANKED)
    rows = rows.repartition(tasks, KEY).mapInArrow(_observations(fold), ARRIVING)
    bucket = F.pmod(F.xxhash64(KEY), F.lit(BUCKETS)).cast("int")
    told = rows.select(bucket.alias(BUCKET), F.to_json(F.struct(*ARRIVING.names)).alias("listing"))
    changed = told.groupBy(BUCKET).transformWithState(
        ListingState(ignore_late), T.StructType([T.StructField(BUCKET, T.IntegerType())]), "Update", "None"
    )
    return (
        changed.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def listings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The listings table as the states of the last finished batch hold it."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE).load()
    kept = T.ArrayType(T.StructType([T.StructField(KEY, T.StringType()), *FIELDS]))
    held = held.select(F.inline(F.from_json(f"value.{STATE}", kept, {"mode": "FAILFAST"})))
    columns = [F.col(KEY)]
    for field in schemas.LISTINGS:
        if field.name == KEY:
            continue
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            value = F.timestamp_micros(value)
        elif isinstance(field.dataType, T.DateType):
            value = F.date_from_unix_date(value)
        elif isinstance(field.dataType, T.VariantType):
            value = F.try_parse_json(value)
        columns.append(value.alias(field.name))
    return held.select(*columns)
