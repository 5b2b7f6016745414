"""Substring search by trigrams: postings say which rows may match, the pattern decides.

A search for `%q%`, case aside, needs every run of three characters between the wildcards
of q. Postings list, for each field and trigram, the rows that hold it, in blocks of rows;
rows on the lists of all trigrams are read and tested, others are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plotwise.session import stored

BLOCK = 1 << 16  # rows of a block: a list of a block's rows is at most that long
GRAM = 3
LISTED_BLOCKS = 1000  # so many blocks are named to the scan


def literal_parts(pattern: str) -> list[str]:
    """The runs of characters of a LIKE pattern that stand for themselves."""
    parts, own, escaped = [], "", False
    for c in pattern:
        if escaped:
            own, escaped = own + c, False
        elif c == "\\":
            escaped = True
        elif c in "%_":
            parts, own = [*parts, own], ""
        else:
            own += c
    return [p for p in [*parts, own] if p]


def write_index(rows: DataFrame, fields: list[str], path: str, block: int = BLOCK) -> None:
    """Rows by block under path/rows, their postings by field and trigram under path/postings.

    A row's number is given once, when it is written. Postings lie by range of trigram, so a search
    opens the few files that hold its own. No list is longer than a block, however many rows
    hold a trigram.
    """
    spark = rows.sparkSession
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    numbered = numbered.withColumn("_block", F.floor(F.col("_row") / block).cast("long"))
    numbered.write.partitionBy("_block").parquet(f"{path}/rows")
    kept = spark.read.parquet(f"{path}/rows")
    grams = None
    for field in fields:
        # a look ahead finds overlapping runs in one pass over a text of any length
        found = F.regexp_extract_all(F.lower(field), F.lit(rf"(?s)(?=(.{{{GRAM}}}))"), F.lit(1))
        each = kept.select(F.lit(field).alias("field"), F.explode(F.array_distinct(found)).alias("gram"), "_block", "_row")
        grams = each if grams is None else grams.unionByName(each)
    lists = grams.groupBy("field", "gram", "_block").agg(F.sort_array(F.collect_list("_row")).alias("rows"))
    lists.repartitionByRange("gram", "field", "_block").sortWithinPartitions("gram", "field", "_block").write.parquet(f"{path}/postings")


def search_grams(spark: SparkSession, q: str) -> list[str]:
    """The trigrams that a text must hold, lower-cased as the search does it."""
    lower = spark.range(1).select(F.lower(F.lit(q)).alias("q")).first()["q"]
    return sorted({p[i : i + GRAM] for p in literal_parts(lower) for i in range(len(p) - GRAM + 1)})


def candidates(spark: SparkSession, path: str, q: str, fields: list[str]) -> DataFrame | None:
    """_block, _row of the rows that hold every trigram of q in one field; None if q has none."""
    grams = search_grams(spark, q)
    if not grams:
        return None
    lists = spark.read.parquet(f"{path}/postings").where(F.col("gram").isin(grams) & F.col("field").isin(fields))
    each = lists.groupBy("field", "_block").agg(F.collect_list("rows").alias("lists")).where(F.size("lists") == len(grams))
    both = F.aggregate(F.slice("lists", 2, F.size("lists")), F.get("lists", F.lit(0)), F.array_intersect)
    return each.select("_block", F.explode(both).alias("_row")).distinct()


def search(spark: SparkSession, path: str, q: str, fields: list[str]) -> DataFrame:
    """The rows of an index in which a field holds q, case aside; % and _ in q are wildcards.

    The same rows as a scan with ilike finds. Without three characters in a row the index
    says nothing, and all rows are read.
    """
    rows = spark.read.parquet(f"{path}/rows")
    columns = [c for c in rows.columns if c not in ("_row", "_block")]
    found = candidates(spark, path, q, fields)
    if found is not None:
        found = stored(found, "candidates")
        blocks = [r["_block"] for r in found.select("_block").distinct().limit(LISTED_BLOCKS + 1).collect()]
        if len(blocks) <= LISTED_BLOCKS:
            rows = rows.where(F.col("_block").isin(blocks))
        rows = rows.join(found, ["_block", "_row"], "left_semi")
    hit = F.lit(False)
    for field in fields:
        hit = hit | F.coalesce(F.col(field).ilike(f"%{q}%"), F.lit(False))
    return rows.where(hit).select(*columns)
