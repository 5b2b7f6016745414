"""Listing data derived from the given tables: in Spark, and as SQL for the oracles.

One lineitem row is one observation of a listing, its part is the listing. The rules
below make the NULLs, currencies and texts the given tables lack.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plotwise.functions.amounts import peso_price, per_sqm
from plotwise.functions.urls import canonical_url
from plotwise.session import file_system, tune, widen

TIES = ("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
CITY = r"(NATION_[0-9]+)"
RUN_STAMP = "2024-06-01 00:00:00"  # the jobs' "now"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


PART_BYTES = 8 << 20  # of the files of a spread table for one partition


def spread(df: DataFrame, times: int = 1) -> DataFrame:
    """The given files hold one row group each; a stored table of that size would have more.

    Partitions grow in number with the bytes of the files that the rows come from, not in size;
    those of later shuffles too. `times` says how much larger a row's bytes become.
    """
    spark, size = df.sparkSession, 0
    for path in df.inputFiles():
        files, place = file_system(spark, unquote(path))
        size += files.getFileStatus(place).getLen()
    size *= times
    widen(spark, size)
    return df.repartition(max(8, -(-size // PART_BYTES)))


def now() -> Column:
    return F.lit(RUN_STAMP).cast("timestamp")


def ts_text(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def r6(c) -> Column:
    return F.round(c, 6)


def observations(
    spark: SparkSession, sf_dir: str, part=True, address=False, published=False
) -> DataFrame:
    """listing_obs. Only the joins a query needs: an inner join is never dropped."""
    df = spread(table(spark, sf_dir, "lineitem")).withColumn(
        "raw_url",
        F.concat(
            F.lit("https://p.example.com/property/"),
            F.col("l_partkey").cast("string"),
            F.lit("/?ref="),
            F.col("l_linenumber").cast("string"),
        ),
    )
    columns = {
        "url": canonical_url(F.col("raw_url")),
        "price_value": F.col("l_extendedprice"),
        "price_currency": F.when(F.col("l_returnflag") == "N", "PHP").when(
            F.col("l_returnflag") != "A", "USD"
        ),
        "scraped_at": F.col("l_shipdate").cast("timestamp"),
        "source": F.col("l_linestatus"),
    }
    if part:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        columns |= {
            "listing_title": F.col("p_name"),
            "property_type": F.col("p_type"),
            "area_sqm": F.when(F.col("l_linenumber") != 7, F.col("p_size").cast("double")),
        }
    if address:
        places = (
            table(spark, sf_dir, "supplier")
            .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", F.concat_ws(", ", "n_name", "r_name").alias("address"))
        )
        df = df.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    if published:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        columns["published_at"] = F.when(
            F.col("l_linenumber") != 6, F.col("o_orderdate").cast("timestamp")
        )
    df = df.withColumns(columns)
    if part:
        df = df.withColumn("price_php", peso_price(F.col("price_value"), F.col("price_currency"), "lenient"))
        df = df.withColumn("price_per_sqm", per_sqm(F.col("price_php"), F.col("area_sqm")))
    return df


OBS = r"""
obs0 AS (
  SELECT l.*, 'https://p.example.com/property/' || l_partkey || '/?ref=' || l_linenumber AS raw_url,
         'https://p.example.com/property/' || l_partkey AS url,
         l_extendedprice AS price_value,
         CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN 'PHP' ELSE 'USD' END AS price_currency,
         l_shipdate AS scraped_at, l_linestatus AS source, p_partkey, p_size,
         p_name AS listing_title, p_type AS property_type,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS area_sqm,
         n_name || ', ' || r_name AS address, n_name AS city,
         CASE WHEN l_linenumber = 6 THEN NULL ELSE o_orderdate END AS published_at
  FROM lineitem l JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey LEFT JOIN orders ON o_orderkey = l_orderkey),
obs1 AS (
  SELECT *, CASE WHEN price_currency IS NULL OR price_currency = 'PHP' THEN price_value END AS price_php
  FROM obs0),
obs AS (
  SELECT *, CASE WHEN area_sqm > 0 THEN price_php / area_sqm END AS price_per_sqm FROM obs1)
"""
