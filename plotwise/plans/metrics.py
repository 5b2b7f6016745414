"""Market metrics: days on market, price per square metre by day, its growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from plotwise.session import shuffles_freed

GROWTH_ROWS = 7


def first_last_seen(observations: DataFrame, day: str = "as_of_date") -> DataFrame:
    """First and last day each url was seen."""
    return observations.groupBy("url").agg(F.min(day).alias("first_seen"), F.max(day).alias("last_seen"))


def fold_sightings(snapshots: DataFrame, days: list, path: str, key: str = "listing_id", seen: str = "seen_at") -> None:
    """Add the first and last sightings of some days' snapshots to those kept under a path.

    Only the partitions of these days are read. Smallest and largest days are a lattice: a day
    that is written again and folded again changes nothing it does not widen, in any order.
    """
    fresh = snapshots.where(F.col("day").isin(days)).withColumn("_day", F.to_date(seen))
    folded = fresh.groupBy(key).agg(F.min("_day").alias("first_seen"), F.max("_day").alias("last_seen"))
    with shuffles_freed(folded.sparkSession):
        folded.write.mode("append").parquet(path)


def sightings(spark: SparkSession, path: str, key: str = "listing_id") -> DataFrame:
    """First and last day of each listing, of all folds; one row per listing and fold is read."""
    folds = spark.read.parquet(path)
    return folds.groupBy(key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def days_on_market(first: DataFrame, last: DataFrame) -> DataFrame:
    """Average and median days between first and last sighting, both counted.

    Both sides are keyed by url. The days fold to one row per length, of which a
    calendar has few, so the exact median needs no large group.
    """
    span = first.join(last, "url").select(
        (F.date_diff("last_seen", "first_seen") + 1).alias("dom")
    )
    return _days_summary(span)


def days_on_market_of(observations: DataFrame, day: str = "as_of_date") -> DataFrame:
    """The same from observations: one aggregate gives both days, no join."""
    seen = first_last_seen(observations, day)
    return _days_summary(seen.select((F.date_diff("last_seen", "first_seen") + 1).alias("dom")))


def _days_summary(span: DataFrame) -> DataFrame:
    lengths = span.where("dom is not null").groupBy("dom").agg(F.count("*").alias("n"))
    return lengths.agg(
        (F.sum(F.col("dom") * F.col("n")) / F.sum("n")).alias("avg_dom_days"),
        F.percentile("dom", 0.5, F.col("n")).alias("median_dom_days"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("listings_count"),
    )


def daily_ppsqm(listings: DataFrame) -> DataFrame:
    """Average price per square metre of each day. Order it where it is shown: growth sorts anyway."""
    priced = listings.where(F.col("price_per_sqm") > 0)
    return priced.groupBy("as_of_date").agg(F.avg("price_per_sqm").alias("avg_ppsqm"))


def _growth(now, before):
    return F.when(before != 0, (now - before) / before * 100.0)


def ppsqm_growth(daily: DataFrame, rows: int = GROWTH_ROWS) -> DataFrame:
    """Percent change against the row `rows` rows earlier; gaps in the days shorten it.

    The window has no key on purpose: its input has one row per day.
    """
    earlier = F.lag("avg_ppsqm", rows).over(W.orderBy(F.col("as_of_date").asc_nulls_last()))
    return daily.withColumn("_before", earlier).select(
        "as_of_date", "avg_ppsqm", _growth(F.col("avg_ppsqm"), F.col("_before")).alias("growth_pct")
    )


def ppsqm_growth_by_calendar(daily: DataFrame, days: int = GROWTH_ROWS) -> DataFrame:
    """Percent change against the same series `days` calendar days earlier."""
    earlier = daily.select(
        F.date_add("as_of_date", days).alias("as_of_date"), F.col("avg_ppsqm").alias("_before")
    )
    return daily.join(earlier, "as_of_date", "left").select(
        "as_of_date", "avg_ppsqm", _growth(F.col("avg_ppsqm"), F.col("_before")).alias("growth_pct")
    )
