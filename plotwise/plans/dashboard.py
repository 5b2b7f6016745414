"""Search, paging and the dashboard's figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plotwise.operators.ranks import exact_median, page_of
from plotwise.session import cut_lineage
from plotwise.sources.tables import SEARCH_COLUMNS

PAGE_SIZE = 25
HISTOGRAM_BINS = 30
RESULT_COLUMNS = (
    "listing_title", "city", "address", "property_type", "price_php", "area_sqm",
    "price_per_sqm", "published_at", "scraped_at", "url",
)


def search_filter(listings: DataFrame, filters: dict | None = None) -> DataFrame:
    """Only the given filters. Empty text and dates do not filter; 0 is a real bound."""
    f = filters or {}
    df = listings
    for column in ("source", "property_type"):
        if f.get(column):
            df = df.where(F.col(column) == f[column])
    for column, name in (("price_php", "price"), ("area_sqm", "area")):
        if f.get(f"min_{name}") is not None:
            df = df.where(F.col(column) >= f[f"min_{name}"])
        if f.get(f"max_{name}") is not None:
            df = df.where(F.col(column) <= f[f"max_{name}"])
    if f.get("published_from"):
        df = df.where(F.col("published_at") >= F.lit(f["published_from"]).cast("timestamp"))
    if f.get("published_to"):
        df = df.where(F.col("published_at") <= F.lit(f["published_to"]).cast("timestamp"))
    if f.get("q"):
        like = f"%{f['q']}%"
        df = df.where(F.col("listing_title").ilike(like) | F.col("description").ilike(like))
    return df


def search_columns(found: DataFrame, extra=()) -> DataFrame:
    """The search page's columns, those of them that the table has."""
    return found.select(*[c for c in dict.fromkeys((*SEARCH_COLUMNS, *extra)) if c in found.columns])


def _newest_first(ties) -> list[Column]:
    return [F.col("scraped_at").desc_nulls_first(), *[F.col(t) for t in ties]]


def search_page(found: DataFrame, after: dict | None = None, per_page: int = PAGE_SIZE, ties=("url",)) -> DataFrame:
    """The rows after a given one, newest scrape first, rows without a time in front.

    `after` holds scraped_at and the ties (not NULL) of the last row of the page before. It
    is a filter, so a page costs one small top-k however deep it lies.
    """
    if after is not None:
        equal, later = F.lit(True), F.lit(False)
        for tie in ties:
            later = later | (equal & (F.col(tie) > F.lit(after[tie])))
            equal = equal & (F.col(tie) == F.lit(after[tie]))
        time, last = F.col("scraped_at"), after["scraped_at"]
        if last is None:
            found = found.where(time.isNotNull() | later)
        else:
            found = found.where((time < F.lit(last)) | ((time == F.lit(last)) & later))
    page = found.orderBy(*_newest_first(ties)).limit(per_page)
    return search_columns(page, ties)


def numbered_page(found: DataFrame, page: int, per_page: int = PAGE_SIZE, ties=("url",)) -> DataFrame:
    """Any page by its number. Rows before it are counted per second, not gathered, ranked or sorted.

    Rows without a time, or of one second, are cut into ranges of the ties where the page lies in them.
    """
    seconds = F.unix_seconds("scraped_at")
    newest = found.agg(F.max(seconds).alias("s")).scalar()
    step = F.coalesce(newest - seconds + 1, F.lit(0))
    ranked = page_of(found.withColumn("_second", step), "_second", _newest_first(ties), (page - 1) * per_page, page * per_page, "_rank")
    return search_columns(ranked.orderBy("_rank").limit(per_page), ties)


def search_total(found: DataFrame) -> DataFrame:
    return found.agg(F.count("*").alias("total"))


def _at_least(column: str, bound: float) -> Column:
    """column >= bound with NULL read as 0, in a form the scan can use."""
    return F.col(column) >= bound if bound > 0 else (F.col(column) >= bound) | F.col(column).isNull()


def _at_most(column: str, bound: float) -> Column:
    return (F.col(column) <= bound) | F.col(column).isNull() if bound >= 0 else F.col(column) <= bound


def dashboard_filter(
    df: DataFrame,
    property_type: str | None = None,
    city: str | None = None,
    price_min: float | None = None,
    price_max: float | None = None,
    area_min: float | None = None,
    area_max: float | None = None,
    published_from=None,
    published_to=None,
) -> DataFrame:
    """The dashboard's filters: type and city are case-insensitive patterns; a missing
    price or area counts as 0, so it passes every maximum."""
    for column, pattern in (("property_type", property_type), ("city", city)):
        if pattern:
            df = df.where(F.coalesce(column, F.lit("")).rlike(f"(?iu){pattern}"))
    if price_min is not None:
        df = df.where(_at_least("price_php", price_min))
    if price_max:
        df = df.where(_at_most("price_php", price_max)) if price_max > 0 else df
    if area_min is not None and area_min > 0:
        df = df.where(_at_least("area_sqm", area_min))
    if area_max is not None and area_max > 0:
        df = df.where(_at_most("area_sqm", area_max))
    if published_from is not None:
        df = df.where(F.col("published_at") >= F.lit(published_from).cast("timestamp"))
    if published_to is not None:
        df = df.where(F.col("published_at") <= F.lit(published_to).cast("timestamp"))
    return df


def kpi_row(df: DataFrame, value: str = "price_per_sqm") -> DataFrame:
    """Listings, exact median and mean of the value, number of cities: one row."""
    frame = cut_lineage(df.select(value, "city"))  # two columns, read by both aggregates
    counts = frame.agg(
        F.count("*").alias("listings"),
        F.avg(value).alias("avg_ppsqm"),
        F.count_distinct("city").alias("cities"),
    )
    middle = exact_median(frame, value).select("median").scalar()
    return cut_lineage(counts.select("listings", middle.alias("median_ppsqm"), "avg_ppsqm", "cities"))


def median_by_city(df: DataFrame, value: str = "price_per_sqm") -> DataFrame:
    """Exact median of the value per city, highest first."""
    return (
        exact_median(df, value, ["city"])
        .select("city", F.col("median").alias("median_ppsqm"))
        .orderBy(F.col("median_ppsqm").desc(), "city")
    )


def value_runs(df: DataFrame, value: str = "price_per_sqm", keys=("city",), day: str | None = None) -> DataFrame:
    """[day,] keys, v, n: how often each value comes; what figures are made of, and what adds up."""
    own = [*([day] if day else []), *keys]
    return df.groupBy(*own, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))


def add_runs(total: DataFrame, new: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """Runs with a day's added, and what the day said before taken off. History is not read.

    Runs are one row per value of a city, so they grow with the values, not with the days.
    """
    keys = [c for c in total.columns if c != "n"]
    both = total.unionByName(new.select(*total.columns))
    if old is not None:
        both = both.unionByName(old.select(*keys, (-F.col("n")).alias("n")))
    return both.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def kpi_of_runs(runs: DataFrame) -> DataFrame:
    """kpi_row of the rows that the runs stand for."""
    counts = runs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("listings"),
        (F.sum(F.col("v") * F.col("n")) / F.sum(F.when(F.col("v").isNotNull(), F.col("n")))).alias("avg_ppsqm"),
        F.count_distinct("city").alias("cities"),
    )
    middle = exact_median(runs, "v", weight="n").select("median").scalar()
    return cut_lineage(counts.select("listings", middle.alias("median_ppsqm"), "avg_ppsqm", "cities"))


def median_by_city_of_runs(runs: DataFrame) -> DataFrame:
    """median_by_city of the rows that the runs stand for."""
    medians = exact_median(runs, "v", ["city"], weight="n")
    return medians.select("city", F.col("median").alias("median_ppsqm")).orderBy(F.col("median_ppsqm").desc(), "city")


def listings_by_month(df: DataFrame) -> DataFrame:
    """Listings per month of publication; months without any are absent."""
    return (
        df.where("published_at is not null")
        .groupBy(F.date_trunc("month", "published_at").cast("date").alias("month"))
        .agg(F.count("*").alias("listings"))
        .orderBy("month")
    )


def histogram(df: DataFrame, value: str = "price_per_sqm", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest value.

    The one column is worked out once and checkpointed; the bounds come from one aggregate
    on it, read as a scalar. Empty bins are absent.
    """
    values = cut_lineage(df.select(F.col(value).alias("v")).where("v is not null"))
    bounds = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("b")).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    place = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    counted = (
        values.select(F.when(hi > lo, place).otherwise(F.lit(0)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("listings"))
    )
    width = (hi - lo) / bins
    return counted.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_from"),
        F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * width).alias("bin_to"),
        "listings",
    ).orderBy("bin")


def top_listings(df: DataFrame, page_size: int = PAGE_SIZE, ties=("url",)) -> DataFrame:
    """The result table: newest publication first, unpublished rows last."""
    columns = [c for c in RESULT_COLUMNS if c in df.columns]
    order = [F.col("published_at").desc_nulls_last(), *[F.col(t) for t in ties]]
    extra = [t for t in ties if t not in columns]
    return df.select(*columns, *extra).orderBy(*order).limit(page_size)
