"""Listings, captured pages, the portal registry, and the plain table sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from plotwise import schemas
from plotwise.functions.amounts import is_object
from plotwise.functions.text import city_of, empty_to_null, to_number

# The columns the dashboard and the search page read.
DASHBOARD_COLUMNS = (
    "url", "listing_title", "address", "property_type", "price_php", "area_sqm",
    "price_per_sqm", "published_at", "scraped_at",
)
SEARCH_COLUMNS = (
    "id", "url", "listing_title", "price_php", "area_sqm", "price_per_sqm", "address",
    "property_type", "published_at", "scraped_at",
)


def read_pages_table(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages; html is NULL or empty where the fetch failed."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def dashboard_listings(listings: DataFrame, source: str, city_pattern: str | None = None) -> DataFrame:
    """The dashboard's columns of one source, coerced, with a city.

    The equality filter and the column list reach the Parquet scan.
    """
    own_city = ["city"] if "city" in listings.columns else []
    picked = listings.where(F.col("source") == source).select(*DASHBOARD_COLUMNS, *own_city)
    coerced = picked.withColumns(
        {
            **{c: as_timestamp(picked, c) for c in ("published_at", "scraped_at")},
            **{c: as_number(picked, c) for c in ("price_php", "area_sqm", "price_per_sqm")},
        }
    )
    return coerced if own_city else coerced.withColumn("city", city_of(F.col("address"), city_pattern))


def as_timestamp(df: DataFrame, column: str):
    text = isinstance(df.schema[column].dataType, T.StringType)
    return F.try_to_timestamp(column) if text else F.col(column).cast("timestamp")


def as_number(df: DataFrame, column: str):
    text = isinstance(df.schema[column].dataType, T.StringType)
    return (
        to_number(F.col(column))
        if text
        else F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    )


# --- portal registry ----------------------------------------------------------

# What a portal entry leaves out.
PORTAL_DEFAULTS = {"rate_limit_delay": 1.0, "max_retries": 3, "timeout": 30, "max_pages": 200}


def registry_entries(documents: DataFrame, text: str = "value") -> DataFrame:
    """One VARIANT per entry: {"portals": [...]}, a bare list or a single entry."""
    doc = F.try_parse_json(text)
    listed = F.try_variant_get(doc, "$.portals", "array<variant>")
    bare = F.try_variant_get(doc, "$", "array<variant>")
    single = F.when(is_object(doc), F.array(doc))
    return documents.select(F.posexplode(F.coalesce(listed, bare, single)).alias("position", "portal"))


def read_registry_entries(spark: SparkSession, path: str) -> DataFrame:
    return registry_entries(spark.read.text(path, wholetext=True))


def portals(entries: DataFrame, names: list[str] | DataFrame | None = None) -> DataFrame:
    """Typed registry entries with defaults; only the named ones if names are given, as a
    list or as a table with a portal_name column."""
    typed = entries.select(
        *[
            F.try_variant_get("portal", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
            for f in schemas.PORTAL
        ]
    )
    filled = typed.withColumns(
        {k: F.coalesce(k, F.lit(v)) for k, v in PORTAL_DEFAULTS.items()}
        | {
            "respect_robots": F.coalesce("respect_robots", F.lit(False)),
            "detail_selectors": F.coalesce(
                "detail_selectors", F.create_map().cast("map<string,string>")
            ),
        }
    )
    if isinstance(names, DataFrame):
        return filled.join(names.select("portal_name"), "portal_name", "left_semi").select(*filled.columns)
    wanted = [n.strip() for n in names or [] if n.strip()]
    return filled.where(F.col("portal_name").isin(wanted)) if wanted else filled


def require_portals(selected: DataFrame, names) -> DataFrame:
    if selected.isEmpty():
        raise LookupError(f"no portal in the registry matches {names}")
    return selected


# --- sink ---------------------------------------------------------------------

SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def save_table(df: DataFrame, table: str, if_exists: str = "replace", path: str | None = None) -> None:
    """Write a table, columns in order. `path` keeps it outside the warehouse folder."""
    writer = df.write.mode(SAVE_MODES[if_exists]).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
