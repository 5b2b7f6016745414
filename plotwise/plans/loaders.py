"""Staged records to listing rows: one function, five sets of rules.

The rules differ in which price counts as pesos, which price is divided by the area,
how text is tidied, what is dropped and which columns leave.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from plotwise import schemas
from plotwise.functions import amounts
from plotwise.functions.dates import (
    iso_seconds,
    parse_timestamp,
    with_absolute,
    with_written_date,
)
from plotwise.functions.text import (
    empty_to_null,
    first_filled,
    normalize_text,
    to_count,
    to_number,
)
from plotwise.operators.dedupe import keep_latest
from plotwise.operators.projection import allow_columns, keep_columns, prefer_columns
from plotwise.sources.staged import CORRUPT

# The column lists of the targets.
RELATIONAL_COLUMNS = (
    "url", "listing_title", "price_php", "area_sqm", "price_per_sqm", "address", "bedrooms",
    "bathrooms", "scraped_at", "as_of_date", "price_currency", "price_value",
)
FLAT_COLUMNS = (
    "url", "title", "address", "price_value", "price_currency", "price_period", "price_raw",
    "area_sqm", "area_raw", "price_per_sqm", "bedrooms", "bathrooms", "description", "scraped_at",
)
PUBLISH_COLUMNS = (
    "url", "listing_title", "property_type", "address", "price_php", "area_sqm",
    "price_per_sqm", "price_json", "area_json", "scraped_at", "source",
)
DUMP_COLUMNS = PUBLISH_COLUMNS + ("published_at_text", "published_at", "description")
DEFAULT_ENV = "prod"
MIN_AREA = 1.0


@dataclass(frozen=True)
class Rules:
    """What a loader does with a staged record."""

    name: str
    amounts: str  # 'coerced' | 'flat' | 'publish'
    currency: str = "any"  # see amounts.peso_price
    ratio: str | None = "price_php"  # the price divided by the area; None leaves it NULL
    tidy_text: bool = False
    min_area: float | None = None  # publish gate: url, area and a positive price
    latest_only: bool = False
    need_url: bool = False
    dated: bool = False  # adds as_of_date; the target has a fixed type for each column
    keep_json: bool = False  # price and area leave as VARIANT too, with a source
    own_source: bool = False  # the record's source goes before the portal's name
    fill_time: bool = False  # a missing scraped_at becomes "now"
    columns: tuple = field(default=())


RELATIONAL = Rules(
    "relational", "coerced", currency="strict", dated=True, columns=RELATIONAL_COLUMNS
)
FLAT = Rules("flat", "flat", ratio="price_value", latest_only=True, columns=FLAT_COLUMNS)
PUBLISH = Rules(
    "publish",
    "publish",
    min_area=MIN_AREA,
    keep_json=True,
    own_source=True,
    columns=PUBLISH_COLUMNS,
)
DUMP = Rules(
    "dump",
    "flat",
    currency="lenient",
    tidy_text=True,
    need_url=True,
    keep_json=True,
    fill_time=True,
    columns=DUMP_COLUMNS,
)
STAGED = Rules(
    "staged", "flat", ratio=None, keep_json=True, fill_time=True, columns=PUBLISH_COLUMNS
)


def _or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _given_number(df: DataFrame, name: str) -> Column:
    """A number column that may have been read as VARIANT."""
    if name in df.columns and isinstance(df.schema[name].dataType, T.VariantType):
        return F.when(amounts.is_numeric(F.col(name)), amounts.variant_number(F.col(name), "$"))
    return _or_null(df, name, "double").cast("double")


def _given_text(df: DataFrame, name: str) -> Column:
    if name in df.columns and isinstance(df.schema[name].dataType, T.VariantType):
        return amounts.variant_text(F.col(name))
    return _or_null(df, name).cast("string")


def _with_amounts(df: DataFrame, rules: Rules) -> DataFrame:
    """Amount columns, and the objects they came from in _price and _area."""
    df = amounts.with_objects(
        df,
        json_text=rules.amounts != "flat",
        price=_or_null(df, "price", "variant"),
        area=_or_null(df, "area", "variant"),
    )
    price, area = F.col("_price"), F.col("_area")
    if rules.amounts == "publish":
        return df.withColumns(
            {
                "price_php": amounts.publish_price(
                    price, F.col("_price_text"), _given_number(df, "price_php")
                ),
                "area_sqm": amounts.publish_area(
                    area, _given_text(df, "area_sqm"), _or_null(df, "description")
                ),
            }
        )
    if rules.amounts == "flat":
        df = df.withColumns(amounts.flatten_price(price) | amounts.flatten_area(area))
    else:
        # amounts a record already carries as columns go before those in its objects
        given = {n: to_number(_given_text(df, n)) for n in ("price_value", "area_sqm")}
        given["price_currency"] = _given_text(df, "price_currency")
        df = df.withColumns({f"__{n}": value for n, value in given.items()})
        df = amounts.with_area_sqm(df, "__found_area", area, F.col("_area_text"))
        found = {
            "price_value": amounts.price_value(price),
            "price_currency": amounts.price_currency(price),
            "area_sqm": F.col("__found_area"),
        }
        df = df.withColumns({n: F.coalesce(f"__{n}", value) for n, value in found.items()})
        df = df.drop("__found_area", *[f"__{n}" for n in found])
    peso = amounts.peso_price(F.col("price_value"), F.col("price_currency"), rules.currency)
    return df.withColumn("price_php", peso)


def with_defaults(df: DataFrame, now: Column, source_env: str = DEFAULT_ENV) -> DataFrame:
    """scraped_at and source_env where they are missing."""
    return df.withColumns(
        {
            "scraped_at": F.coalesce(empty_to_null(F.col("scraped_at").cast("string")), now.cast("string")),
            "source_env": F.coalesce(_or_null(df, "source_env"), F.lit(source_env)),
        }
    )


def publishable(df: DataFrame, min_area: float = MIN_AREA) -> DataFrame:
    """Rows fit to publish: url, an area of at least min_area, a positive price."""
    return df.where(
        empty_to_null(F.col("url")).isNotNull()
        & (F.col("area_sqm") >= min_area)
        & (F.col("price_php") > 0)
    )


def load(
    staged: DataFrame,
    rules: Rules,
    now: Column,
    source: str | None = None,
    ties=(),
    passing=(),
) -> DataFrame:
    """Listing rows of a staged DataFrame (schemas.STAGED_LISTINGS; columns may be missing).

    now fills a missing scraped_at and as_of_date. source names the portal where the
    rules or the record leave it open. ties stand in for input order among rows with
    equal times; `passing` columns go through beside the target's own.
    """
    df = staged
    if CORRUPT in df.columns:
        # a line that is no JSON object is nobody's record
        df = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    if rules.need_url:
        df = df.where(empty_to_null(F.col("url")).isNotNull())
    given_source = _or_null(df, "source")
    aliases = [_or_null(df, c) for c in ("listing_title", "title", "listingTitle")]
    df = _with_amounts(df, rules)
    if rules.ratio:
        ratio = amounts.per_sqm(F.col(rules.ratio), F.col("area_sqm"))
    else:
        ratio = F.lit(None).cast("double")
    title = _or_null(df, "title")
    if rules.tidy_text:
        title = normalize_text(first_filled(*aliases))
    elif rules.dated:
        title = F.coalesce(_or_null(df, "listing_title"), title)
    columns = {"price_per_sqm": ratio, "listing_title": title}
    if rules.tidy_text:
        for name in ("property_type", "address", "published_at_text"):
            columns[name] = normalize_text(_or_null(df, name))
        columns["description"] = empty_to_null(_or_null(df, "description"))
        df = with_absolute(df, "published_at", _or_null(df, "published_at"), now.cast("timestamp"))
    for name in ("bedrooms", "bathrooms"):
        columns[name] = to_count(_or_null(df, name).cast("string"))
    if rules.keep_json:
        nothing = F.lit(None).cast("variant")
        for name in ("price", "area"):
            kept = F.col(f"_{name}") if rules.tidy_text else _or_null(df, name, "variant")
            columns[f"{name}_json"] = F.coalesce(kept, nothing)
        named = F.lit(source)
        columns["source"] = (
            F.coalesce(empty_to_null(given_source), named) if rules.own_source else named
        )
    written = _or_null(df, "scraped_at")
    if rules.dated:
        if "scraped_at" in df.columns:
            df = with_written_date(df, "as_of_date", written)
        else:
            columns["as_of_date"] = now.cast("date")
    if rules.fill_time:
        written = F.coalesce(empty_to_null(written), now.cast("string"))
    columns["scraped_at"] = parse_timestamp(written)
    df = df.withColumns(columns)
    if rules.min_area is not None:
        # counted before the gate; the count also keeps Spark from pushing the gate down
        # to where it would work out price and area a second time; a name per load, as
        # one plan may hold several loads
        df = df.observe(f"{rules.name}_gate_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows_read"))
        df = publishable(df, rules.min_area)
    if rules.latest_only:
        df = df.drop("price", "area", "price_php", "listing_title", "listingTitle")
        df = df.drop("_price", "_area", "_price_text", "_area_text")
        df = keep_latest(df, ties=ties).withColumn("scraped_at", iso_seconds(F.col("scraped_at")))
        return prefer_columns(df, rules.columns)
    if rules.dated:
        kinds = {f.name: f for f in schemas.LISTINGS}
        extra = [df.schema[c] for c in passing]
        return keep_columns(df, T.StructType([kinds[c] for c in rules.columns] + extra))
    return prefer_columns(allow_columns(df, (*rules.columns, *passing)), rules.columns)


def writable(loaded: DataFrame, now: Column, source_env: str = DEFAULT_ENV) -> DataFrame:
    """Rows of the dump rules as the merge takes them: defaults and the final ratio."""
    return loaded.withColumns(
        {
            "scraped_at": F.coalesce("scraped_at", now.cast("timestamp")),
            "price_per_sqm": F.coalesce(
                amounts.per_sqm(F.col("price_php"), F.col("area_sqm")), F.col("price_per_sqm")
            ),
            "source_env": F.coalesce(_or_null(loaded, "source_env"), F.lit(source_env)),
        }
    )


def _counters() -> list[Column]:
    """What one load counts: read, written, skipped, and what the written rows have."""
    ok = empty_to_null(F.col("url")).isNotNull()
    both = (F.col("price_php") != 0) & (F.col("area_sqm") > 0)
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(ok).alias("rows_written"),
        F.count_if(ok & F.col("description").isNotNull()).alias("has_description"),
        F.count_if(ok & F.col("published_at").isNotNull()).alias("has_published_at"),
        F.count_if(ok & both).alias("price_and_area"),
        F.count_if(~ok).alias("skipped_invalid_url"),
    ]


def ingest_counters(staged: DataFrame, now: Column, source: str) -> DataFrame:
    """Counts over one load, without writing it."""
    return load(staged, replace(DUMP, need_url=False), now, source).agg(*_counters())


def write_load(staged: DataFrame, now: Column, source: str, path: str) -> dict[str, int]:
    """Write one load as Parquet and return its counters, observed while the rows are written.

    They cost no second pass. The observation has a name of its own for each load, so that
    loads in one session do not mix.
    """
    seen = Observation(f"{DUMP.name}_load_{uuid.uuid4().hex}")
    rows = load(staged, replace(DUMP, need_url=False), now, source).observe(seen, *_counters())
    writable(rows.where(empty_to_null(F.col("url")).isNotNull()), now).write.parquet(path)
    return seen.get
