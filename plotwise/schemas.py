"""Schemas of everything read or written. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


STAGED_URLS = _struct(url=S, discovered_at=S)

STAGED_LISTINGS = _struct(
    url=S,
    title=S,
    listing_title=S,
    listingTitle=S,
    address=S,
    property_type=S,
    description=S,
    price=T.VariantType(),
    area=T.VariantType(),
    price_php=T.VariantType(),
    area_sqm=T.VariantType(),
    published_at_text=S,
    published_at=S,
    scraped_at=S,
    bedrooms=S,
    bathrooms=S,
    source=S,
    source_env=S,
)

STAGED_FAILURES = _struct(url=S, reason=S, detail=S, logged_at=S)

PORTAL = _struct(
    portal_name=S,
    seed_urls=T.ArrayType(S),
    scraping_mode=S,
    listing_selector=S,
    pagination_selector=S,
    detail_selectors=T.MapType(S, S),
    rate_limit_delay=D,
    max_retries=I,
    timeout=I,
    headers=T.MapType(S, S),
    max_pages=I,
    wait_for_selector=S,
    respect_robots=B,
)

LISTINGS = _struct(
    url=S,
    listing_title=S,
    property_type=S,
    address=S,
    price_php=D,
    area_sqm=D,
    price_per_sqm=D,
    price_currency=S,
    price_value=D,
    price_json=T.VariantType(),
    area_json=T.VariantType(),
    bedrooms=I,
    bathrooms=I,
    description=S,
    published_at_text=S,
    published_at=T.TimestampType(),
    scraped_at=T.TimestampType(),
    as_of_date=T.DateType(),
    source=S,
    source_env=S,
)


PAGES = _struct(url=S, html=S)
