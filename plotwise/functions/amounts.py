"""Prices and areas, from shown text and from JSON of uncertain shape (VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plotwise.functions import add_layers
from plotwise.functions.text import (
    PESO,
    SPACE,
    clean_text,
    strip,
    strip_text,
    to_number,
)

# How prices and areas are written.
SHOWN_PRICE = rf"(?i)(?:₱|Php){SPACE}*[0-9,]+(?:{SPACE}*/{SPACE}*(?:month|mo|year|yr|day))?"
SHOWN_AREA = rf"(?i)([0-9,.]+){SPACE}*(sqm|m²|sq\.? m)"
PAGE_NUMBER = r"[0-9]+(?:\.[0-9]+)?"
PAGE_AREA = rf"(?i)([0-9][0-9,\.]*){SPACE}*(sqm|m2|m²)"
METRIC_AREA = rf"(?i)([0-9]+(?:[\.,][0-9]+)?){SPACE}*(?:m²|m2|sqm|sq\.?{SPACE}*m(?:eters?)?)"
FOOT_AREA = rf"(?i)([0-9]+(?:[\.,][0-9]+)?){SPACE}*(?:sq\.?{SPACE}*ft|ft²|ft2|square{SPACE}*feet)"
DESCRIBED_AREA = rf"(?i)([0-9]+(?:[\.,][0-9]+)?){SPACE}*(sqm|m²|m2|sq\.?{SPACE}*m)"
SQM_PER_SQFT = 0.092903
PERIODS = (("month", "month"), ("mo", "month"), ("day", "day"), ("year", "year"), ("yr", "year"))
PESO_CURRENCIES = ("", "PHP", "₱", "PHP₱")

PRICE_TYPE = "struct<raw:string,currency:string,value:double,period:string>"
AREA_TYPE = "struct<raw:string,sqm:double>"


def _number(text: Column) -> Column:
    digits = F.replace(text, F.lit(","), F.lit(""))
    return F.nullif(digits, F.lit("")).try_cast("double")


def round_cents(x: Column) -> Column:
    """Round to 2 places by the exact binary value, so 464.515 gives 464.51.

    x * 100 is split into a rounded product and its error; the error settles ties.
    """
    product = x * 100.0
    high = x * 134217729.0 - (x * 134217729.0 - x)
    error = (high * 100.0 - product) + (x - high) * 100.0
    whole = F.floor(product)
    half = product - whole
    up = (half > 0.5) | (
        (half == 0.5) & ((error > 0) | ((error == 0) & (whole % 2 != 0)))
    )
    return (whole + up.cast("int")) / 100.0


# --- shown text ---------------------------------------------------------------


def with_price_from_text(df: DataFrame, out: str, raw: Column) -> DataFrame:
    """'₱ 95,200 /month' to a price struct; text without a peso amount keeps raw only."""
    text, amount, unit = (F.col(f"__{out}_{n}") for n in ("text", "amount", "unit"))
    period = F.lit(None).cast("string")
    for written, name in reversed(PERIODS):
        period = F.when(unit.contains(written), name).otherwise(period)
    price = F.struct(
        text.alias("raw"),
        F.when(amount != "", "PHP").alias("currency"),
        _number(F.regexp_replace(amount, "[^0-9]", "")).alias("value"),
        period.alias("period"),
    )
    return add_layers(
        df,
        {f"__{out}_text": clean_text(raw)},
        # the only digits in the matched amount are the price
        {f"__{out}_amount": F.regexp_extract(text, SHOWN_PRICE, 0)},
        {f"__{out}_unit": F.lower(F.regexp_extract(amount, "/.*$", 0))},
        {out: F.when(raw != "", price)},
    )


def with_area_from_text(df: DataFrame, out: str, raw: Column) -> DataFrame:
    text = F.col(f"__{out}_text")
    area = F.struct(
        text.alias("raw"), _number(F.regexp_extract(text, SHOWN_AREA, 1)).alias("sqm")
    )
    return add_layers(df, {f"__{out}_text": clean_text(raw)}, {out: F.when(raw != "", area)})


def with_price_from_page(df: DataFrame, out: str, shown: Column) -> DataFrame:
    """Price text of a listing page: any number counts, the currency only if written."""
    plain = F.col(f"__{out}_plain")
    price = F.struct(
        shown.alias("raw"),
        F.when(shown.contains(PESO) | F.lower(shown).contains("php"), "PHP").alias("currency"),
        _number(F.regexp_extract(plain, PAGE_NUMBER, 0)).alias("value"),
        F.when(F.lower(plain).contains("month"), "month").alias("period"),
    )
    return add_layers(
        df,
        {f"__{out}_plain": F.replace(strip_text(shown), F.lit(","), F.lit(""))},
        {out: F.when(shown != "", price)},
    )


def with_area_from_page(df: DataFrame, out: str, page_text: Column) -> DataFrame:
    """First metric area anywhere in the page; an unreadable number is no area."""
    found = F.col(f"__{out}_found")
    sqm = _number(F.regexp_extract(found, "^[0-9,.]+", 0))
    return add_layers(
        df,
        {f"__{out}_found": F.regexp_extract(page_text, PAGE_AREA, 0)},
        {out: F.when(sqm.isNotNull(), F.struct(found.alias("raw"), sqm.alias("sqm")))},
    )


# --- VARIANT ------------------------------------------------------------------


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return _kind(value).startswith("OBJECT")


def is_text(value: Column) -> Column:
    return _kind(value) == "STRING"


def is_numeric(value: Column) -> Column:
    """Numbers and booleans, as a lenient numeric test takes them; never text."""
    return _kind(value).rlike("^(?:BOOLEAN|TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)")


def variant_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def variant_number(value: Column, path: str) -> Column:
    return F.nanvl(F.try_variant_get(value, path, "double"), F.lit(None).cast("double"))


def with_objects(df: DataFrame, json_text: bool = False, **columns: Column) -> DataFrame:
    """For each name=VARIANT: `_name`, the object in it, and `_name_text`, its plain text.

    json_text also takes an object written as JSON text; such text is not plain.
    """
    kinds = {f"__{n}_kind": _kind(v) for n, v in columns.items()}
    texts = {
        f"__{n}_text": strip(F.when(F.col(f"__{n}_kind") == "STRING", variant_text(v)))
        for n, v in columns.items()
    }
    objects = {}
    for n, v in columns.items():
        found = F.when(F.col(f"__{n}_kind").startswith("OBJECT"), v)
        text = F.col(f"__{n}_text")
        if json_text:
            found = found.when(text.startswith("{") & text.endswith("}"), F.try_parse_json(text))
        objects[f"_{n}"] = found
    plain = {
        f"_{n}_text": F.when(F.col(f"_{n}").isNull(), F.col(f"__{n}_text")) for n in columns
    }
    return add_layers(df, kinds, texts, objects, plain)


def jsonish(value: Column) -> Column:
    """An object passes, text that looks like JSON is parsed, the rest is NULL."""
    text = strip(variant_text(value))
    looks = (text.startswith("{") & text.endswith("}")) | (text.startswith("[") & text.endswith("]"))
    return F.when(is_object(value), value).when(is_text(value) & looks, F.try_parse_json(text))


def price_value(found: Column) -> Column:
    return variant_number(found, "$.value")


def price_currency(found: Column) -> Column:
    return F.try_variant_get(found, "$.currency", "string")


def with_area_sqm(df: DataFrame, out: str, found: Column, text: Column) -> DataFrame:
    """Square metres from an object, metric text or square feet (see with_objects)."""
    metric, feet = F.col(f"__{out}_metric"), F.col(f"__{out}_feet")
    return add_layers(
        df,
        {f"__{out}_metric": _number(F.regexp_extract(text, METRIC_AREA, 1))},
        {
            f"__{out}_feet": F.when(metric.isNull(), _number(F.regexp_extract(text, FOOT_AREA, 1)))
            * SQM_PER_SQFT
        },
        {out: F.coalesce(variant_number(found, "$.sqm"), metric, round_cents(feet))},
    )


def flatten_price(found: Column) -> dict[str, Column]:
    """Scalar columns of a price object; NULLs for a NULL."""
    return {
        "price_value": variant_number(found, "$.value"),
        "price_currency": price_currency(found),
        "price_period": F.try_variant_get(found, "$.period", "string"),
        "price_raw": F.try_variant_get(found, "$.raw", "string"),
    }


def flatten_area(found: Column) -> dict[str, Column]:
    return {
        "area_sqm": variant_number(found, "$.sqm"),
        "area_raw": F.try_variant_get(found, "$.raw", "string"),
    }


def publish_price(found: Column, text: Column, price_php: Column) -> Column:
    """Peso price for publishing: a PHP object, else price_php, else digits of a text.

    JSON-looking text never reaches the digits rule: its digits are not a price.
    """
    in_pesos = F.upper(F.coalesce(price_currency(found), F.lit(""))).isin("", "PHP")
    amount = F.try_variant_get(found, "$.value", "variant")
    listed = text.startswith("[") & text.endswith("]")
    digits = F.when(~listed, F.regexp_replace(text, r"[^0-9.]", ""))
    explicit = F.nanvl(price_php.cast("double"), F.lit(None).cast("double"))
    return F.coalesce(
        F.when(in_pesos & is_numeric(amount), variant_number(found, "$.value")),
        explicit,
        _number(digits),
    )


def publish_area(found: Column, area_sqm_text: Column, description: Column) -> Column:
    """A present but unreadable value gives NULL: the next rule is not tried."""
    sqm = F.try_variant_get(found, "$.sqm", "variant")
    return (
        F.when(sqm.isNotNull() & ~F.is_variant_null(sqm), variant_number(found, "$.sqm"))
        .when(area_sqm_text.isNotNull(), to_number(area_sqm_text))
        .otherwise(_number(F.regexp_extract(description, DESCRIBED_AREA, 1)))
    )


# --- money rules --------------------------------------------------------------


def peso_price(value: Column, currency: Column, rule: str) -> Column:
    """The price if it is in pesos.

    'strict': currency missing or exactly PHP. 'lenient': also '' and the peso sign,
    in any case. 'any': the value whatever its currency.
    """
    if rule == "any":
        return value
    if rule == "strict":
        return F.when(currency.isNull() | (currency == "PHP"), value)
    if rule == "lenient":
        return F.when(F.upper(F.coalesce(currency, F.lit(""))).isin(*PESO_CURRENCIES), value)
    raise ValueError(f"unknown currency rule {rule!r}")


def per_sqm(price: Column, area: Column) -> Column:
    return F.when(price.isNotNull() & (area > 0), price / area)
