"""Loaders and the value rules they use: sections C, D and E04."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.standin import OBS, TIES, now, observations, r6, spread, table, ts_text
from plotwise.functions import amounts, dates, text, urls
from plotwise.operators import dedupe, projection
from plotwise.plans import loaders
from plotwise.session import scratch_path

# --- staged records derived from observations ----------------------------------
# price: an object, JSON text, plain text or missing; area: an object or one of two texts


def staged(spark, sf_dir):
    n, size = F.col("l_linenumber"), F.col("p_size").cast("string")
    shown = F.concat(
        F.lit("₱ "), F.format_number(F.floor("l_extendedprice"), 0),
        F.when(n % 2 == 0, F.lit(" /month")).otherwise(""),
    )
    price = F.to_json(
        F.struct(
            shown.alias("raw"), F.col("price_currency").alias("currency"),
            F.col("l_extendedprice").alias("value"), F.when(n % 2 == 0, "month").alias("period"),
        )
    )
    metric = F.concat(size, F.lit(" sqm"))
    area = F.to_json(F.struct(metric.alias("raw"), F.col("p_size").cast("double").alias("sqm")))
    obs = observations(spark, sf_dir, published=True)
    return obs.select(
        F.when((n == 3) & (F.col("l_quantity") < 10), "").otherwise(F.col("raw_url")).alias("url"),
        F.col("url").alias("plain_url"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" \n "), F.col("p_brand"), F.lit(" ")).alias("title"),
        F.concat(F.lit("\t"), F.col("p_type")).alias("property_type"),
        F.when(n % 2 == 0, F.concat(F.lit("Unit of "), metric, F.lit(" near the park"))).otherwise("").alias("description"),
        F.when(n % 4 == 0, F.parse_json(price))
        .when(n % 4 == 1, price.cast("variant"))
        .when(n % 4 == 2, shown.cast("variant"))
        .alias("price"),
        F.when(n % 3 == 0, F.parse_json(area))
        .when(n % 3 == 1, metric.cast("variant"))
        .otherwise(F.concat(size, F.lit(" sq ft")).cast("variant"))
        .alias("area"),
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'+08:00'").alias("published_at"),
        F.when(
            n != 5,
            F.concat(
                F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T20:30:00"),
                F.when(n % 2 == 0, F.lit("+00:00")).otherwise("-08:00"),
            ),
        ).alias("scraped_at"),
        n.cast("string").alias("bedrooms"),
        F.when(n % 2 == 0, "2.0").otherwise("two").alias("bathrooms"),
        F.when(n % 2 == 0, F.col("l_linestatus")).alias("source"),
        *TIES,
    )


STAGED = r"""
s AS (
  SELECT *, l_linenumber AS n,
    CASE WHEN l_linenumber = 3 AND l_quantity < 10 THEN '' ELSE raw_url END AS s_url,
    CASE WHEN l_linenumber % 4 = 0 THEN 'object' WHEN l_linenumber % 4 = 1 THEN 'json'
         WHEN l_linenumber % 4 = 2 THEN 'text' END AS pkind,
    CASE WHEN l_linenumber % 3 = 0 THEN 'object' WHEN l_linenumber % 3 = 1 THEN 'metric' ELSE 'feet' END AS akind,
    CAST(p_size AS DOUBLE) AS size,
    CASE WHEN l_linenumber <> 5 THEN CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1230 MINUTE
      + CASE WHEN l_linenumber % 2 = 0 THEN INTERVAL 0 HOUR ELSE INTERVAL 8 HOUR END END AS scraped_utc,
    published_at - INTERVAL 8 HOUR AS published_utc
  FROM obs)
"""
RATIO = "CASE WHEN area > 0 THEN {0} / area END"


@query(
    "load_relational",
    f"""WITH {OBS}, {STAGED}, a AS (SELECT *,
      CASE WHEN pkind IN ('object', 'json') THEN l_extendedprice END AS pv,
      CASE WHEN pkind IN ('object', 'json') THEN price_currency END AS pc,
      CASE akind WHEN 'feet' THEN round(size * 0.092903, 2) ELSE size END AS area FROM s),
    p AS (SELECT *, CASE WHEN pc IS NULL OR pc = 'PHP' THEN pv END AS php FROM a)
    SELECT s_url AS url, l_orderkey, l_suppkey, round(php, 2) AS price_php, area AS area_sqm,
    {RATIO.format('php')} AS price_per_sqm, n AS bedrooms,
    CASE WHEN n % 2 = 0 THEN 2 END AS bathrooms,
    strftime(scraped_utc, '%Y-%m-%d %H:%M:%S') AS scraped_at,
    CASE WHEN n <> 5 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS as_of_date,
    pc AS price_currency, round(pv, 2) AS price_value FROM p""",
)
def load_relational(spark, sf_dir):
    rows = loaders.load(staged(spark, sf_dir), loaders.RELATIONAL, now(), passing=("l_orderkey", "l_suppkey"))
    return rows.select(
        "url", "l_orderkey", "l_suppkey", F.round("price_php", 2).alias("price_php"), "area_sqm",
        "price_per_sqm", "bedrooms", "bathrooms", ts_text("scraped_at").alias("scraped_at"),
        F.col("as_of_date").cast("string").alias("as_of_date"), "price_currency",
        F.round("price_value", 2).alias("price_value"),
    )


@query(
    "load_flat_latest",
    f"""WITH {OBS}, {STAGED}, r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY
      scraped_utc DESC NULLS FIRST, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC,
      l_extendedprice DESC) AS rn FROM s),
    a AS (SELECT *, CASE WHEN pkind = 'object' THEN l_extendedprice END AS pv,
      CASE WHEN akind = 'object' THEN size END AS area FROM r WHERE rn = 1)
    SELECT url, round(pv, 2) AS price_value, CASE WHEN pkind = 'object' THEN price_currency END AS price_currency,
    CASE WHEN pkind = 'object' AND n % 2 = 0 THEN 'month' END AS price_period,
    CASE WHEN pkind = 'object' THEN '₱ ' || format('{{:,}}', CAST(floor(l_extendedprice) AS BIGINT)) ||
      CASE WHEN n % 2 = 0 THEN ' /month' ELSE '' END END AS price_raw,
    area AS area_sqm, CASE WHEN akind = 'object' THEN p_size || ' sqm' END AS area_raw,
    {RATIO.format('pv')} AS price_per_sqm, strftime(scraped_utc, '%Y-%m-%dT%H:%M:%S') AS scraped_at FROM a""",
)
def load_flat_latest(spark, sf_dir):
    records = staged(spark, sf_dir).drop("url").withColumnRenamed("plain_url", "url")
    rows = loaders.load(records, loaders.FLAT, now(), ties=TIES)
    return rows.select(
        "url", F.round("price_value", 2).alias("price_value"), "price_currency", "price_period", "price_raw",
        "area_sqm", "area_raw", "price_per_sqm", "scraped_at",
    )


@query(
    "publish_gate",
    f"""WITH {OBS}, {STAGED}, a AS (SELECT *,
      CASE WHEN pkind IN ('object', 'json') AND (price_currency IS NULL OR price_currency = 'PHP') THEN l_extendedprice
           WHEN pkind = 'text' THEN floor(l_extendedprice) END AS php,
      CASE WHEN akind = 'object' THEN size WHEN n % 2 = 0 THEN size END AS area FROM s)
    SELECT s_url AS url, l_orderkey, l_suppkey, round(php, 2) AS price_php, area AS area_sqm,
    {RATIO.format('php')} AS price_per_sqm, CASE WHEN n % 2 = 0 THEN l_linestatus ELSE 'portal_a' END AS source,
    CASE WHEN pkind IS NOT NULL THEN 1 ELSE 0 END AS has_price_json
    FROM a WHERE s_url <> '' AND area >= 4 AND php > 0""",
)
def publish_gate(spark, sf_dir):
    from dataclasses import replace

    rules = replace(loaders.PUBLISH, min_area=4.0)
    rows = loaders.load(staged(spark, sf_dir), rules, now(), source="portal_a", passing=("l_orderkey", "l_suppkey"))
    return rows.select(
        "url", "l_orderkey", "l_suppkey", F.round("price_php", 2).alias("price_php"), "area_sqm",
        "price_per_sqm", "source",
        F.col("price_json").isNotNull().cast("int").alias("has_price_json"),
    )


DUMP = f"""
d AS (SELECT *, CASE WHEN pkind = 'object' AND (price_currency IS NULL OR price_currency = 'PHP')
    THEN l_extendedprice END AS php, CASE WHEN akind = 'object' THEN size END AS area FROM s)
"""


@query(
    "load_dump",
    f"""WITH {OBS}, {STAGED}, {DUMP}
    SELECT s_url AS url, l_orderkey, l_suppkey, listing_title || ' ' || p_brand AS listing_title, property_type,
    round(php, 2) AS price_php, area AS area_sqm, {RATIO.format('php')} AS price_per_sqm,
    strftime(coalesce(scraped_utc, TIMESTAMP '2024-06-01'), '%Y-%m-%d %H:%M:%S') AS scraped_at,
    'portal_a' AS source, strftime(published_utc, '%Y-%m-%d %H:%M:%S') AS published_at,
    CASE WHEN n % 2 = 0 THEN 'Unit of ' || p_size || ' sqm near the park' END AS description, 'prod' AS source_env
    FROM d JOIN (SELECT p_partkey, p_brand FROM part) USING (p_partkey) WHERE s_url <> ''""",
)
def load_dump(spark, sf_dir):
    rows = loaders.load(staged(spark, sf_dir), loaders.DUMP, now(), source="portal_a", passing=("l_orderkey", "l_suppkey"))
    return loaders.writable(rows, now()).select(
        "url", "l_orderkey", "l_suppkey", "listing_title", "property_type", F.round("price_php", 2).alias("price_php"),
        "area_sqm", "price_per_sqm", ts_text("scraped_at").alias("scraped_at"), "source",
        ts_text("published_at").alias("published_at"), "description", "source_env",
    )


@query(
    "load_staged",
    f"""WITH {OBS}, {STAGED}
    SELECT s_url AS url, l_orderkey, l_suppkey, round(CASE WHEN pkind = 'object' THEN l_extendedprice END, 2) AS price_php,
    CASE WHEN akind = 'object' THEN size END AS area_sqm, CAST(NULL AS DOUBLE) AS price_per_sqm,
    strftime(coalesce(scraped_utc, TIMESTAMP '2024-06-01'), '%Y-%m-%d %H:%M:%S') AS scraped_at, 'portal_a' AS source FROM s""",
)
def load_staged(spark, sf_dir):
    rows = loaders.load(staged(spark, sf_dir), loaders.STAGED, now(), source="portal_a", passing=("l_orderkey", "l_suppkey"))
    return rows.select(
        "url", "l_orderkey", "l_suppkey", F.round("price_php", 2).alias("price_php"), "area_sqm", "price_per_sqm",
        ts_text("scraped_at").alias("scraped_at"), "source",
    )


@query(
    "ingest_counters",
    f"""WITH {OBS}, {STAGED}, {DUMP}
    SELECT count(*) AS rows_read, count(*) FILTER (s_url <> '') AS rows_written,
    count(*) FILTER (s_url <> '' AND n % 2 = 0) AS has_description,
    count(*) FILTER (s_url <> '' AND published_utc IS NOT NULL) AS has_published_at,
    count(*) FILTER (s_url <> '' AND php <> 0 AND area > 0) AS price_and_area,
    count(*) FILTER (s_url = '') AS skipped_invalid_url FROM d""",
)
def ingest_counters(spark, sf_dir):
    return loaders.ingest_counters(staged(spark, sf_dir), now(), "portal_a")


@query(
    "ingest_counters_observed",
    f"""WITH {OBS}, {STAGED}, {DUMP}
    SELECT count(*) AS rows_read, count(*) FILTER (s_url <> '') AS rows_written,
    count(*) FILTER (s_url <> '' AND n % 2 = 0) AS has_description,
    count(*) FILTER (s_url <> '' AND published_utc IS NOT NULL) AS has_published_at,
    count(*) FILTER (s_url <> '' AND php <> 0 AND area > 0) AS price_and_area,
    count(*) FILTER (s_url = '') AS skipped_invalid_url FROM d""",
)
def ingest_counters_observed(spark, sf_dir):
    """The same counters, taken while the load is written."""
    counted = loaders.write_load(staged(spark, sf_dir), now(), "portal_a", scratch_path(spark, "load"))
    return spark.createDataFrame([tuple(counted.values())], ", ".join(f"{name} long" for name in counted))


# --- values -------------------------------------------------------------------

PRICE_TEXT = """'₱ ' || format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) ||
  CASE WHEN l_linenumber % 2 = 0 THEN ' /month' WHEN l_linenumber = 7 THEN '/ yr' ELSE '.50' END"""


@query(
    "normalized_prices",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, {PRICE_TEXT} AS raw, 'PHP' AS currency,
    floor(l_extendedprice) AS value,
    CASE WHEN l_linenumber % 2 = 0 THEN 'month' WHEN l_linenumber = 7 THEN 'year' END AS period FROM lineitem""",
)
def normalized_prices(spark, sf_dir):
    n = F.col("l_linenumber")
    tail = F.when(n % 2 == 0, "  /month").when(n == 7, "/ yr").otherwise(".50")
    shown = F.concat(F.lit(" â‚± "), F.format_number(F.floor("l_extendedprice"), 0), tail)
    rows = spread(table(spark, sf_dir, "lineitem")).withColumn("shown", shown)
    priced = amounts.with_price_from_text(rows, "p", F.col("shown"))
    return priced.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "p.*")


@query(
    "normalized_areas",
    """SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN p_size || ' sq ft' ELSE format('{:,}', p_size * 100) ||
    CASE p_partkey % 3 WHEN 0 THEN ' SQM' ELSE ' sq. m' END END AS raw,
    CASE WHEN p_partkey % 3 <> 2 THEN CAST(p_size * 100 AS DOUBLE) END AS sqm FROM part""",
)
def normalized_areas(spark, sf_dir):
    kind, size = F.col("p_partkey") % 3, F.col("p_size")
    shown = F.when(kind == 2, F.concat(size.cast("string"), F.lit(" sq ft"))).otherwise(
        F.concat(F.format_number(size * 100, 0), F.when(kind == 0, " SQM").otherwise(" sq. m"))
    )
    rows = amounts.with_area_from_text(table(spark, sf_dir, "part").withColumn("shown", shown), "a", F.col("shown"))
    return rows.select("p_partkey", "a.*")


@query(
    "coerced_areas",
    f"""WITH {OBS}, {STAGED} SELECT raw_url, l_orderkey, l_suppkey, l_quantity,
    CASE akind WHEN 'feet' THEN round(size * 0.092903, 2) ELSE size END AS area_sqm FROM s""",
)
def coerced_areas(spark, sf_dir):
    rows = amounts.with_objects(staged(spark, sf_dir).drop("url"), json_text=True, area=F.col("area"))
    rows = amounts.with_area_sqm(rows, "area_sqm", F.col("_area"), F.col("_area_text"))
    raw = F.concat("plain_url", F.lit("/?ref="), F.col("l_linenumber").cast("string"))
    return rows.select(raw.alias("raw_url"), "l_orderkey", "l_suppkey", "l_quantity", "area_sqm")


@query(
    "json_prices",
    f"""WITH {OBS}, {STAGED} SELECT raw_url, l_orderkey, l_suppkey, l_quantity,
    CASE WHEN pkind IN ('object', 'json') THEN l_extendedprice END AS price_value,
    CASE WHEN pkind IN ('object', 'json') THEN price_currency END AS price_currency,
    CASE WHEN pkind IN ('object', 'json') THEN 1 ELSE 0 END AS is_jsonish FROM s""",
)
def json_prices(spark, sf_dir):
    price, found = F.col("price"), F.col("_price")
    raw = F.concat("plain_url", F.lit("/?ref="), F.col("l_linenumber").cast("string"))
    rows = amounts.with_objects(staged(spark, sf_dir), json_text=True, price=price)
    return rows.select(
        raw.alias("raw_url"), "l_orderkey", "l_suppkey", "l_quantity",
        amounts.price_value(found).alias("price_value"), amounts.price_currency(found).alias("price_currency"),
        amounts.jsonish(price).isNotNull().cast("int").alias("is_jsonish"),
    )


@query(
    "flattened_props",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS price_value,
    CASE event_id % 3 WHEN 1 THEN 'PHP' WHEN 2 THEN 'usd' END AS price_currency FROM events""",
)
def flattened_props(spark, sf_dir):
    """Two thirds of the objects name a currency."""
    k = F.col("event_id") % 3
    named = F.when(k == 1, '{"currency":"PHP",').when(k == 2, '{"currency":"usd",').otherwise("{")
    renamed = F.replace("props", F.lit('"k"'), F.lit('"value"'))
    renamed = F.try_parse_json(F.concat(named, F.substring(renamed, 2, 1 << 30)))
    flat = amounts.flatten_price(F.col("_price"))
    rows = table(spark, sf_dir, "events").withColumn("price", renamed)
    return amounts.with_objects(rows, price=F.col("price")).select(
        "event_id", flat["price_value"].alias("price_value"), flat["price_currency"].alias("price_currency")
    )


WRITTEN = (None, "PHP", "php", "₱", "", "USD", "php₱")


@query(
    "currency_guard",
    f"""WITH {OBS}, c AS (SELECT price_value, [NULL, 'PHP', 'php', '₱', '', 'USD', 'php₱'][l_linenumber] AS currency FROM obs)
    SELECT currency, count(*) AS listings, count(price_value) AS any_currency,
    count(*) FILTER (currency IS NULL OR currency = 'PHP') AS strict_php,
    count(*) FILTER (upper(coalesce(currency, '')) IN ('', 'PHP', '₱', 'PHP₱')) AS lenient_php FROM c GROUP BY 1""",
)
def currency_guard(spark, sf_dir):
    """Currencies written in seven ways, which the three rules tell apart."""
    written = F.array(*[F.lit(w) for w in WRITTEN])
    rows = observations(spark, sf_dir, part=False).withColumn("currency", F.element_at(written, F.col("l_linenumber").cast("int")))
    value, cur = F.col("price_value"), F.col("currency")
    return rows.groupBy("currency").agg(
        F.count("*").alias("listings"),
        *[
            F.count(amounts.peso_price(value, cur, rule)).alias(name)
            for rule, name in (("any", "any_currency"), ("strict", "strict_php"), ("lenient", "lenient_php"))
        ],
    )


@query(
    "ppsqm_bases",
    f"""WITH {OBS} SELECT property_type, round(avg(CASE WHEN area_sqm > 0 THEN price_php / area_sqm END), 6) AS peso_base,
    round(avg(CASE WHEN area_sqm > 0 THEN price_value / area_sqm END), 6) AS any_base,
    count(CASE WHEN area_sqm > 0 THEN price_php / area_sqm END) AS peso_rows FROM obs GROUP BY 1""",
)
def ppsqm_bases(spark, sf_dir):
    peso = amounts.per_sqm(F.col("price_php"), F.col("area_sqm"))
    whole = amounts.per_sqm(F.col("price_value"), F.col("area_sqm"))
    return observations(spark, sf_dir).groupBy("property_type").agg(
        r6(F.avg(peso)).alias("peso_base"), r6(F.avg(whole)).alias("any_base"), F.count(peso).alias("peso_rows")
    )


@query(
    "defaults_and_tags",
    f"""WITH {OBS}, {STAGED} SELECT raw_url, l_orderkey, l_suppkey, l_quantity,
    strftime(coalesce(scraped_utc, TIMESTAMP '2024-06-01'), '%Y-%m-%d %H:%M:%S') AS scraped_at,
    CASE WHEN n % 2 = 0 THEN l_linestatus ELSE 'portal_a' END AS source, 'qa' AS source_env FROM s""",
)
def defaults_and_tags(spark, sf_dir):
    rows = loaders.with_defaults(staged(spark, sf_dir), now(), "qa")
    raw = F.concat("plain_url", F.lit("/?ref="), F.col("l_linenumber").cast("string"))
    return rows.select(
        raw.alias("raw_url"), "l_orderkey", "l_suppkey", "l_quantity",
        ts_text(dates.parse_timestamp(F.col("scraped_at"))).alias("scraped_at"),
        F.coalesce(text.empty_to_null(F.col("source")), F.lit("portal_a")).alias("source"), "source_env",
    )


@query(
    "title_alias",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_brand ELSE p_type END AS title FROM part""",
)
def title_alias(spark, sf_dir):
    k = F.col("p_partkey") % 3
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.first_filled(
            F.when(k == 0, F.col("p_name")).otherwise(""), F.when(k == 1, F.col("p_brand")), F.col("p_type")
        ).alias("title"),
    )


@query(
    "clean_texts",
    """SELECT doc_id, length(trim(regexp_replace(replace(text, chr(160), ' '), '\\s+', ' ', 'g'))) AS clean_length,
    md5(trim(regexp_replace(replace(text, chr(160), ' '), '\\s+', ' ', 'g'))) AS clean_md5,
    md5(nullif(trim(regexp_replace(replace(lang || chr(160) || ' ' || source, chr(160), ' '), '\\s+', ' ', 'g')), '')) AS tag_md5
    FROM documents""".replace("\\\\", "\\"),
)
def clean_texts(spark, sf_dir):
    tidy = text.clean_text(F.col("text"))
    tag = text.normalize_text(F.concat("lang", F.lit("  "), "source"))
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id", F.length(tidy).alias("clean_length"), F.md5(tidy).alias("clean_md5"), F.md5(tag).alias("tag_md5")
    )


@query(
    "city",
    f"""WITH {OBS} SELECT coalesce(nullif(regexp_extract(CASE WHEN l_linenumber = 7 THEN r.r_name ELSE address END,
    '(NATION_1[0-9]?|NATION_2)', 1), ''), 'Unknown') AS city, count(*) AS listings
    FROM obs, (SELECT 'nowhere' AS r_name) r GROUP BY 1""",
)
def city(spark, sf_dir):
    obs = observations(spark, sf_dir, address=True)
    address = F.when(F.col("l_linenumber") == 7, "nowhere").otherwise(F.col("address"))
    return obs.groupBy(text.city_of(address, "(NATION_1[0-9]?|NATION_2)").alias("city")).agg(
        F.count("*").alias("listings")
    )


@query(
    "first_integers",
    "SELECT p_partkey, CAST(regexp_extract(p_brand || ' size ' || p_size, '[0-9]+') AS BIGINT) AS number FROM part",
)
def first_integers(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.first_integer(F.concat("p_brand", F.lit(" size "), F.col("p_size").cast("string"))).alias("number"),
    )


@query(
    "numeric_coercion",
    """SELECT c_custkey, CASE WHEN c_custkey % 4 IN (0, 1) THEN c_acctbal END AS number,
    CASE WHEN c_custkey % 4 = 2 THEN c_nationkey END AS rooms FROM customer""",
)
def numeric_coercion(spark, sf_dir):
    k = F.col("c_custkey") % 4
    shown = (
        F.when(k == 0, F.col("c_acctbal").cast("string"))
        .when(k == 1, F.concat(F.lit(" "), F.col("c_acctbal").cast("string")))
        .when(k == 2, "nan")
        .otherwise(F.col("c_mktsegment"))
    )
    rooms = F.when(k == 2, F.concat(F.col("c_nationkey").cast("string"), F.lit(".0"))).otherwise("1.5")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.to_number(shown).alias("number"), text.to_count(rooms).alias("rooms")
    )


# --- dates --------------------------------------------------------------------


@query(
    "relative_dates",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
    strftime(l_shipdate - CASE WHEN l_linenumber = 7 THEN INTERVAL 0 DAY
      WHEN l_linenumber = 6 THEN to_days(CAST(l_quantity AS INT) * 30 + 14)
      ELSE to_days(l_linenumber) + to_hours(CAST(l_quantity AS INT)) END, '%Y-%m-%d %H:%M:%S') AS published,
    strftime(CASE WHEN l_linenumber < 6 THEN l_shipdate - to_days(l_linenumber) - to_hours(CAST(l_quantity AS INT))
      WHEN l_linenumber = 6 THEN l_shipdate - to_days(CAST(l_quantity AS INT) * 30 + 14) END, '%Y-%m-%d %H:%M:%S') AS relative
    FROM lineitem""",
)
def relative_dates(spark, sf_dir):
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int").cast("string")
    shown = (
        F.when(n == 7, "posted just ago")
        .when(n == 6, F.concat(F.lit("Updated "), q, F.lit(" Months, 2 weeks AGO")))
        .otherwise(F.concat(F.lit("posted "), n.cast("string"), F.lit(" days, "), q, F.lit(" hours ago")))
    )
    rows = spread(table(spark, sf_dir, "lineitem")).withColumns(
        {"shown": shown, "as_of": F.col("l_shipdate").cast("timestamp")}
    )
    rows = dates.with_published(rows, "published", F.col("shown"), F.col("as_of"))
    rows = dates.with_relative(rows, "relative", F.col("shown"), F.col("as_of"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
        ts_text("published").alias("published"), ts_text("relative").alias("relative"),
    )


@query(
    "absolute_dates",
    """WITH o AS (SELECT *, o_orderkey % 16 AS k, CAST(o_orderdate AS DATE) AS day FROM orders),
    r AS (SELECT *, CASE WHEN k IN (8, 11) AND day(day) <= 12 THEN make_date(year(day), day(day), month(day)) ELSE day END AS seen FROM o)
    SELECT o_orderkey, strftime(CASE k WHEN 12 THEN date_trunc('month', day) WHEN 13 THEN make_date(2024, month(day), day(day))
      WHEN 14 THEN day + INTERVAL 904 MINUTE WHEN 15 THEN TIMESTAMP '2024-06-01 12:30:00' ELSE seen END, '%Y-%m-%d %H:%M:%S') AS parsed,
    CASE WHEN k = 0 THEN strftime(o_orderdate - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') END AS token,
    CASE WHEN k NOT IN (12, 13, 15) THEN CAST(seen AS VARCHAR) END AS written FROM r""",
)
def absolute_dates(spark, sf_dir):
    """Sixteen ways to write a day; three of them need the job's "now", which written dates lack."""
    k, day = F.col("o_orderkey") % 16, F.col("o_orderdate")
    shapes = [
        "d MMMM yyyy", "MMM d, yyyy", "yyyy-MM-dd", "EEE, dd MMM yyyy HH:mm:ss '+0000'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
        "d-MMM-yyyy", "d'th' MMMM yyyy", "d MMM yy", "dd.MM.yyyy", "yyyy.MM.dd", "MM-dd-yyyy", "dd/MM/yyyy", "MMM yyyy", "MMMM d",
        "EEE d MMM yyyy '3:04 PM'", "'12:30'",
    ]
    shown = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        shown = F.when(k == i, F.date_format(day, shape)).otherwise(shown)
    token = F.when(k == 0, dates.token_timestamp(F.concat(F.lit("Listed: "), "shown", F.lit(" (new)")), "Asia/Manila"))
    rows = spread(table(spark, sf_dir, "orders")).withColumn("shown", shown).withColumn("token", token)
    rows = dates.with_absolute(rows, "parsed", F.col("shown"), now())
    rows = dates.with_written_date(rows, "written", F.col("shown"))
    return rows.select(
        "o_orderkey", ts_text("parsed").alias("parsed"), ts_text("token").alias("token"),
        F.col("written").cast("string").alias("written"),
    )


@query(
    "iso_timestamps",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS iso, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS seconds,
    CASE WHEN event_id % 3 = 2 THEN NULL ELSE strftime(ts - CASE WHEN event_id % 3 = 1 THEN INTERVAL 330 MINUTE
      ELSE INTERVAL 0 MINUTE END, '%Y-%m-%d %H:%M:%S') END AS coerced,
    CASE WHEN event_id % 3 = 2 THEN NULL ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS as_of_date FROM events""",
)
def iso_timestamps(spark, sf_dir):
    k, ts = F.col("event_id") % 3, F.col("ts").cast("timestamp")
    shown = (
        F.when(k == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(k == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'"))
        .otherwise("not a time")
    )
    rows = table(spark, sf_dir, "events").withColumn("shown", shown)
    return dates.with_written_date(rows, "as_of_date", F.col("shown")).select(
        "event_id", dates.iso_utc(ts).alias("iso"), dates.iso_seconds(ts).alias("seconds"),
        ts_text(dates.parse_timestamp(F.col("shown"))).alias("coerced"),
        F.col("as_of_date").cast("string").alias("as_of_date"),
    )


# --- columns and duplicates ---------------------------------------------------


@query(
    "column_lists",
    """SELECT c_name AS url, CAST(c_acctbal AS DOUBLE) AS price_php, CAST(NULL AS DOUBLE) AS area_sqm,
    CAST(c_nationkey AS INTEGER) AS bedrooms FROM customer""",
)
def column_lists(spark, sf_dir):
    from pyspark.sql import types as T

    target = T.StructType.fromDDL("url string, price_php double, area_sqm double, bedrooms int, bathrooms int")
    rows = projection.rename_columns(
        table(spark, sf_dir, "customer"), {"c_name": "url", "c_acctbal": "price_php", "c_nationkey": "bedrooms"}
    )
    rows = projection.prefer_columns(projection.keep_columns(rows, target), ("price_php", "url"))
    return projection.allow_columns(rows, {"url", "price_php", "area_sqm", "bedrooms", "id"})


@query(
    "keep_latest",
    f"""WITH {OBS}, t AS (SELECT *, CASE WHEN l_linenumber <> 5 THEN scraped_at END AS seen_at FROM obs),
    r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seen_at DESC NULLS FIRST, l_orderkey DESC,
      l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM t)
    SELECT url, raw_url, l_orderkey, l_suppkey, round(price_value, 2) AS price_value,
    strftime(seen_at, '%Y-%m-%d %H:%M:%S') AS scraped_at FROM r WHERE rn = 1""",
)
def keep_latest(spark, sf_dir):
    obs = observations(spark, sf_dir, part=False).withColumn(
        "scraped_at", F.when(F.col("l_linenumber") != 5, F.col("scraped_at"))
    )
    picked = obs.select("url", "raw_url", "price_value", "scraped_at", *TIES)
    return dedupe.keep_latest(picked, ties=TIES).select(
        "url", "raw_url", "l_orderkey", "l_suppkey", F.round("price_value", 2).alias("price_value"),
        ts_text("scraped_at").alias("scraped_at"),
    )


@query(
    "listing_ids",
    "SELECT 'https://p.example.com/property/' || p_partkey AS url, sha256('https://p.example.com/property/' || p_partkey) AS listing_id FROM part",
)
def listing_ids(spark, sf_dir):
    url = F.concat(F.lit("https://p.example.com/property/"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select(url.alias("url"), urls.listing_id(url).alias("listing_id"))
