"""Metrics, dashboard figures, search: sections F, G and part of D."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.standin import CITY, OBS, TIES, observations, r6, spread, table, ts_text
from plotwise.functions.text import city_of
from plotwise.operators import clustering, textindex
from plotwise.plans import dashboard, metrics
from plotwise.session import scratch_path, stored
from plotwise.sources.tables import dashboard_listings

# one shift by rows over the daily series; days as text, the same on both engines
GROWTH = f"""
WITH {OBS}, daily AS (
  SELECT CAST(scraped_at AS DATE) AS d, avg(price_per_sqm) AS a FROM obs
  WHERE price_per_sqm > 0 GROUP BY 1)
"""


def daily_input(spark, sf_dir):
    obs = observations(spark, sf_dir).withColumn("as_of_date", F.col("scraped_at").cast("date"))
    return metrics.daily_ppsqm(obs.select("as_of_date", "price_per_sqm"))


def _day(df):
    return df.withColumn("as_of_date", F.col("as_of_date").cast("string"))


@query(
    "ppsqm_growth",
    GROWTH
    + """SELECT CAST(d AS VARCHAR) AS as_of_date, round(a, 6) AS avg_ppsqm,
    round((a - lag(a, 7) OVER (ORDER BY d)) / lag(a, 7) OVER (ORDER BY d) * 100.0, 6) AS growth_pct
    FROM daily""",
)
def ppsqm_growth(spark, sf_dir):
    grown = metrics.ppsqm_growth(daily_input(spark, sf_dir))
    return _day(grown).select("as_of_date", r6("avg_ppsqm").alias("avg_ppsqm"), r6("growth_pct").alias("growth_pct"))


@query(
    "ppsqm_growth_21_rows",
    GROWTH
    + """SELECT CAST(d AS VARCHAR) AS as_of_date, round(a, 6) AS avg_ppsqm,
    round((a - lag(a, 21) OVER (ORDER BY d)) / lag(a, 21) OVER (ORDER BY d) * 100.0, 6) AS growth_pct
    FROM daily""",
)
def ppsqm_growth_21(spark, sf_dir):
    grown = metrics.ppsqm_growth(daily_input(spark, sf_dir), 21)
    return _day(grown).select("as_of_date", r6("avg_ppsqm").alias("avg_ppsqm"), r6("growth_pct").alias("growth_pct"))


@query(
    "ppsqm_growth_calendar",
    GROWTH
    + """SELECT CAST(x.d AS VARCHAR) AS as_of_date, round(x.a, 6) AS avg_ppsqm,
    round((x.a - y.a) / y.a * 100.0, 6) AS growth_pct
    FROM daily x LEFT JOIN daily y ON y.d = x.d - 7""",
)
def ppsqm_growth_calendar(spark, sf_dir):
    grown = metrics.ppsqm_growth_by_calendar(daily_input(spark, sf_dir))
    return _day(grown).select("as_of_date", r6("avg_ppsqm").alias("avg_ppsqm"), r6("growth_pct").alias("growth_pct"))


@query("daily_ppsqm", GROWTH + "SELECT CAST(d AS VARCHAR) AS as_of_date, round(a, 6) AS avg_ppsqm FROM daily")
def daily_ppsqm(spark, sf_dir):
    return _day(daily_input(spark, sf_dir)).select("as_of_date", r6("avg_ppsqm").alias("avg_ppsqm"))


@query(
    "daily_ppsqm_of_latest",
    f"""WITH {OBS}, latest AS (
      SELECT *, row_number() OVER (PARTITION BY url ORDER BY scraped_at DESC, l_orderkey DESC,
        l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM obs)
    SELECT CAST(CAST(scraped_at AS DATE) AS VARCHAR) AS as_of_date, round(avg(price_per_sqm), 6) AS avg_ppsqm
    FROM latest WHERE rn = 1 AND price_per_sqm > 0 GROUP BY 1""",
)
def daily_ppsqm_of_latest(spark, sf_dir):
    from plotwise.operators.dedupe import keep_latest

    obs = observations(spark, sf_dir).select("url", "scraped_at", "price_per_sqm", *TIES)
    latest = keep_latest(obs, ties=TIES).withColumn("as_of_date", F.col("scraped_at").cast("date"))
    return _day(metrics.daily_ppsqm(latest)).select("as_of_date", r6("avg_ppsqm").alias("avg_ppsqm"))


# --- days on market -----------------------------------------------------------

SEEN = """
WITH seen AS (SELECT user_id, min(CAST(ts AS DATE)) AS f, max(CAST(ts AS DATE)) AS l FROM events GROUP BY 1)
"""


def _event_sightings(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        F.concat(F.lit("https://p.example.com/user/"), F.col("user_id").cast("string")).alias("url"),
        F.col("ts").cast("date").alias("as_of_date"),
    )


@query(
    "first_last_seen",
    SEEN
    + """SELECT 'https://p.example.com/user/' || user_id AS url, CAST(f AS VARCHAR) AS first_seen,
    CAST(l AS VARCHAR) AS last_seen FROM seen""",
)
def first_last_seen(spark, sf_dir):
    seen = metrics.first_last_seen(_event_sightings(spark, sf_dir))
    return seen.select(
        "url", F.col("first_seen").cast("string").alias("first_seen"), F.col("last_seen").cast("string").alias("last_seen")
    )


DOM = """
WITH obs AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d FROM lineitem),
span AS (SELECT date_diff('day', min(d), max(d)) + 1 AS dom FROM obs GROUP BY l_partkey)
SELECT round(avg(dom), 6) AS avg_dom_days, CAST(quantile_cont(dom, 0.5) AS DOUBLE) AS median_dom_days,
       count(*) AS listings_count FROM span
"""


def _days(df):
    return df.select(
        r6("avg_dom_days").alias("avg_dom_days"),
        F.col("median_dom_days").cast("double").alias("median_dom_days"),
        F.col("listings_count").cast("bigint").alias("listings_count"),
    )


def _sightings(spark, sf_dir):
    obs = observations(spark, sf_dir, part=False)
    return obs.select("url", F.col("scraped_at").cast("date").alias("as_of_date"))


@query("days_on_market", DOM)
def days_on_market(spark, sf_dir):
    return _days(metrics.days_on_market_of(_sightings(spark, sf_dir)))


@query("days_on_market_join", DOM)
def days_on_market_join(spark, sf_dir):
    """The two relations kept apart and joined by url, as a stored pair of tables would be."""
    seen = _sightings(spark, sf_dir)
    first = seen.groupBy("url").agg(F.min("as_of_date").alias("first_seen"))
    last = seen.groupBy("url").agg(F.max("as_of_date").alias("last_seen"))
    return _days(metrics.days_on_market(first, last))


# --- dashboard ----------------------------------------------------------------


def listings(spark, sf_dir, published=True):
    obs = observations(spark, sf_dir, address=True, published=published)
    return obs.withColumn("city", city_of(F.col("address"), CITY))


FILTERED = r"""
f AS (SELECT * FROM obs WHERE regexp_matches(coalesce(property_type, ''), '(?i)e.o|small')
  AND regexp_matches(coalesce(city, ''), '(?i)nation_1') AND coalesce(price_php, 0) >= 0
  AND coalesce(price_php, 0) <= 60000 AND coalesce(area_sqm, 0) >= 5 AND coalesce(area_sqm, 0) <= 45
  AND published_at >= TIMESTAMP '1995-06-01' AND published_at <= TIMESTAMP '2000-06-30')
"""


def filtered(spark, sf_dir):
    return dashboard.dashboard_filter(
        listings(spark, sf_dir),
        property_type="e.o|small",
        city="nation_1",
        price_min=0.0,
        price_max=60000.0,
        area_min=5.0,
        area_max=45.0,
        published_from="1995-06-01",
        published_to="2000-06-30",
    )


@query(
    "dashboard_filter",
    f"""WITH {OBS}, {FILTERED}
    SELECT raw_url, l_orderkey, l_linenumber, l_suppkey, property_type, city, round(price_php, 2) AS price_php,
    area_sqm, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM f""",
)
def dashboard_filter(spark, sf_dir):
    return filtered(spark, sf_dir).select(
        "raw_url", "l_orderkey", "l_linenumber", "l_suppkey", "property_type", "city",
        F.round("price_php", 2).alias("price_php"), "area_sqm", ts_text("published_at").alias("published_at"),
    )


CLUSTERED = {"price_php": (20000.0, 40000.0), "area_sqm": (10.0, 20.0), "published_at": (None, None)}


@query(
    "clustered_search",
    f"""WITH {OBS} SELECT raw_url, l_orderkey, l_linenumber, round(price_php, 2) AS price_php, area_sqm FROM obs
    WHERE price_php BETWEEN 20000 AND 40000 AND area_sqm BETWEEN 10 AND 20""",
)
def clustered_search(spark, sf_dir):
    """A search on listings written along a curve of price, area and date: only files it needs are read."""
    path = scratch_path(spark, "clustered")
    columns = ["raw_url", "l_orderkey", "l_linenumber", *CLUSTERED]
    rows = listings(spark, sf_dir).select(*columns)
    clustering.write_clustered(rows, list(CLUSTERED), path, rows_per_file=5000)
    found = clustering.read_clustered(spark, path, CLUSTERED)
    bounds = {"min_price": 20000.0, "max_price": 40000.0, "min_area": 10.0, "max_area": 20.0}
    return dashboard.search_filter(found, bounds).select(
        "raw_url", "l_orderkey", "l_linenumber", F.round("price_php", 2).alias("price_php"), "area_sqm"
    )


KPI = """SELECT count(*) AS listings, quantile_cont(price_per_sqm, 0.5) AS median_ppsqm,
round(avg(price_per_sqm), 6) AS avg_ppsqm, count(DISTINCT city) AS cities FROM """


def _kpi(df):
    row = dashboard.kpi_row(df)
    return row.select("listings", "median_ppsqm", r6("avg_ppsqm").alias("avg_ppsqm"), "cities")


@query("kpi_row", f"WITH {OBS} {KPI} obs")
def kpi_row(spark, sf_dir):
    return _kpi(listings(spark, sf_dir, published=False))


@query("kpi_row_filtered", f"WITH {OBS}, {FILTERED} {KPI} f")
def kpi_row_filtered(spark, sf_dir):
    return _kpi(filtered(spark, sf_dir))


@query(
    "median_ppsqm_by_city",
    f"""WITH {OBS} SELECT city, quantile_cont(price_per_sqm, 0.5) AS median_ppsqm
    FROM obs WHERE price_per_sqm IS NOT NULL GROUP BY city""",
)
def median_ppsqm_by_city(spark, sf_dir):
    medians = dashboard.median_by_city(listings(spark, sf_dir, published=False))
    return medians.select("city", "median_ppsqm")


RUN_PARTS = 3  # batches the days come in


def daily_runs(spark, sf_dir):
    """Runs of values built up from batches of days; the last batch is written twice, wrongly at first."""
    rows = listings(spark, sf_dir, published=False).withColumn("part", F.pmod(F.dayofyear("scraped_at"), F.lit(RUN_PARTS)))
    runs = stored(dashboard.value_runs(rows, keys=("part", "city")), "runs")
    days = [runs.where(F.col("part") == k).drop("part") for k in range(RUN_PARTS)]
    wrong = days[2].withColumn("v", F.col("v") * 2)
    total = dashboard.add_runs(dashboard.add_runs(days[0], days[1]), wrong)
    return dashboard.add_runs(total, days[2], wrong)


@query("kpi_row_of_runs", f"WITH {OBS} {KPI} obs")
def kpi_row_of_runs(spark, sf_dir):
    row = dashboard.kpi_of_runs(stored(daily_runs(spark, sf_dir), "total"))
    return row.select("listings", "median_ppsqm", r6("avg_ppsqm").alias("avg_ppsqm"), "cities")


@query(
    "median_by_city_of_runs",
    f"""WITH {OBS} SELECT city, quantile_cont(price_per_sqm, 0.5) AS median_ppsqm
    FROM obs WHERE price_per_sqm IS NOT NULL GROUP BY city""",
)
def median_by_city_of_runs(spark, sf_dir):
    return dashboard.median_by_city_of_runs(stored(daily_runs(spark, sf_dir), "total")).select("city", "median_ppsqm")


@query(
    "listings_by_month",
    f"""WITH {OBS} SELECT CAST(CAST(date_trunc('month', published_at) AS DATE) AS VARCHAR) AS month,
    count(*) AS listings FROM obs WHERE published_at IS NOT NULL GROUP BY 1""",
)
def listings_by_month(spark, sf_dir):
    obs = observations(spark, sf_dir, part=False, published=True)
    return dashboard.listings_by_month(obs).withColumn("month", F.col("month").cast("string"))


@query(
    "ppsqm_histogram",
    f"""WITH {OBS}, v AS (SELECT price_per_sqm AS v FROM obs WHERE price_per_sqm IS NOT NULL),
    b AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
    h AS (SELECT CASE WHEN hi > lo THEN least(floor((v - lo) / (hi - lo) * 30), 29) ELSE 0 END AS bin, lo, hi FROM v, b)
    SELECT CAST(bin AS INTEGER) AS bin, round(min(lo) + bin * ((min(hi) - min(lo)) / 30), 6) AS bin_from,
    round(CASE WHEN bin = 29 THEN min(hi) ELSE min(lo) + (bin + 1) * ((min(hi) - min(lo)) / 30) END, 6) AS bin_to,
    count(*) AS listings FROM h GROUP BY bin""",
)
def ppsqm_histogram(spark, sf_dir):
    h = dashboard.histogram(observations(spark, sf_dir))
    return h.select("bin", r6("bin_from").alias("bin_from"), r6("bin_to").alias("bin_to"), "listings")


@query(
    "top_listings",
    f"""WITH {OBS} SELECT listing_title, city, address, property_type, round(price_php, 2) AS price_php, area_sqm,
    price_per_sqm, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
    strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at, url FROM obs
    ORDER BY obs.published_at DESC NULLS LAST, url, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice LIMIT 25""",
)
def top_listings(spark, sf_dir):
    top = dashboard.top_listings(listings(spark, sf_dir), ties=("url", *TIES))
    return top.select(
        "listing_title", "city", "address", "property_type", F.round("price_php", 2).alias("price_php"),
        "area_sqm", "price_per_sqm", ts_text("published_at").alias("published_at"),
        ts_text("scraped_at").alias("scraped_at"), "url",
    )


@query(
    "listings_by_source",
    f"""WITH {OBS} SELECT raw_url, listing_title, address, city, round(price_php, 2) AS price_php,
    strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at FROM obs WHERE source = 'O'""",
)
def listings_by_source(spark, sf_dir):
    stored = listings(spark, sf_dir).drop("city", "url").withColumnRenamed("raw_url", "url")
    picked = dashboard_listings(stored, "O", CITY)
    return picked.select(
        F.col("url").alias("raw_url"), "listing_title", "address", "city",
        F.round("price_php", 2).alias("price_php"), ts_text("scraped_at").alias("scraped_at"),
    )


# --- search -------------------------------------------------------------------

FILTERS = {
    "source": "F",
    "property_type": "SMALL",
    "min_price": 0,
    "max_price": 90000.0,
    "min_area": 2,
    "max_area": 40,
    "published_from": "1995-01-01T00:00:00+00:00",
    "published_to": "2001-01-01T00:00:00+00:00",
    "q": "R_n",
}
FOUND = """
found AS (SELECT * FROM obs WHERE source = 'F' AND property_type = 'SMALL' AND price_php >= 0
  AND price_php <= 90000 AND area_sqm >= 2 AND area_sqm <= 40 AND published_at >= TIMESTAMP '1995-01-01'
  AND published_at <= TIMESTAMP '2001-01-01' AND listing_title ILIKE '%R_n%')
"""


def found(spark, sf_dir):
    obs = observations(spark, sf_dir, address=True, published=True).withColumn("description", F.lit(None).cast("string"))
    return dashboard.search_filter(obs, FILTERS)


SEARCHED = f"""
WITH {OBS}, {FOUND} SELECT url, listing_title, round(price_php, 2) AS price_php, area_sqm, price_per_sqm, address, property_type,
    strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at FROM found
    ORDER BY found.scraped_at DESC NULLS FIRST, url, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice
"""


def shown(page):
    return page.drop(*TIES).withColumns(
        {
            "price_php": F.round("price_php", 2),
            "published_at": ts_text("published_at"),
            "scraped_at": ts_text("scraped_at"),
        }
    )


@query("search_page", SEARCHED + "LIMIT 5 OFFSET 5")
def search_page(spark, sf_dir):
    """The second page, asked for by the last row of the first."""
    ties, rows = ("url", *TIES), found(spark, sf_dir)
    first = dashboard.search_page(rows, None, 5, ties).collect()
    after = first[-1].asDict() if first else None
    return shown(dashboard.search_page(rows, after, 5, ties))


@query("search_page_by_number", SEARCHED + "LIMIT 5 OFFSET 10")
def search_page_by_number(spark, sf_dir):
    return shown(dashboard.numbered_page(found(spark, sf_dir), 3, 5, ("url", *TIES)))


@query("search_total", f"WITH {OBS}, {FOUND} SELECT count(*) AS total FROM found")
def search_total(spark, sf_dir):
    return dashboard.search_total(found(spark, sf_dir))


@query(
    "text_search",
    "SELECT doc_id, lang, n_chars FROM documents WHERE text ILIKE '%Tion_the%' OR source ILIKE '%Tion_the%'",
)
def text_search(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    named = documents.withColumnsRenamed({"source": "listing_title", "text": "description"})
    return dashboard.search_filter(named, {"q": "Tion_the"}).select("doc_id", "lang", "n_chars")


@query(
    "text_search_indexed",
    "SELECT doc_id, lang, n_chars FROM documents WHERE text ILIKE '%Tion_the%' OR source ILIKE '%Tion_the%'",
)
def text_search_indexed(spark, sf_dir):
    """The same search by trigram postings: only texts on all of its lists are read."""
    path = scratch_path(spark, "text-index")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text", "source")
    textindex.write_index(spread(documents), ["text", "source"], path)
    return textindex.search(spark, path, "Tion_the", ["text", "source"]).select("doc_id", "lang", "n_chars")
