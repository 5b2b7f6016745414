"""Captured pages: links, walks, fields, JSON-LD, outcomes. Sections B, E02, E05, G05."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from checks.registry import query
from checks.standin import now, r6, spread, table, ts_text
from plotwise.functions.html import strict_blocks
from plotwise.functions.urls import canonical_url, with_page_number, with_resolved
from plotwise.operators import dedupe, discovery, extract, jsonld, quality
from plotwise.plans import details, discovery as discovery_plan
from plotwise.session import scratch_path
from plotwise.sources import staged, tables
from plotwise.sql import register

def plain_text(html: str) -> str:
    """SQL: the entities the pages use, decoded as a browser does ('&amp' needs no ';')."""
    for entity, char in (("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&amp", "&")):
        html = f"replace({html}, '{entity}', '{char}')"
    return html


H1 = plain_text("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")
AD = plain_text("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")
LANG = r"^https?://[^/]+/([a-z]+)"
BARE = "regexp_replace(url, '[?#].*$', '')"


def pages(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages")).withColumn("portal", F.regexp_extract("url", LANG, 1))


# --- URLs ---------------------------------------------------------------------


@query("canonical_urls", f"SELECT page_id, rtrim({BARE}, '/') AS url FROM pages")
def canonical_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", canonical_url(F.col("url")).alias("url"))


@query(
    "resolved_links",
    f"""SELECT page_id, regexp_extract(url, '^https?://[^/?#]+') || '/a/c?x=1' AS rooted, 'https://b.example.org/z' AS absolute,
    {BARE} || '?page=3' AS query_only, regexp_extract(url, '^https?:') || '//cdn.example.org/i' AS host_only,
    regexp_extract(url, '^(https?://[^?#]*/)', 1) || 'next' AS beside FROM pages""",
)
def resolved_links(spark, sf_dir):
    links = {
        "rooted": "/a/./b/../c?x=1",
        "absolute": "https://b.example.org/z",
        "query_only": "?page=3",
        "host_only": "//cdn.example.org/i",
        "beside": "./next",
    }
    df = table(spark, sf_dir, "pages")
    for name, href in links.items():
        df = with_resolved(df, name, F.col("url"), F.lit(href))
    return df.select("page_id", *links)


@query(
    "page_param",
    """SELECT page_id, regexp_extract(url, '^[^?#]*') || CASE WHEN url LIKE '%?page=2&ref=x%' THEN '?page=9&ref=x'
    WHEN url LIKE '%?utm_source=feed%' THEN '?utm_source=feed&page=9' ELSE '?page=9' END ||
    CASE WHEN url LIKE '%#top' THEN '#top' ELSE '' END AS url FROM pages""",
)
def page_param(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", with_page_number(F.col("url"), F.lit(9)).alias("url"))


# --- discovery ----------------------------------------------------------------

LINKS = f"""
raw AS (SELECT page_id, regexp_extract(url, '{LANG}', 1) AS portal, regexp_extract(url, '^https?://[^/?#]+') AS origin,
    regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages),
links AS (SELECT page_id, portal, CAST(i - 1 AS INTEGER) AS pos, rtrim(origin || hrefs[i], '/') AS url
    FROM (SELECT *, unnest(range(1, len(hrefs) + 1)) AS i FROM raw))
"""


def links(spark, sf_dir):
    results = discovery.read_result_pages(pages(spark, sf_dir), "nav li > a[href^='/']", None)
    return discovery.listing_links(results).withColumnRenamed("page_id", "page_no")


@query("page_links", f"WITH {LINKS} SELECT page_id AS page_no, pos, url FROM links")
def page_links(spark, sf_dir):
    return links(spark, sf_dir).select("page_no", "pos", "url")


FIRST = f"""
WITH {LINKS}, by_site AS (SELECT portal, regexp_replace(url, '^https?://[^/]+', '') AS url, page_id, pos FROM links),
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY portal, url ORDER BY page_id, pos) AS rn FROM by_site)
  WHERE rn = 1)
"""


def first_links(spark, sf_dir):
    """Paths stand for listing URLs, so that one of them is found on very many pages."""
    paths = links(spark, sf_dir).withColumn("url", F.regexp_replace("url", "^https?://[^/]+", ""))
    return dedupe.first_discovered(paths.select("portal", "url", "page_no", "pos"))


@query("first_discovered", FIRST + "SELECT portal, url, page_id AS page_no, pos FROM first")
def first_discovered(spark, sf_dir):
    return first_links(spark, sf_dir).select("portal", "url", "page_no", "pos")


@query(
    "capped_discovery",
    FIRST
    + """SELECT portal, url, page_id AS page_no, pos FROM (SELECT *, row_number() OVER (PARTITION BY portal
    ORDER BY page_id, pos, url) AS place FROM first) WHERE place <= 20""",
)
def capped_discovery(spark, sf_dir):
    return dedupe.cap_discovered(first_links(spark, sf_dir), 20).select("portal", "url", "page_no", "pos")


@query(
    "discovery_summary",
    FIRST
    + """, reg AS (SELECT DISTINCT portal FROM raw UNION ALL SELECT 'it')
    SELECT reg.portal, count(first.url) AS urls, 0 AS is_total FROM reg LEFT JOIN first USING (portal) GROUP BY 1
    UNION ALL SELECT NULL, (SELECT count(*) FROM first), 1""",
)
def discovery_summary(spark, sf_dir):
    registry = pages(spark, sf_dir).select("portal").distinct()
    registry = registry.unionByName(spark.createDataFrame([("it",)], "portal string"))
    return quality.require_discovered(quality.discovery_summary(registry, first_links(spark, sf_dir)))


PAGER = """
pager AS (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS bare,
  CASE WHEN page_id % 7 = 0 THEN 'TRUE' WHEN page_id % 7 = 1 THEN '1' ELSE 'false' END AS islast FROM pages)
"""


def pager_pages(spark, sf_dir):
    """The pages with a pagination link added, some of them marked as the last."""
    k = F.col("page_id") % 7
    last = F.when(k == 0, "TRUE").when(k == 1, "1").otherwise("false")
    href = F.when(k == 2, "").otherwise(F.concat(F.lit("?page="), F.col("page_id").cast("string")))
    pager = F.concat(
        F.lit('<div class="pager"><a data-test="pagination-next" href="'), href, F.lit('" data-islast="'), last, F.lit('">›</a></div>')
    )
    return pages(spark, sf_dir).withColumn("html", F.concat("html", pager))


@query(
    "next_links",
    f"""WITH {PAGER} SELECT page_id, CASE WHEN islast = 'false' AND page_id % 7 <> 2 THEN bare || '?page=' || page_id END
    AS next_url FROM pager""",
)
def next_links(spark, sf_dir):
    results = discovery.read_result_pages(pager_pages(spark, sf_dir), "a[href*='/property/']")
    return discovery.next_links(results).select("page_id", "next_url")


# Result pages of five sites: the next page is five pages on, the last one says so.
SITES = """
site AS (SELECT page_id, page_id % 5 AS k, 'https://s' || page_id % 5 || '.example.com' AS origin, html FROM pages),
edges AS (SELECT a.page_id, a.k, a.origin || '/results/' || a.page_id AS url, b.page_id AS next_id
  FROM site a LEFT JOIN site b ON b.page_id = a.page_id + 5)
"""
WALK = f"""
WITH RECURSIVE {SITES}, walk AS (SELECT k, page_id, 0 AS page_no FROM edges WHERE page_id < 5
  UNION ALL SELECT w.k, e.next_id, w.page_no + 1 FROM walk w JOIN edges e USING (page_id) WHERE e.next_id IS NOT NULL {{cap}})
SELECT 'portal_' || w.k AS portal, e.url, CAST(page_no AS BIGINT) AS page_no FROM walk w JOIN edges e USING (page_id)
"""


def paged(spark, sf_dir):
    """The pages as result pages with a next link of their own, each captured twice.

    The older capture has links that must not count.
    """
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    k = (F.col("page_id") % 5).cast("string")
    at = F.concat(F.lit("https://s"), k, F.lit(".example.com/results/"), F.col("page_id").cast("string"))
    after = p.select((F.col("page_id") - 5).alias("page_id"), F.lit(True).alias("_more"))
    linked = spread(p.join(after, "page_id", "left"))
    more = F.concat(
        F.lit('<a class="more" data-islast="'), F.when(F.col("_more"), "false").otherwise("TRUE"), F.lit('" href="'),
        F.when(F.col("_more"), (F.col("page_id") + 5).cast("string")).otherwise("/results/0"), F.lit('">more</a>'),
    )
    html = F.when(F.col("captured_at") == 1, F.concat("html", more)).otherwise('<nav><ul><li><a href="/old">x</a></ul></nav>')
    both = linked.withColumn("captured_at", F.explode(F.array(F.lit(0), F.lit(1))))
    return both.select("page_id", at.alias("url"), html.alias("html"), "captured_at")


def walk_input(spark, sf_dir):
    """The next links that the pages themselves hold, and five seeds."""
    results = discovery.read_result_pages(paged(spark, sf_dir), "a", "a.more")
    found = discovery.next_links(results).select("page_id", "url", "next_url")
    seeds = found.where("page_id < 5").select(F.concat(F.lit("portal_"), F.col("page_id").cast("string")).alias("portal"), "url")
    return found.select("url", "next_url"), seeds.distinct()


@query("pagination_walk", WALK.format(cap=""))
def pagination_walk(spark, sf_dir):
    return discovery.walk_pages(*walk_input(spark, sf_dir))


@query("pagination_walk_capped", WALK.format(cap="AND w.page_no < 10"))
def pagination_walk_capped(spark, sf_dir):
    return discovery.walk_pages(*walk_input(spark, sf_dir), max_pages=11)


# Five registry entries with selectors and caps of their own: selector, cap, links it means
# (of those in a page's list, i from 0 of n).
FIVE = (
    ("nav li > a[href^='/']", 10, "true"),
    ("nav li:first-child > a", 0, "i = 0"),
    ("nav a[href]", 7, "true"),
    ("ul > li:nth-child(2) a", 0, "i = 1"),
    ("nav li + li:last-child a", 0, "i = n - 1 AND n > 1"),
)
DISCOVERED = f"""
WITH RECURSIVE {SITES}, walk AS (SELECT k, page_id, 0 AS page_no FROM edges WHERE page_id < 5
  UNION ALL SELECT w.k, e.next_id, w.page_no + 1 FROM walk w JOIN edges e USING (page_id)
  WHERE e.next_id IS NOT NULL AND w.page_no + 1 < CASE w.k {" ".join(f"WHEN {k} THEN {cap or 10**9}" for k, (_, cap, _) in enumerate(FIVE))} END),
raw AS (SELECT page_id, origin, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM site),
listed AS (SELECT page_id, i, len(hrefs) AS n, rtrim(origin || hrefs[i + 1], '/') AS url
  FROM (SELECT *, unnest(range(len(hrefs))) AS i FROM raw)),
seen AS (SELECT 'portal_' || k AS portal, url, page_no, CASE WHEN k IN (0, 2) THEN i ELSE 0 END AS pos
  FROM walk JOIN listed USING (page_id)
  WHERE CASE k {" ".join(f"WHEN {k} THEN {means}" for k, (_, _, means) in enumerate(FIVE))} END)
SELECT portal, url, CAST(page_no AS BIGINT) AS page_no, CAST(pos AS INTEGER) AS pos FROM seen
QUALIFY row_number() OVER (PARTITION BY portal, url ORDER BY page_no, pos) = 1
"""


def five_portals(spark, sf_dir):
    """Registry entries as JSON documents, one per seed."""
    seeds = paged(spark, sf_dir).where("page_id < 5 AND captured_at = 1")
    rest = F.array(*[F.lit(f'"max_pages":{cap},"listing_selector":"{selector}"') for selector, cap, _ in FIVE])
    doc = F.concat(
        F.lit('{"portal_name":"portal_'), F.col("page_id").cast("string"), F.lit('","seed_urls":["'), "url",
        F.lit('"],"pagination_selector":"a.more",'), F.get(rest, F.col("page_id").cast("int")), F.lit("}"),
    )
    return tables.portals(tables.registry_entries(seeds.select(doc.alias("value"))))


@query("discovery_job", DISCOVERED)
def discovery_job(spark, sf_dir):
    """Registry, walks, links, first sighting, caps and the staged files, read back."""
    base = scratch_path(spark, "discovery")
    registry = five_portals(spark, sf_dir)
    found = discovery_plan.run_discovery(paged(spark, sf_dir).drop("page_id"), registry, base, "r1", now())
    staged_urls = staged.read_staged(spark, base, "urls").select("portal", "url")
    return found.join(staged_urls, ["portal", "url"]).select("portal", "url", "page_no", "pos")


# --- fields -------------------------------------------------------------------


@query(
    "page_titles",
    f"SELECT page_id, trim({H1}) AS title FROM pages",
)
def page_titles(spark, sf_dir):
    read = extract.read_details(pages(spark, sf_dir))
    return read.select("page_id", extract.cascade(F.col("page")["found"], "title").alias("title"))


SELECTORS = {
    "title": "h1",
    "ad": "body > div.ad",
    "links": "nav ul li a[href]",
    "price": ".price, .Price__Value",
    "closed_bold": "article p b",
    "second_item": "li:nth-child(2)",
    "first_item": "ul > li:first-child > a",
    "last_item": "nav li:last-child",
    "not_root": "a:not([href='/'])",
    "after_title": "h1 + p",
    "beside_title": "h1 ~ p:not(.x)",
    "any_case": "DIV[class='AD' i]",
    "broken": "div[[",
    "beyond": "li:has(a)",
}
TIED = {  # SQL on a page's text that is true where the selector matches; the pages' own markup
    "title": "html LIKE '%<h1>%'",
    "ad": "html LIKE '%<div class=\"ad\">%'",
    "links": "html LIKE '%<a href=%'",
    "price": "false",
    "closed_bold": "html LIKE '%<b>%'",
    "second_item": "len(regexp_extract_all(html, '<li>')) > 1",
    "first_item": "html LIKE '%<li><a href=%'",
    "last_item": "html LIKE '%<li>%'",
    "not_root": "len(list_filter(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), lambda h: h <> '/')) > 0",
    "after_title": "regexp_matches(html, '</h1>\\s*<p')",
    "beside_title": "regexp_matches(html, '(?s)</h1>.*<p')",
    "any_case": "html LIKE '%<div class=\"ad\">%'",
    "broken": "NULL",
    "beyond": "NULL",
}


@query(
    "selector_coverage",
    f"""WITH p AS (SELECT regexp_extract(url, '{LANG}', 1) AS portal, html FROM pages),
    hits AS (SELECT portal, s.selector, CASE s.selector {" ".join(f"WHEN '{n}' THEN {t}" for n, t in TIED.items())} END AS hit
      FROM p, (SELECT unnest([{", ".join(f"'{n}'" for n in TIED)}]) AS selector) s)
    SELECT portal, selector, count(*) AS pages, count(*) FILTER (hit) AS matched,
    CASE WHEN count(hit) > 0 THEN round(count(*) FILTER (hit) / count(hit), 6) END AS coverage,
    CASE WHEN count(hit) > 0 THEN 'supported' ELSE 'unsupported' END AS status FROM hits GROUP BY 1, 2""",
)
def selector_coverage(spark, sf_dir):
    hits = extract.selector_hits(pages(spark, sf_dir), SELECTORS, ["portal"])
    return extract.selector_coverage(hits, ["portal"]).withColumn("coverage", r6("coverage"))


@query(
    "field_map",
    f"""SELECT page_id, trim({H1}) AS headline, trim(regexp_replace({AD}, '\\s+', ' ', 'g')) AS price_raw,
    CAST(NULL AS DOUBLE) AS price_value, (CASE WHEN html LIKE '%<a href=%' THEN 1 ELSE 0 END) AS has_first_link FROM pages""",
)
def field_map(spark, sf_dir):
    read = extract.configured_fields(
        pages(spark, sf_dir), {"headline": "article > h1", "price": "div.ad", "area": "nav li", "_wait": "h1"}
    )
    return read.select(
        "page_id", F.col("fields")["headline"].alias("headline"), F.col("price")["raw"].alias("price_raw"),
        F.col("price")["value"].alias("price_value"), F.col("area").isNotNull().cast("int").alias("has_first_link"),
    )


@query(
    "sql_functions",
    f"""SELECT page_id, rtrim({BARE}, '/') AS url, sha256(rtrim({BARE}, '/')) AS listing_id,
    CAST(regexp_extract(url, '[0-9]+') AS INTEGER) AS number, trim({H1}) AS title,
    len(regexp_extract_all(html, '<li>')) AS items FROM pages""",
)
def sql_functions(spark, sf_dir):
    """Rules and page elements called from SQL text."""
    register(spark)
    table(spark, sf_dir, "pages").createOrReplaceTempView("captured")
    return spark.sql("""
        WITH said AS (
          SELECT key, normalize_text(min_by(text, start) FILTER (WHERE tag = 'h1')) AS title, count_if(tag = 'li') AS items
          FROM page_elements(TABLE(SELECT page_id, html FROM captured)) GROUP BY key)
        SELECT page_id, canonical_url(url) AS url, listing_id(canonical_url(url)) AS listing_id, first_integer(url) AS number,
          title, items
        FROM captured JOIN said ON key = CAST(page_id AS STRING)""")


# --- listing pages made from part rows -----------------------------------------
# k = p_partkey % 6 picks the markup of a page, so that each cascade step is taken


PAGE_TIMES = 64  # a part takes about ten bytes of its file, its page hundreds


def listing_pages(spark, sf_dir, with_gaps=False):
    k, s = F.col("p_partkey") % 6, F.col
    size = s("p_size").cast("string")
    price = F.format_number(F.floor(s("p_retailprice")), 0)
    day = F.date_add(F.lit("2023-01-01").cast("date"), (s("p_partkey") % 700).cast("int"))
    title = (
        F.when(k == 0, F.concat(F.lit("<h1 class=x>no</h1><h1 data-testid='ad-title'> "), s("p_name"), F.lit(" &amp; co</h1>")))
        .when(k == 1, F.concat(F.lit("<h1><b>"), s("p_name"), F.lit("</b><!-- x -->&nbsp;<i>co</i></h1>")))
        .when(k == 2, F.concat(F.lit("<h1>&nbsp;</h1>")))
        .otherwise(F.concat(F.lit("<H1 CLASS='listing-title'>"), s("p_name"), F.lit("</H1>")))
    )
    meta = F.concat(
        F.lit("<meta property='og:title' content='Meta "), s("p_name"), F.lit("'>"),
        F.when(k == 3, F.concat(F.lit("<meta property=\"product:price:amount\" content=\""), price, F.lit("\">"))).otherwise(""),
    )
    shown = (
        F.when(k == 0, F.concat(F.lit("<span data-testid=ad-price>₱ "), price, F.lit(" / Month</span>")))
        .when(k == 1, F.concat(F.lit("<div class='big price'>Php "), price, F.lit(".75</div>")))
        .when(k == 2, "<div class=price>call us</div>")
        .otherwise("")
    )
    published = (
        F.when(k == 0, F.concat(F.lit("<span class='meta'>Posted "), F.date_format(day, "dd MMMM yyyy"), F.lit("</span>")))
        .when(k == 1, F.concat(F.lit("<time datetime='"), F.date_format(day, "yyyy-MM-dd"), F.lit("'>x</time>")))
        .when(k == 2, F.concat(F.lit("<p class=date>"), F.date_format(day, "d MMM yyyy"), F.lit("</p>")))
        .otherwise("")
    )
    offer = F.concat(
        F.lit('{"@type":"Offer","priceCurrency":"PHP","price":"'), price, F.lit('","datePublished":"'),
        F.date_format(day, "yyyy-MM-dd"), F.lit('T12:00:00+08:00"}'),
    )
    product = F.concat(F.lit('{"@graph":[{"@type":["Thing","Product"],"category":"'), s("p_type"), F.lit('"}]}'))
    script = (
        F.when(k == 2, F.concat(product, F.lit("\n"), offer))
        .when(k == 4, F.concat(F.lit('[{"@type":"Offer","offers":{"price":'), s("p_size").cast("string"), F.lit(',"priceCurrency":"USD"}}]')))
        .when(k == 5, F.concat(offer, F.lit("\n{broken")))
        .otherwise(product)
    )
    body = F.concat(
        F.lit("<html><head><title>Rent</title>"), meta, F.lit("<script type='application/ld+json'>"), script,
        F.lit("</script></head><body>"), title, shown, F.lit("<p class=address>"), s("p_brand"), F.lit(" St<p>"),
        F.when(k != 5, F.concat(size, F.lit(",5 SQM floor"))).otherwise("serviced office"), published,
        F.lit("<section data-testid='description'>Room <br>for "), s("p_container"), F.lit("</section></body></html>"),
    )
    if with_gaps:
        g = F.col("p_partkey") % 10
        body = F.when(g == 0, None).when(g == 1, "").when(g == 2, F.lit("<html><body><p>gone</p></body></html>")).otherwise(body)
    part = spread(table(spark, sf_dir, "part"), PAGE_TIMES).withColumn("p_container", F.reverse("p_name"))
    url = F.concat(F.lit("https://p.example.com/property/"), F.col("p_partkey").cast("string"))
    return part.select("p_partkey", url.alias("url"), body.alias("html"))


MADE = """
made AS (SELECT *, p_partkey % 6 AS k, floor(p_retailprice) AS pr, format('{:,}', CAST(floor(p_retailprice) AS BIGINT)) AS prt,
  DATE '2023-01-01' + CAST(p_partkey % 700 AS INTEGER) AS day, 'https://p.example.com/property/' || p_partkey AS url FROM part)
"""


@query(
    "detail_records",
    f"""WITH {MADE} SELECT url,
    CASE k WHEN 0 THEN p_name || ' & co' WHEN 1 THEN p_name || ' co' WHEN 2 THEN 'Meta ' || p_name ELSE p_name END AS title,
    p_brand || ' St' AS address, 'Room for ' || reverse(p_name) AS description,
    CASE WHEN k IN (0, 1, 3) THEN p_type WHEN k = 2 THEN p_type WHEN k = 4 THEN 'Offer' ELSE 'Offer' END AS property_type,
    CASE k WHEN 0 THEN '₱ ' || prt || ' / Month' WHEN 1 THEN 'Php ' || prt || '.75' WHEN 2 THEN 'call us' WHEN 3 THEN prt
      WHEN 4 THEN CAST(p_size AS VARCHAR) ELSE prt END AS price_raw,
    CASE k WHEN 3 THEN NULL WHEN 4 THEN 'USD' ELSE 'PHP' END AS price_currency,
    CASE k WHEN 0 THEN pr WHEN 1 THEN pr + 0.75 WHEN 4 THEN p_size ELSE pr END AS price_value,
    CASE WHEN k = 0 THEN 'month' END AS price_period,
    CASE WHEN k <> 5 THEN p_size || ',5 SQM' END AS area_raw,
    CASE WHEN k <> 5 THEN CAST(p_size * 10 + 5 AS DOUBLE) END AS area_sqm,
    CASE k WHEN 0 THEN 'Posted ' || strftime(day, '%d %B %Y') WHEN 1 THEN strftime(day, '%Y-%m-%d') WHEN 2 THEN strftime(day, '%-d %b %Y')
      WHEN 5 THEN strftime(day, '%Y-%m-%d') || 'T12:00:00+08:00' END AS published_at_text,
    CASE WHEN k IN (0, 2) THEN strftime(CAST(day AS TIMESTAMP) - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')
      WHEN k = 5 THEN strftime(CAST(day AS TIMESTAMP) + INTERVAL 4 HOUR, '%Y-%m-%d %H:%M:%S') END AS published_at
    FROM made""",
)
def detail_records(spark, sf_dir):
    read = extract.read_details(listing_pages(spark, sf_dir))
    records = extract.detail_records(read, now(), "Asia/Manila")
    return records.select(
        "url", "title", "address", "description", "property_type", F.col("price")["raw"].alias("price_raw"),
        F.col("price")["currency"].alias("price_currency"), F.col("price")["value"].alias("price_value"),
        F.col("price")["period"].alias("price_period"), F.col("area")["raw"].alias("area_raw"),
        F.col("area")["sqm"].alias("area_sqm"), "published_at_text", ts_text("published_at").alias("published_at"),
    )


@query(
    "lenient_detail_dates",
    f"""WITH {MADE} SELECT url, CASE WHEN k IN (0, 2) THEN strftime(CAST(day AS TIMESTAMP) - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')
      WHEN k = 1 THEN strftime(day, '%Y-%m-%d %H:%M:%S')
      WHEN k = 5 THEN strftime(CAST(day AS TIMESTAMP) + INTERVAL 4 HOUR, '%Y-%m-%d %H:%M:%S') END AS published_at FROM made""",
)
def lenient_detail_dates(spark, sf_dir):
    read = extract.read_details(listing_pages(spark, sf_dir))
    records = extract.detail_records(read, now(), "Asia/Manila", lenient_dates=True)
    return records.select("url", ts_text("published_at").alias("published_at"))


def scripts(spark, sf_dir):
    """One ld+json text per event: nested, listed, glued, or followed by a broken piece."""
    k, e = F.col("event_id") % 4, F.col
    inner = F.concat(F.lit('{"@type":"Offer","price":'), e("value").cast("string"), F.lit(',"priceCurrency":"PHP"}'))
    text = (
        F.when(k == 0, F.concat(F.lit('{"@type":"Product","name":"'), e("event_type"), F.lit('","offers":'), inner, F.lit("}")))
        .when(k == 1, F.concat(F.lit('[{"x":1},{"@type":["Thing","Product"],"deep":{"list":['), inner, F.lit(",2]}}]")))
        .when(k == 2, F.concat(F.lit('{"a":1}\n'), inner))
        .otherwise(F.concat(inner, F.lit("\n{broken")))
    )
    return spread(table(spark, sf_dir, "events")).select("event_id", "value", F.array(text, F.lit(" ")).alias("scripts"))


@query(
    "jsonld_nodes",
    """SELECT event_id, b AS block, n AS node, t AS types FROM (
    SELECT event_id, unnest(CASE event_id % 4
      WHEN 0 THEN [{b: 0, n: 0, t: 'Product'}, {b: 0, n: 1, t: 'Offer'}]
      WHEN 1 THEN [{b: 0, n: 0, t: ''}, {b: 0, n: 1, t: 'Thing,Product'}, {b: 0, n: 2, t: ''}, {b: 0, n: 3, t: 'Offer'}]
      WHEN 2 THEN [{b: 0, n: 0, t: ''}, {b: 1, n: 0, t: 'Offer'}]
      ELSE [{b: 0, n: 0, t: 'Offer'}] END, recursive := true) FROM events)""",
)
def jsonld_node_rows(spark, sf_dir):
    """Every object of every block, numbered in document order."""
    nodes = jsonld.jsonld_nodes(scripts(spark, sf_dir), strict_blocks("scripts"), ["event_id"])
    node = F.row_number().over(Window.partitionBy("event_id", "block").orderBy("path")) - 1
    return nodes.select("event_id", "block", node.alias("node"), F.array_join("types", ",").alias("types"))


@query(
    "jsonld_offers",
    """SELECT event_id, CASE WHEN value <> 0 THEN CAST(value AS DOUBLE) END AS price,
    CASE WHEN true THEN 'PHP' END AS currency, CASE event_id % 4 WHEN 0 THEN 'Product' WHEN 1 THEN 'Product' ELSE 'Offer' END AS kind
    FROM events""",
)
def jsonld_offers(spark, sf_dir):
    rows = scripts(spark, sf_dir)
    nodes = jsonld.jsonld_nodes(rows, strict_blocks("scripts"), ["event_id"])
    sets = {"offer": ("Offer",), "node": ("Product", "Offer")}
    rows = rows.select("event_id").join(jsonld.first_typed(nodes, ["event_id"], sets), "event_id", "left")
    offer = extract.offer_columns(F.col("offer"))
    kinds = F.try_variant_get("node", '$["@type"]', "array<string>")
    kind = F.coalesce(F.element_at(kinds, -1), F.try_variant_get("node", '$["@type"]', "string"))
    return rows.select(
        "event_id", offer["__offer_price"].try_cast("double").alias("price"), offer["__offer_currency"].alias("currency"),
        kind.alias("kind"),
    )


# --- staged urls against pages ------------------------------------------------

OUTCOMES = """
o AS (SELECT l_linestatus AS portal, 'https://p.example.com/property/' || l_partkey AS url,
  CASE WHEN l_partkey % 10 IN (0, 1) THEN 'no_html' WHEN l_partkey % 10 = 2 THEN 'missing_title' ELSE 'ok' END AS outcome
  FROM lineitem)
"""


def outcomes(spark, sf_dir):
    """Every lineitem stages its part's URL; a tenth of the pages was captured without HTML."""
    url = F.concat(F.lit("https://p.example.com/property/"), F.col("l_partkey").cast("string"))
    urls = table(spark, sf_dir, "lineitem").select(
        url.alias("url"), F.col("l_linestatus").alias("portal"),
        F.date_format("l_shipdate", "yyyy").alias("run"),
    )
    captured = listing_pages(spark, sf_dir, with_gaps=True)
    return details.detail_outcomes(urls, captured, now(), "Asia/Manila")


@query(
    "urls_to_pages",
    f"WITH {OUTCOMES} SELECT url, portal, outcome, count(*) AS staged FROM o GROUP BY 1, 2, 3",
)
def urls_to_pages(spark, sf_dir):
    reason = F.coalesce("reason", F.lit("ok")).alias("outcome")
    return outcomes(spark, sf_dir).groupBy("url", "portal", reason).agg(F.count("*").alias("staged"))


@query("detail_outcomes", f"WITH {OUTCOMES} SELECT portal, outcome, count(*) AS urls FROM o GROUP BY 1, 2")
def detail_outcomes(spark, sf_dir):
    return quality.outcome_counts(outcomes(spark, sf_dir), ["portal"])
