"""The discovery job: registry entries and captured pages to staged listing URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plotwise.functions.urls import canonical_url, with_resolved
from plotwise.operators.dedupe import argmax_rows, cap_discovered, first_discovered
from plotwise.operators.discovery import walk_pages
from plotwise.operators.selectors import Rules, elements_of, matches, selector_rules, tokenised
from plotwise.session import cut_lineage
from plotwise.sources.staged import write_staged_urls

TIME = "captured_at"


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _read(tokens: DataFrame, rules: Rules) -> DataFrame:
    """portal, url, next_url, hrefs of tokenised pages, each read with the selectors of its portal.

    tokens has a row per page and portal. Of several captures of a page the latest counts.
    """
    found = matches(elements_of(tokens, F.col("portal")), rules)
    attribute = {n: F.coalesce(F.try_element_at("attrs", F.lit(n)), F.lit("")).alias(n) for n in ("href", "data-islast")}
    paging = found.where("name = 'paging'").groupBy("_page", F.col("scope").alias("portal"))
    paging = paging.agg(F.min_by(F.struct(*attribute.values()), "start").alias("next"))
    listing = found.where("name = 'listing'").select("_page", F.col("scope").alias("portal"), "start", attribute["href"])
    listing = listing.where("href <> ''").groupBy("_page", "portal")
    listing = listing.agg(F.sort_array(F.collect_set(F.struct("start", "href"))).alias("links"))
    read = tokens.drop("_tokens").join(paging, ["_page", "portal"], "left").join(listing, ["_page", "portal"], "left")
    last = F.lower(F.col("next")["data-islast"]).isin("true", "1")
    read = with_resolved(read, "next_url", F.col("url"), F.when(~last & (F.col("next.href") != ""), F.col("next.href")))
    read = read.withColumn("hrefs", F.transform("links", lambda link: link["href"])).drop("next", "links", "_page", "host")
    return argmax_rows(read, ["portal", "url"], [TIME])


def _keyed(portal: Column, url: Column) -> Column:
    """A page as one portal sees it: a node of the walk."""
    return F.concat(portal, F.lit("\n"), url)


def discover(pages: DataFrame, portals: DataFrame, max_listings: int = 0) -> DataFrame:
    """portal, url, page_no, pos: the listing URLs of each portal, first sighting each.

    pages(url, html[, captured_at]); portals as typed by sources.tables.portals. A walk
    starts at a portal's first seed and follows its own paging selector for max_pages pages
    (0 or NULL: until there is no next page, or a page that was not captured). Links are
    those of its own listing selector, canonical; max_listings caps each portal.

    Pages on the host of a portal's seed are read, with that portal's selectors; others are
    not opened. Only if a portal's next link leads to a captured page of another host are
    the other hosts' pages read as well, for such portals. The registry goes to the driver.
    """
    wanted = portals.select(
        F.col("portal_name").alias("portal"),
        F.get("seed_urls", F.lit(0)).alias("seed"),
        "listing_selector",
        F.nullif("pagination_selector", F.lit("")).alias("paging"),
        F.coalesce("max_pages", F.lit(0)).alias("max_pages"),
    ).where("seed is not null and listing_selector is not null")
    wanted = cut_lineage(wanted)
    used = wanted.select("portal", "listing_selector", "paging", "max_pages").collect()
    rules = selector_rules(
        [(r["portal"], "listing", r["listing_selector"]) for r in used]
        + [(r["portal"], "paging", r["paging"]) for r in used if r["paging"]]
    )
    caps = [r["max_pages"] for r in used]
    times = F.col(TIME) if TIME in pages.columns else F.lit(0)
    captured = pages.where(F.length("html") > 0).select("url", "html", times.alias(TIME), _host(F.col("url")).alias("host"))
    homes = wanted.select("portal", _host(F.col("seed")).alias("host"))
    tokens = tokenised(captured.join(homes.select("host").distinct(), "host", "left_semi"))
    read = cut_lineage(_read(tokens.join(homes, "host"), rules))

    leaving = read.join(homes, "portal").where(_host(F.col("next_url")) != F.col("host")).select("portal", "next_url")
    leaving = leaving.join(captured.select(F.col("url").alias("next_url")), "next_url", "left_semi")
    strays = sorted(r["portal"] for r in leaving.select("portal").distinct().collect())
    if strays:
        every = tokenised(captured).withColumn("portal", F.explode(F.array(*[F.lit(p) for p in strays])))
        abroad = every.join(homes, ["portal", "host"], "left_anti").select(*every.columns)
        read = cut_lineage(read.unionByName(_read(abroad, rules)))

    steps = read.select(
        _keyed(F.col("portal"), F.col("url")).alias("url"), _keyed(F.col("portal"), F.col("next_url")).alias("next_url")
    )
    seeds = wanted.select("portal", _keyed(F.col("portal"), F.col("seed")).alias("url"))
    walked = walk_pages(steps, seeds, 0 if 0 in caps or not caps else max(caps))
    visited = walked.join(wanted.select("portal", "max_pages"), "portal")
    visited = visited.where((F.col("max_pages") == 0) | (F.col("page_no") < F.col("max_pages"))).select(
        "portal", "page_no", F.substring_index("url", "\n", -1).alias("page_url")
    )
    links = visited.join(read.select("portal", F.col("url").alias("page_url"), "hrefs"), ["portal", "page_url"]).select(
        "portal", "page_url", "page_no", F.posexplode("hrefs").alias("pos", "href")
    )
    links = with_resolved(links, "_full", F.col("page_url"), F.col("href"))
    links = links.select("portal", canonical_url(F.col("_full")).alias("url"), "page_no", "pos")
    return cap_discovered(first_discovered(links.where("url is not null")), max_listings)


def run_discovery(
    pages: DataFrame, portals: DataFrame, base: str, run: str, discovered_at: Column, max_listings: int = 0
) -> DataFrame:
    """Discover, stage, return what was staged. A portal that finds nothing keeps no old file."""
    found = cut_lineage(discover(pages, portals, max_listings)).withColumn("run", F.lit(run))
    ran = portals.select(F.lit(run).alias("run"), F.col("portal_name").alias("portal"))
    write_staged_urls(found, base, discovered_at, ran)
    return found
