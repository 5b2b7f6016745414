"""Listing links and result-page walks over captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plotwise.functions.urls import canonical_url, with_resolved
from plotwise.operators.dedupe import argmax_rows
from plotwise.operators.selectors import Probe, tokenised, with_found, with_links
from plotwise.session import cut_lineage

# The shipped portal's selectors.
LISTING_SELECTOR = "a[href*='/property/']"
PAGINATION_SELECTOR = "a[data-test='pagination-next']"


def read_result_pages(
    pages: DataFrame, listing_selector=LISTING_SELECTOR, pagination_selector=PAGINATION_SELECTOR
) -> DataFrame:
    """pages(url, html, ...) with the html replaced by hrefs and the next-page link."""
    probes = {}
    if pagination_selector:
        probes = {
            "href": Probe(pagination_selector, "@href"),
            "islast": Probe(pagination_selector, "@data-islast"),
        }
    read = with_links(with_found(tokenised(pages), probes), {"links": listing_selector})
    return read.select(
        *[c for c in pages.columns if c != "html"],
        F.coalesce(F.try_element_at("groups", F.lit("links")), F.array().cast("array<string>")).alias("hrefs"),
        F.try_element_at("found", F.lit("href")).alias("next_href"),
        F.try_element_at("found", F.lit("islast")).alias("next_islast"),
    )


def next_links(results: DataFrame) -> DataFrame:
    """results plus next_url: NULL on a last page and where there is no link."""
    last = F.lower(F.coalesce("next_islast", F.lit(""))).isin("true", "1")
    href = F.when(~last & (F.col("next_href") != ""), F.col("next_href"))
    return with_resolved(results, "next_url", F.col("url"), href)


def listing_links(results: DataFrame) -> DataFrame:
    """One row per link of a result page, canonical, with its place on the page."""
    links = results.select("*", F.posexplode("hrefs").alias("pos", "href"))
    links = links.drop("hrefs", "next_href", "next_islast").withColumnRenamed("url", "page_url")
    links = with_resolved(links, "_full", F.col("page_url"), F.col("href"))
    return links.withColumn("url", canonical_url(F.col("_full"))).drop("href", "_full")


def walk_pages(links: DataFrame, seeds: DataFrame, max_pages: int = 0) -> DataFrame:
    """Pages reached from each portal's seed by following next links, with page_no from 0.

    links(url, next_url): one row per captured page; of several one is taken. seeds(portal, url). A page counts
    once, at its first visit, so a loop ends the walk; max_pages 0 means no cap. Each
    round doubles the length of the jumps: n pages take log2(n) rounds of joins on the
    narrow link table. Pages that were not captured stop the walk.
    """
    # several captures of a page count once, so a page has one jump of any length
    captured = argmax_rows(links.select("url", "next_url"), ["url"], [F.col("next_url").isNotNull()])
    jumps = cut_lineage(
        captured.where("next_url is not null")
        .join(captured.select(F.col("url").alias("next_url")), "next_url", "left_semi")
        .select("url", "next_url")
    )
    reached = seeds.join(captured.select("url"), "url", "left_semi").select(
        "portal", "url", F.lit(0).cast("bigint").alias("page_no")
    )
    reached = cut_lineage(reached)
    known, length = reached.count(), 1
    while True:
        if max_pages and length >= max_pages:
            break
        step = reached.join(jumps, "url").select(
            "portal",
            F.col("next_url").alias("url"),
            (F.col("page_no") + F.lit(length)).alias("page_no"),
        )
        reached = cut_lineage(
            reached.unionByName(step).groupBy("portal", "url").agg(F.min("page_no").alias("page_no"))
        )
        now = reached.count()
        if now == known:
            break
        known, length = now, length * 2
        if max_pages and length >= max_pages:
            break
        onward = jumps.select(F.col("url").alias("next_url"), F.col("next_url").alias("_to"))
        jumps = cut_lineage(
            jumps.join(onward, "next_url").select("url", F.col("_to").alias("next_url"))
        )
    return reached.where(F.col("page_no") < max_pages) if max_pages else reached
