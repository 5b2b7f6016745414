"""What the plans must look like for the jobs to hold at a thousand times the data."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks import QUERIES, market, pages
from checks.standin import TIES, observations
from plotwise.functions.html import tokenise
from plotwise.operators import dedupe, extract, merge, ranks, selectors
from plotwise.plans import dashboard, details

SF = "/root/testdata/sf0.001"
EAGER = {"stream_upsert", "stream_new_files", "merge_into_table", "detail_split", "discovery_job"}  # run jobs of their own


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_growth_aggregates_before_its_window(spark):
    text = plan(QUERIES["ppsqm_growth"](spark, SF))
    window, final, partial = (text.index(s) for s in ("Window [", "avg(price_per_sqm", "partial_avg"))
    assert window < final < partial
    scan = re.search(r"ReadSchema: struct<(l_[^>]*)>", formatted(QUERIES["ppsqm_growth"](spark, SF)))[1]
    assert {c.split(":")[0] for c in scan.split(",")} == {
        "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate",
    }


@pytest.mark.parametrize("make", ["keep_latest", "upsert_last_wins", "daily_snapshot", None])
def test_duplicates_fold_before_the_shuffle(spark, make):
    links = spark.createDataFrame([], "portal string, url string, page_no int, pos int")
    text = plan(QUERIES[make](spark, SF) if make else dedupe.first_discovered(links))
    assert re.search(r"partial_m(ax|in)_by", text)
    assert "Window" not in text


def test_capped_discovery_windows_hold_parts_of_a_portal(spark):
    links = spark.createDataFrame([], "portal string, url string, page_no int, pos int")
    text = plan(dedupe.cap_discovered(links, 5000))
    keys = re.findall(r"windowspecdefinition\((.*?) (?:ASC|DESC)", text)
    assert keys and all("_s" in k.split(",")[1] for k in keys if "_span" not in k.split(",")[-1])


def test_filters_and_columns_reach_the_scan(spark):
    listings = spark.read.parquet(f"{SF}/part.parquet").select(
        F.col("p_type").alias("property_type"), F.col("p_retailprice").alias("price_php"), "p_size"
    )
    text = formatted(dashboard.search_filter(listings, {"property_type": "SMALL", "min_price": 0, "max_price": 950}))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text)[1]
    for part in ("EqualTo(p_type,SMALL)", "GreaterThanOrEqual(p_retailprice,0.0)", "LessThanOrEqual(p_retailprice,950.0)"):
        assert part in pushed
    text = formatted(dashboard.dashboard_filter(listings, price_min=910.0, price_max=950.0))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text)[1]
    assert "GreaterThanOrEqual(p_retailprice,910.0)" in pushed and "IsNull(p_retailprice)" in pushed


@pytest.mark.parametrize("name", ["search_page", "top_listings"])
def test_pages_are_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


def test_pages_are_read_once_and_html_is_not_shuffled(spark):
    """Pages are tokenised when they are stored; no later plan holds the HTML or the reader."""
    made = spark.read.parquet(f"{SF}/pages.parquet").select("url", "html")
    urls = made.select("url", F.lit("p").alias("portal"))
    rows = details.detail_outcomes(urls, made, F.lit("2024-01-01").cast("timestamp"))
    for df in (rows, rows.where("reason is null"), rows.where("reason is not null"), pages.links(spark, SF).where("pos > 1")):
        text = plan(df)
        assert "EvalPython" not in text and "html#" not in text.replace("length(html", "")
    once = selectors.tokenised(made)
    assert plan(made.withColumn("t", tokenise("html"))).count("ArrowEvalPython") == 1 and "Python" not in plan(once)


def test_records_are_columns_not_python(spark):
    read = extract.read_details(spark.read.parquet(f"{SF}/pages.parquet").select("url", "html"))
    text = plan(extract.detail_records(read, F.lit("2024-01-01").cast("timestamp")))
    assert text.count("EvalPython") == 0  # the pages were read once, when they were tokenised


def test_merged_tables_fold_before_the_shuffle(spark):
    from plotwise.session import scratch_path

    stored = spark.range(100).select(F.col("id").cast("string").alias("url"), F.lit(1).alias("scraped_at"))
    path = scratch_path(spark, "plan")
    merge.append_batch(stored, path, 0, ["scraped_at"])
    text = plan(merge.read_merged(spark, path, stored.schema))
    assert "partial_max_by" in text and text.count("Exchange") == 1


def test_medians_hold_no_group_in_one_buffer(spark, monkeypatch):
    monkeypatch.setattr(ranks, "cut_lineage", lambda df: df)  # look at the whole plan
    df = market.listings(spark, SF, published=False).select("city", "price_per_sqm")
    text = plan(ranks.exact_median(df, "price_per_sqm", ["city"]))
    assert "percentile(" not in text and "collect_" not in text


def test_deep_pages_are_not_gathered(spark):
    df = market.found(spark, SF)
    after = {"scraped_at": dt.datetime(1996, 1, 1), **dict.fromkeys(("url", *TIES), 0), "url": "x"}
    for page in (dashboard.search_page(df, after, 25, ("url", *TIES)), dashboard.numbered_page(df, 10_000, 25, ("url", *TIES))):
        assert "CollectLimit" not in plan(page) and "TakeOrderedAndProject(limit=25" in plan(page)


def test_elements_and_texts_are_read_apart(spark):
    """Selectors read no texts of the stored tokens, and only pages' texts come back to the matches."""
    tokens = selectors.tokenised(spark.read.parquet(f"{SF}/pages.parquet").select("url", "html"))
    rules = selectors.selector_rules([("", "x", "h1")])
    scan = re.search(r"ReadSchema: (struct<.*)", formatted(selectors.matches(selectors.elements_of(tokens), rules)))[1]
    assert "elements" in scan and "texts" not in scan and "blocks" not in scan


def test_two_publish_loads_in_one_plan(spark):
    both = QUERIES["publish_gate"](spark, SF).union(QUERIES["publish_gate"](spark, SF))
    assert both.count() == 2 * QUERIES["publish_gate"](spark, SF).count()


def test_ties_make_the_order_total(spark):
    obs = observations(spark, SF, part=False)
    assert obs.select("url", "scraped_at", *TIES).distinct().count() == obs.count()
