"""Medians and ranks against brute force, with one group holding a third of the rows."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from plotwise.operators import dedupe, ranks
from plotwise.plans import dashboard, metrics


def skewed(n=6000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        city = "hot" if i % 3 == 0 else f"c{rnd.randrange(40)}"
        value = rnd.choice([None, 5.0, rnd.lognormvariate(3, 2), -rnd.random(), float(rnd.randrange(10))])
        rows.append((city, value))
    return rows + [(None, 1.0), ("empty", None), ("one", 3.0), ("two", 1.0), ("two", 2.0)]


def medians(rows):
    groups = {}
    for city, value in rows:
        if city is not None and value is not None:
            groups.setdefault(city, []).append(value)
    return {c: (len(v), statistics.median(v)) for c, v in groups.items()}


@pytest.mark.parametrize("bins", [1024, 2, 7])
def test_median_by_group(spark, monkeypatch, bins):
    monkeypatch.setattr(ranks, "BINS", bins)
    rows = skewed()
    df = spark.createDataFrame(rows, "city string, v double").repartition(6)
    got = {r["city"]: (r["n"], r["median"]) for r in ranks.exact_median(df, "v", ["city"]).collect()}
    assert got == medians(rows)


def test_median_of_all(spark):
    values = [v for _, v in skewed() if v is not None]
    df = spark.createDataFrame(skewed(), "city string, v double")
    row = ranks.exact_median(df, "v").first()
    assert (row["n"], row["median"]) == (len(values), statistics.median(values))


INF = float("inf")


@pytest.mark.parametrize(
    "values",
    [[1.0] * 5000, [1.0] * 3000 + [2.0] * 3000, [float(i) for i in range(5000)], [10.0**i for i in range(-300, 300)]]
    + [[-INF, -1.7e308, 3.0, 1.7e308, INF]],
)
def test_median_with_many_equal_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert ranks.exact_median(df, "v").first()["median"] == statistics.median(values)


def test_median_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "city string, v double")
    assert ranks.exact_median(df, "v", ["city"]).count() == 0
    row = dashboard.kpi_row(df, "v").first()
    assert row.asDict() == {"listings": 1, "median_ppsqm": None, "avg_ppsqm": None, "cities": 1}


@pytest.mark.parametrize("top", [None, 1, 25, 10_000])
def test_rank_within(spark, monkeypatch, top):
    monkeypatch.setattr(ranks, "SPAN", 4)
    rnd = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 5}", rnd.randrange(30), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, step int, pos int")
    got = ranks.rank_within(df, ["g"], "step", [F.col("pos")], "rank", top).collect()
    want = {}
    for g, step, pos in sorted(rows):
        want[(g, pos)] = sum(1 for k in want if k[0] == g) + 1
    want = {k: v for k, v in want.items() if top is None or v <= top}
    assert {(r["g"], r["pos"]): r["rank"] for r in got} == want


def test_first_and_capped_discovery(spark):
    rows = [("p", f"u{i % 50}", i // 20, i % 20) for i in range(600)] + [("q", "u1", 0, 0)]
    df = spark.createDataFrame(rows, "portal string, url string, page_no int, pos int")
    first = dedupe.first_discovered(df)
    got = {(r["portal"], r["url"]): (r["page_no"], r["pos"]) for r in first.collect()}
    want = {}
    for portal, url, page, pos in rows:
        want.setdefault((portal, url), (page, pos))
    assert got == want
    capped = {(r["portal"], r["url"]) for r in dedupe.cap_discovered(first, 30).collect()}
    assert capped == {("p", f"u{i}") for i in range(30)} | {("q", "u1")}
    assert dedupe.cap_discovered(first, 0).count() == first.count()


def test_keep_latest(spark):
    rows = [("a", 1, 1), ("a", 3, 2), ("a", 3, 3), ("b", 1, 4), ("b", None, 5), (None, 1, 6), (None, 2, 7)]
    df = spark.createDataFrame(rows, "url string, scraped_at int, seq int")
    assert {r["url"]: r["seq"] for r in dedupe.keep_latest(df, ties=["seq"]).collect()} == {"a": 3, "b": 5, None: 7}
    known = dedupe.keep_latest(df, ties=["seq"], prefer_known_time=True)
    assert {r["url"]: r["seq"] for r in known.collect()} == {"a": 3, "b": 4, None: 7}


def test_growth(spark):
    df = spark.sql("select date_add(date'2024-01-01', cast(id as int)) as as_of_date, 5.0D as avg_ppsqm from range(10)")
    got = [r["growth_pct"] for r in metrics.ppsqm_growth(df, 3).orderBy("as_of_date").collect()]
    assert got == [None] * 3 + [0.0] * 7
    gaps = df.where("day(as_of_date) not in (2, 3)").withColumn("avg_ppsqm", F.day("as_of_date").cast("double"))
    by_rows = {r["avg_ppsqm"]: r["growth_pct"] for r in metrics.ppsqm_growth(gaps, 1).collect()}
    by_days = {r["avg_ppsqm"]: r["growth_pct"] for r in metrics.ppsqm_growth_by_calendar(gaps, 1).collect()}
    assert by_rows[4.0] == 300.0 and by_days[4.0] is None and by_rows[5.0] == by_days[5.0] == 25.0
    assert metrics.ppsqm_growth(df.where("false")).columns == ["as_of_date", "avg_ppsqm", "growth_pct"]


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in range(31)] + [(None,)], "v double")
    bins = {r["bin"]: r["listings"] for r in dashboard.histogram(df, "v").collect()}
    assert bins == {**{i: 1 for i in range(29)}, 29: 2}
    same = spark.createDataFrame([(4.0,)] * 3, "v double")
    assert [tuple(r)[::3] for r in dashboard.histogram(same, "v").collect()] == [(0, 3)]
    assert dashboard.histogram(df.where("v is null"), "v").count() == 0


def test_dashboard_filter_null_rules(spark):
    df = spark.createDataFrame(
        [("Offices", "Cebu", None, None, None), ("office", "cebu city", 10.0, 5.0, "2024-01-02 00:00:00"), (None, None, 99.0, 50.0, None)],
        "property_type string, city string, price_php double, area_sqm double, published_at string",
    ).withColumn("published_at", F.col("published_at").cast("timestamp"))

    def n(**kw):
        return dashboard.dashboard_filter(df, **kw).count()

    assert n() == 3 and n(property_type="OFFICE") == 2 and n(city="^cebu$") == 1
    assert n(price_min=0.0) == 3 and n(price_min=1.0) == 2
    assert n(price_max=50.0) == 2 and n(price_max=0.0) == 3
    assert n(area_min=1.0) == 2 and n(area_max=10.0) == 2 and n(area_min=0.0, area_max=0.0) == 3
    assert n(published_from="2024-01-01") == 1 and n(published_to="2024-01-01") == 0


def test_search_filter(spark):
    df = spark.createDataFrame(
        [("a", 0.0, None, "Corner lot", None), ("b", 5.0, 2.0, None, "near CORNER"), ("a", None, 1.0, "x", "y")],
        "source string, price_php double, area_sqm double, listing_title string, description string",
    )

    def n(**f):
        return dashboard.search_filter(df, f).count()

    assert n() == 3 and n(source="") == 3 and n(source="a") == 2
    assert n(min_price=0) == 2 and n(max_price=0) == 1 and n(min_area=0) == 2
    assert n(q="corner") == 2 and n(q="c%r l_t") == 1


def test_a_group_of_equal_values_beside_a_wide_one(spark):
    rows = [("same", 7.0)] * 4000 + [("wide", i * 1.5 + 0.25) for i in range(4001)]
    df = spark.createDataFrame(rows, "city string, v double").repartition(5)
    got = {r["city"]: r["median"] for r in ranks.exact_median(df, "v", ["city"]).collect()}
    assert got == {"same": 7.0, "wide": 2000 * 1.5 + 0.25}


def test_latest_row_does_not_depend_on_partitions(spark):
    df = spark.range(20_000).selectExpr("'u' url", "cast(null as timestamp) scraped_at", "id", "map('k', id) m")
    won = {dedupe.keep_latest(df.repartition(n)).first()["id"] for n in (1, 3, 8)}
    assert len(won) == 1


def test_paging(spark):
    rows = [(f"u{i:03}", None if i % 10 == 0 else f"2024-01-01 00:00:{i:02}") for i in range(60)]
    df = spark.createDataFrame(rows, "url string, t string").select("url", F.col("t").cast("timestamp").alias("scraped_at"))
    pages, after = [], None
    for _ in range(4):
        pages.append(dashboard.search_page(df, after, 25).collect())
        after = pages[-1][-1].asDict() if pages[-1] else after
    assert [len(p) for p in pages] == [25, 25, 10, 0]
    assert [r["url"] for r in pages[0][:7]] == ["u000", "u010", "u020", "u030", "u040", "u050", "u059"]
    assert len({r["url"] for p in pages for r in p}) == 60
    numbered = [dashboard.numbered_page(df, n, 25).collect() for n in (1, 2, 3, 4)]
    assert numbered == pages


def test_median_of_all_rows_needs_no_shuffle_of_them(spark, monkeypatch):
    """One group: a join by its key would put every row into one task."""
    from plotwise.operators import ranks
    from plotwise.session import cut_lineage

    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df)

    monkeypatch.setattr(ranks, "cut_lineage", seen)
    rows = spark.createDataFrame([(float(i * 7 % 5003),) for i in range(5003)], "v double")
    assert ranks.exact_median(rows, "v").first()["median"] == 2501.0
    assert any("BroadcastHashJoin" in p for p in plans) and not any("SortMergeJoin" in p for p in plans)
