"""Text index, Bloom filter, value runs, pages by number, sightings, clustering, SQL functions."""

import datetime as dt
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from plotwise.operators import bloom, clustering, merge, ranks, textindex
from plotwise.plans import dashboard, details, loaders, metrics
from plotwise.session import scratch_path
from plotwise.sql import FUNCTIONS, register


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- text index -------------------------------------------------------------------


@pytest.mark.parametrize(
    "pattern, parts", [("abc", ["abc"]), ("a%b_c", ["a", "b", "c"]), (r"a\%b\_", ["a%b_"]), ("%_", []), ("", []), ("a\\\\b", ["a\\b"])]
)
def test_literal_parts(pattern, parts):
    assert textindex.literal_parts(pattern) == parts


@pytest.fixture(scope="module")
def indexed(spark):
    draw = random.Random(1)
    words = ["Lot", "office", "ÉTAGE", "straße", "a%b", "x_y", "\U0001f600\U0001f601ab", "\n", "lo", "t o", "back\\slash", "İstanbul"]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(0, 6))), draw.choice([None, "", "Lot office", "other"])) for i in range(2000)]
    rows += [(5000, "needle in text", None), (5001, None, "NEEDLE in title"), (5002, "n e e d l e", "nee" + "x" * 50_000 + "edle"), (5003, None, None)]
    df = spark.createDataFrame(rows, "i int, text string, title string").repartition(4)
    path = scratch_path(spark, "index")
    textindex.write_index(df, ["text", "title"], path, block=64)
    return df, path


@pytest.mark.parametrize("q", ["needle", "LOT", "lot off", "étage", "straße", "a%b", "a\\%b", "x_y", "ab", "", "fi_e", "\U0001f601AB", "nowhere", "t o\nt o", "slash", "n_edl%e"])
def test_index_finds_what_a_scan_finds(spark, indexed, q):
    df, path = indexed
    like = f"%{q}%"
    want = {r["i"] for r in df.where(F.col("text").ilike(like) | F.col("title").ilike(like)).collect()}
    got = [r["i"] for r in textindex.search(spark, path, q, ["text", "title"]).collect()]
    assert set(got) == want and len(got) == len(want)


def test_index_reads_few_texts(spark, indexed):
    df, path = indexed
    found = textindex.candidates(spark, path, "needle", ["text", "title"])
    assert found.count() == 2  # of 2,004 rows; spread letters share no list
    assert textindex.candidates(spark, path, "ab", ["text"]) is None
    blocks = {r["_block"] for r in found.collect()}
    text = plan(textindex.search(spark, path, "needle", ["text", "title"]))
    named = re.search(r"PartitionFilters: \[[^\]]*_block#\d+L? IN \(([\d,]+)\)", text) or re.search(r"PartitionFilters: \[[^\]]*_block#\d+L? = (\d+)", text)
    assert {int(b) for b in named[1].split(",")} == blocks and len(blocks) < 5
    longest = spark.read.parquet(f"{path}/postings").agg(F.max(F.size("rows"))).first()[0]
    assert longest <= 64


# --- Bloom filter -----------------------------------------------------------------


def test_bloom_keeps_every_key_and_few_others(spark):
    keys = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("url"))
    bits = bloom.bits_for(5000)
    words = bloom.filter_words(keys, "url", bits)
    every = spark.range(50_000).select(F.concat(F.lit("u"), "id").alias("url"), "id")
    passed = bloom.where_may_hold(every, "url", words, bits)
    assert passed.where("id < 5000").count() == 5000
    assert passed.where("id >= 5000").count() < 45_000 * 0.03
    assert passed.columns == every.columns
    assert bloom.where_may_hold(every.withColumn("url", F.lit(None).cast("string")), "url", words, bits).count() == 0


def test_bloom_filters_add_up(spark):
    bits = bloom.bits_for(600)
    parts = [spark.range(a, a + 300).select(F.col("id").cast("string").alias("k")) for a in (0, 200)]
    both = bloom.merged(*[bloom.filter_words(p, "k", bits) for p in parts])
    whole = bloom.filter_words(parts[0].union(parts[1]), "k", bits)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.collect()))
    assert bloom.bits_for(10) == bloom.LEAST_BITS and bloom.bits_for(10**9) is None and bloom.bits_for(0) == bloom.LEAST_BITS
    none = bloom.filter_words(parts[0].limit(0), "k", bits)
    assert bloom.where_may_hold(parts[0], "k", none, bits).count() == 0


def test_pages_are_filtered_in_the_scan(spark, tmp_path):
    """The filter lies below the exchange of the pages, and the join after it is exact."""
    pages = spark.range(3000).select(F.concat(F.lit("https://p/"), "id").alias("url"), F.lit("<h1>x").alias("html"))
    pages.write.parquet(str(tmp_path / "pages"))
    urls = spark.createDataFrame([("https://p/5",), ("https://p/6",), ("https://p/5",), (None,), ("https://p/x",)], "url string")
    found = details.staged_pages(urls, spark.read.parquet(str(tmp_path / "pages")))
    assert sorted(r["url"] for r in found.collect()) == ["https://p/5", "https://p/6"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(details.staged_pages(urls, spark.read.parquet(str(tmp_path / "pages"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchange = text.index("Exchange hashpartitioning(url")
    assert text.index("bit_get") > exchange or text.index("getbit") > exchange


# --- value runs ---------------------------------------------------------------------


def test_runs_add_up_to_exact_medians(spark):
    draw = random.Random(3)
    rows = [(d, draw.choice(["a", "b", None]), draw.choice([None, 1.0, 2.5, 7.0, draw.random() * 10])) for d in range(6) for _ in range(90)]
    df = spark.createDataFrame(rows, "day int, city string, price_per_sqm double")

    def runs(days):
        return dashboard.value_runs(df.where(F.col("day").isin(days)))

    total = dashboard.add_runs(dashboard.add_runs(runs([0, 1]), runs([2, 3])), runs([4, 5]))
    total = dashboard.add_runs(total, runs([4]), runs([5]))  # day 5 is replaced by day 4
    kept = [r for r in rows if r[0] != 5] + [r for r in rows if r[0] == 4]
    values = [v for _, _, v in kept if v is not None]
    row = dashboard.kpi_of_runs(total).first()
    assert row["listings"] == len(kept) and row["cities"] == 2
    assert row["median_ppsqm"] == pytest.approx(statistics.median(values), abs=1e-12)
    assert row["avg_ppsqm"] == pytest.approx(statistics.fmean(values))
    by_city = {r["city"]: r["median_ppsqm"] for r in dashboard.median_by_city_of_runs(total).collect()}
    assert by_city == {c: pytest.approx(statistics.median([v for _, x, v in kept if x == c and v is not None])) for c in ("a", "b")}
    empty = dashboard.add_runs(runs([0]), runs([]), runs([0]))
    assert empty.count() == 0 and dashboard.kpi_of_runs(empty).first()["listings"] == 0


def test_runs_read_no_history(spark, tmp_path):
    """A day's batch meets the total, a row per value, and not the days before."""
    spark.createDataFrame([(1, "a", 1.0)], "day int, city string, price_per_sqm double").write.partitionBy("day").parquet(str(tmp_path / "d"))
    days = spark.read.parquet(str(tmp_path / "d"))
    total = spark.createDataFrame([("a", 1.0, 5)], "city string, v double, n long")
    text = plan(dashboard.add_runs(total, dashboard.value_runs(days.where("day = 1"))))
    assert "PartitionFilters: [isnotnull(day" in text and text.count("FileScan") == 1


# --- pages by number ------------------------------------------------------------------


@pytest.mark.parametrize("first, last", [(0, 5), (95, 105), (390, 410), (395, 396), (590, 620), (600, 700), (0, 600)])
def test_pages_by_number_in_hot_steps(spark, first, last):
    """Step 0 holds two thirds of the rows; pages lie in it, across its end, and behind all rows."""
    rows = [(0 if i % 3 else 1 + i, f"u{i * 7 % 600:04d}") for i in range(600)]
    df = spark.createDataFrame(rows, "step long, url string").repartition(5)
    got = ranks.page_of(df, "step", [F.col("url")], first, last, "rank").orderBy("rank").collect()
    want = sorted(rows)[first:last]
    assert [(r["step"], r["url"]) for r in got] == want and [r["rank"] for r in got] == list(range(first + 1, min(last, 600) + 1))


# --- sightings ------------------------------------------------------------------------


def test_sightings_are_folded_day_by_day(spark):
    path, kept = scratch_path(spark, "snaps"), scratch_path(spark, "kept")

    def write(rows):
        df = spark.createDataFrame(rows, "listing_id string, seen_at string").withColumn("seen_at", F.col("seen_at").cast("timestamp"))
        merge.append_snapshots(df.withColumn("day", F.to_date("seen_at")), path)

    def fold(*days):
        metrics.fold_sightings(spark.read.parquet(path), [dt.date(2024, 1, d) for d in days], kept)

    def got():
        return {r["listing_id"]: (r["first_seen"].day, r["last_seen"].day) for r in metrics.sightings(spark, kept).collect()}

    write([("a", "2024-01-03 10:00:00"), ("b", "2024-01-03 11:00:00")])
    fold(3)
    write([("a", "2024-01-05 10:00:00")])
    fold(5)
    assert got() == {"a": (3, 5), "b": (3, 3)}
    fold(3, 5)  # again
    write([("a", "2024-01-03 09:00:00"), ("c", "2024-01-03 09:00:00")])  # the day is written anew
    fold(3)
    write([("b", "2024-01-01 09:00:00")])  # and an older one comes late
    fold(1)
    assert got() == {"a": (3, 5), "b": (1, 3), "c": (3, 3)}
    only = spark.read.parquet(path).where(F.col("day").isin(dt.date(2024, 1, 5)))
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ = 2024-01-05", plan(only))


# --- clustering -----------------------------------------------------------------------


def test_clustered_files_are_left_out(spark):
    draw = random.Random(4)
    rows = [
        (draw.choice([None, draw.random() * 1000]), draw.randint(0, 99), dt.datetime(2024, 1, 1) + dt.timedelta(hours=draw.randint(0, 5000)))
        for _ in range(8000)
    ]
    df = spark.createDataFrame(rows, "price double, area int, seen timestamp")
    path = scratch_path(spark, "clustered")
    clustering.write_clustered(df, ["price", "area", "seen"], path, rows_per_file=250)
    every = clustering.files_for(spark, path, {})
    assert len(every) > 20 and clustering.read_clustered(spark, path, {}).count() == 8000
    for ranges, most in (({"price": (100, 150)}, 0.6), ({"area": (10, 14)}, 0.6), ({"price": (100, 200), "area": (10, 20)}, 0.3)):
        inside = df.where(" AND ".join(f"{c} BETWEEN {a} AND {b}" for c, (a, b) in ranges.items()))
        read = clustering.read_clustered(spark, path, ranges)
        found = read.where(" AND ".join(f"{c} BETWEEN {a} AND {b}" for c, (a, b) in ranges.items()))
        assert sorted(map(str, found.collect())) == sorted(map(str, inside.collect()))
        assert len(clustering.files_for(spark, path, ranges)) <= most * len(every)
        assert len(read.inputFiles()) == len(clustering.files_for(spark, path, ranges))
    assert clustering.read_clustered(spark, path, {"price": (5000, None)}).collect() == []


def test_many_small_files_take_few_tasks(spark):
    df = spark.range(8000).select(F.col("id").cast("double").alias("price"), (F.col("id") % 100).cast("int").alias("area"))
    path = scratch_path(spark, "clustered")
    clustering.write_clustered(df, ["price", "area"], path, rows_per_file=50)
    files = clustering.files_for(spark, path, {})
    tasks = {re.search(r"part-([0-9]+)", f)[1] for f in files}
    assert len(files) >= 160 and len(tasks) <= clustering.TASKS
    assert clustering.read_clustered(spark, path, {}).count() == 8000
    kept = spark.read.parquet(f"{path}/manifest").agg(F.max("rows"), F.sum("rows")).first()
    assert tuple(kept) == (50, 8000)


def test_places_count_the_bounds_below(spark):
    draw = random.Random(8)
    for many in (0, 1, 2, 5, 255):
        bounds = sorted(float(draw.randint(0, 40)) for _ in range(many))
        values = [None, -1.0, 0.0, 17.0, 17.5, 40.0, 41.0, float("inf"), float("-inf")]
        rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", clustering._place(F.col("v"), bounds).alias("n"))
        assert [r["n"] for r in rows.collect()] == [0 if v is None else sum(b < v for b in bounds) for v in values]


# --- counters and SQL functions ---------------------------------------------------------


def test_counters_of_two_loads_do_not_mix(spark):
    def staged(n):
        rows = [(f"u{i}" if i % 3 else "", "T", "d" if i % 2 else None) for i in range(n)]
        return spark.createDataFrame(rows, "url string, title string, description string")

    now = F.lit("2024-05-05").cast("timestamp")
    for n in (10, 40):
        path = scratch_path(spark, "load")
        counted = loaders.write_load(staged(n), now, "p", path)
        want = loaders.ingest_counters(staged(n), now, "p").first().asDict()
        assert counted == want and spark.read.parquet(path).count() == counted["rows_written"]


def test_sql_functions_are_expressions(spark):
    names = register(spark)
    assert set(FUNCTIONS) < set(names)
    text = "  a  b  12,5 "
    spark.createDataFrame([("HTTP://x.org/a/?q#f", text)], "u string, t string").createOrReplaceTempView("said")
    for name, (arguments, _, rule) in FUNCTIONS.items():
        column = "u" if "url" in arguments else "t"
        called = spark.sql(f"SELECT {name}({column}) AS x FROM said")
        assert called.first()["x"] == spark.table("said").select(rule(F.col(column)).alias("x")).first()["x"]
        assert "Python" not in plan(called)
    rows = spark.sql("SELECT key, tag, start, parent, text FROM page_elements(TABLE(VALUES (7, '<p>a<b>c</b>'), (8, NULL)))").collect()
    assert [tuple(r) for r in rows] == [("7", "p", 1, 0, "a"), ("7", "b", 2, 1, "c")]
