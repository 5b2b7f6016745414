"""Work that must not grow faster than the input: rows that meet states, widths of shuffles, compiled methods."""

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from plotwise import session
from plotwise.functions import dates, urls
from plotwise.session import scratch_path
from plotwise.streaming import ingest

LINE = '{{"url":"https://p.example.com/{}","title":"{}","scraped_at":"2024-0{}-01T00:00:00+00:00"}}'


def drop(spark, base, run, rows):
    lines = spark.createDataFrame([(x,) for x in rows], "value string").coalesce(1)
    lines.write.text(f"{base}/run_{run}/staged/shop_listings.jsonl")


def test_a_url_of_many_files_meets_its_state_as_one_row(spark, monkeypatch):
    base, checkpoint = (scratch_path(spark, n) for n in ("drops", "cp"))
    for run in (1, 2, 3):
        drop(spark, base, run, [LINE.format(k, f"title {run}", run) for k in (1, 1, 2)])
    own = ingest.ListingState.handleInputRows

    def alone(self, key, rows, timers):
        rows = list(rows)
        if len(rows) > 1:
            raise RuntimeError(f"{len(rows)} rows of {key}")
        yield from own(self, key, iter(rows), timers)

    monkeypatch.setattr(ingest.ListingState, "handleInputRows", alone)
    ingest.ingest_listings(ingest.stream_staged(spark, base), checkpoint, F.lit("2024-06-01").cast("timestamp")).awaitTermination()
    got = {r["url"][-1]: r["listing_title"] for r in ingest.listings(spark, checkpoint).collect()}
    assert got == {"1": "title 3", "2": "title 3"}


def test_urls_share_a_state_of_their_bucket(spark, monkeypatch):
    monkeypatch.setattr(ingest, "BUCKETS", 3)
    base, checkpoint = (scratch_path(spark, n) for n in ("drops", "cp"))
    odd = 'say \\"ja\\" \\\\ \u00e9\U0001f600\u2028'
    for run in (1, 2):
        drop(spark, base, run, [LINE.format(k, f"{odd} {run}", run) for k in range(40)])
    arriving = ingest.stream_staged(spark, base, files_per_batch=1)
    ingest.ingest_listings(arriving, checkpoint, F.lit("2024-06-01").cast("timestamp")).awaitTermination()
    states = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", ingest.STATE).load()
    assert states.count() == 3
    got = ingest.listings(spark, checkpoint).collect()
    assert len({r["url"] for r in got}) == len(got) == 40
    assert {(r["listing_title"], r["scraped_at"].month) for r in got} == {('say "ja" \\ \u00e9\U0001f600 2', 2)}


def test_kept_listings_come_back_as_they_were():
    values = {"price_php": -0.0, "area_sqm": "NaN", "listing_title": 'a"\n\\\u00e9\U0001f600', "bedrooms": 0, "scraped_at": 1 << 60}
    rank = {"price_php": "2", "area_sqm": "1", "listing_title": "2", "bedrooms": "1", "scraped_at": "3"}
    row = [*map(values.get, ingest.NAMES), [rank.get(n) for n in ingest.NAMES], "4"]
    back = ingest._from_text(ingest._as_text({"u": row, "v": ingest.folded(None, row)}))
    assert back == {"u": row, "v": row} and str(back["u"][ingest.NAMES.index("price_php")]) == "-0.0"


SEEN = st.tuples(st.sampled_from("abc"), st.sampled_from("xyz"), st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.text(max_size=2)))


@settings(max_examples=60, deadline=None)
@given(st.lists(SEEN, min_size=1, max_size=30), st.integers(1, 200), st.integers(1, 30))
def test_folding_in_arrow_equals_folding_row_by_row(rows, held, cut):
    import pyarrow as pa

    number, text = ingest.NAMES.index("price_php"), ingest.NAMES.index("listing_title")
    fields = {ingest.KEY: [r[0] for r in rows], **{n: [None] * len(rows) for n in ingest.NAMES}}
    fields["price_php"] = [None if r[2] is None else float(r[2]) for r in rows]
    fields["listing_title"] = [r[3] for r in rows]
    schema = pa.schema([f for f in to_arrow_schema(ingest.RANKED) if f.name != ingest.RANK])
    whole = pa.RecordBatch.from_pydict(fields, schema)
    whole = whole.append_column("_split", pa.array([r[1] for r in rows])).append_column("_time", pa.array(["t"] * len(rows)))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ingest, "HELD_BYTES", held)
        ranked = list(ingest._numbered(True)([whole.slice(i, cut) for i in range(0, len(rows), cut)]))
        found = [r for b in ingest._observations(True)(ranked) for r in b.to_pylist()]
    got: dict = {}
    for row in found:
        url, *rest = row.values()
        got[url] = ingest.folded(got.get(url), rest)
    lines, want = {}, {}
    for url, split, price, title in rows:
        lines[split] = lines.get(split, 0) + 1
        values = [None] * len(ingest.NAMES)
        values[number], values[text] = None if price is None else float(price), title
        rank = f"t\x01{split}\x01{lines[split]:019d}"
        want[url] = ingest.folded(want.get(url), [*values, [None if v is None else rank for v in values], rank])
    assert got == want


def test_shuffles_are_as_wide_as_the_input_asks_for(spark, tmp_path, monkeypatch):
    from checks import standin

    path, given = str(tmp_path / "t"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.range(200_000).write.parquet(path)
    before = spark.conf.get(session.WIDTH, None)
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 10_000)
    try:
        standin.spread(spark.read.parquet(path))
        assert int(spark.conf.get(session.WIDTH)) > 5 * int(given)
        session.widen(spark, 1)
        assert int(spark.conf.get(session.WIDTH)) > 5 * int(given)
    finally:
        spark.conf.set(session.WIDTH, before) if before else spark.conf.unset(session.WIDTH)


def test_pages_are_spread_by_what_they_become(spark, tmp_path, monkeypatch):
    from checks import pages, standin

    rows = spark.range(1000).selectExpr("id AS p_partkey", "uuid() AS p_name", "'t' AS p_type", "'b' AS p_brand", "1 AS p_size", "2D AS p_retailprice")
    rows.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    before = spark.conf.get(session.WIDTH, None)
    monkeypatch.setattr(standin, "PART_BYTES", 100_000)  # the file has about 40,000
    try:
        assert pages.listing_pages(spark, str(tmp_path)).rdd.getNumPartitions() > 16
    finally:
        spark.conf.set(session.WIDTH, before) if before else spark.conf.unset(session.WIDTH)


def test_methods_that_hotspot_would_not_compile_are_not_made(spark):
    assert session.tune(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


@pytest.mark.parametrize("text", ["posted 3 days, 12 hours ago", "ago", "AGO", "x 1 Year,2 months ago", " , ago", "3days ago!", "none", "agoago"])
def test_the_look_ahead_of_relative_dates_loses_nothing(text):
    plain = dates.AGO.replace("(?=[0-9 ,a])", "")
    assert plain != dates.AGO
    found, want = re.search(dates.AGO, text), re.search(plain, text)
    assert (found and found.span()) == (want and want.span())


def test_plain_addresses_are_cut_without_a_rewriting_pattern(column):
    cases = {
        "https://a.example.com/x/?ref=1#t": "https://a.example.com/x", "http://a/#?b": "http://a", "http://a/?#b": "http://a",
        "https://a.b//": "https://a.b", "https://a/b;c?d": "https://a/b", "HTTPS://A/b?c": "https://A/b", "\t https://a/b/": "https://a/b",
        "https://a/b\n?c": "https://a/b", "/b?c": None, None: None, "x://": "x:", "https://a/b\u2028": "https://a/b\u2028",
    }
    assert column(list(cases), urls.canonical_url) == list(cases.values())
    assert column(["https://a/b?c"], lambda c: F.when(c.rlike(urls.PLAIN_URL), "plain")) == ["plain"]


def test_texts_that_share_no_bucket_are_not_shuffled(spark, monkeypatch):
    from plotwise.llm import minhash
    from plotwise.operators import bloom

    tested, may_hold = [], bloom.where_may_hold

    def seen(df, *args):
        out = may_hold(df, *args)
        tested.append((df.count(), out.count()))
        return out

    monkeypatch.setattr(bloom, "where_may_hold", seen)
    other = [(k, " ".join(f"w{k}x{i}" for i in range(30))) for k in range(400)]
    same = " ".join(f"word{i}" for i in range(40))
    rows = [*other, (1000, same), (1001, same + " more"), (1001, same), (1002, None), (None, same), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r["doc_id"] for r in minhash.drop_near_copies(docs).collect()]
    assert sorted(k for k in kept if k is not None) == [*range(400), 1000, 1002] and kept.count(None) == 2
    assert tested and all(after < before / 10 for before, after in tested)


def test_staged_rows_lie_compressed(spark):
    import glob

    from plotwise.sources import staged

    base = scratch_path(spark, "staged")
    rows = spark.createDataFrame([("https://a/1", "r", "p"), (None, "r", "q")], "url string, run string, portal string")
    staged.write_staged_urls(rows, base, F.lit("2024-06-01").cast("timestamp"))
    files = glob.glob(f"{base}/urls/run=r/portal=*/part-*")
    assert len(files) == 2 and all(f.endswith(".json.gz") for f in files)
    assert {(r["portal"], r["url"]) for r in staged.read_staged(spark, base, "urls").collect()} == {("p", "https://a/1"), ("q", None)}


def test_outcomes_are_kept_in_columns_and_not_checkpointed(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from plotwise.plans import details
    from plotwise.sources import staged

    def refused(self, *args, **kwargs):
        raise AssertionError("checkpointed")

    monkeypatch.setattr(DataFrame, "checkpoint", refused)
    urls = spark.createDataFrame([("https://a/1", "r", "p"), ("https://a/2", "r", "p")], "url string, run string, portal string")
    pages = spark.createDataFrame([("https://a/1", "<h1>Flat</h1>")], "url string, html string")
    at, base = F.lit("2024-06-01").cast("timestamp"), scratch_path(spark, "details")
    details.write_outcomes(details.detail_outcomes(urls, pages, at), base, at)
    assert [r["title"] for r in staged.read_staged(spark, base, "listings").collect()] == ["Flat"]
    assert [r["reason"] for r in staged.read_staged(spark, base, "failures").collect()] == ["no_html"]


def test_rules_are_sent_to_the_elements_and_never_the_elements(spark, monkeypatch):
    from plotwise.operators import selectors

    kind = "_page long, scope string, start int, end int, parent int, nth int, last boolean, tag string, attrs map<string,string>, text_from int, text_to int"
    elements = spark.createDataFrame([(1, "", 1, 1, 0, 1, True, "h1", {"class": "x"}, 0, 0)], kind)
    rules = selectors.selector_rules([("", "title", "h1.x")])
    for most, hint in ((10, "broadcast"), (0, "merge")):
        monkeypatch.setattr(selectors, "SENT_RULES", most)
        met = selectors.candidates(elements, rules)
        plan = met._jdf.queryExecution().optimizedPlan().toString()
        assert f"rightHint=(strategy={hint})" in plan and "leftHint" not in plan
        assert [r["name"] for r in met.collect()] == ["title"]
