import datetime as dt
import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from plotwise import schemas
from plotwise.operators import merge
from plotwise.plans import loaders
from plotwise.session import scratch_path

DDL = "url string, title string, price double, rooms int, live boolean, scraped_at int, seq int"
ORDER = ["seq"]


def rows_of(df):
    return {r["url"]: tuple(r)[1:6] for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


OLD = [("a", "Old", 1.0, 3, True, 10, 0), ("b", "Keep", 2.0, 4, True, 10, 0)]
NEW = [
    ("a", "First", 5.0, None, None, 11, 1),
    ("a", "  ", None, 0, False, 12, 2),
    ("c", None, 0.0, None, None, 9, 3),
]


def test_last_wins(spark):
    got = merge.upsert_last_wins(frame(spark, OLD), frame(spark, NEW), ORDER)
    assert rows_of(got) == {
        "a": ("  ", None, 0, False, 12), "b": ("Keep", 2.0, 4, True, 10), "c": (None, 0.0, None, None, 9),
    }


def test_null_safe(spark):
    got = merge.upsert_null_safe(frame(spark, OLD), frame(spark, NEW), ORDER)
    assert rows_of(got) == {
        "a": ("First", 5.0, 0, False, 12), "b": ("Keep", 2.0, 4, True, 10), "c": (None, 0.0, None, None, 9),
    }


def test_ignore_stale(spark):
    late = [("a", "Late", 9.0, 9, False, 5, 1), ("b", "Same", None, None, None, 10, 2)]
    got = merge.upsert_null_safe(frame(spark, OLD), frame(spark, late), ORDER, ignore_stale=True)
    assert rows_of(got) == {"a": ("Old", 1.0, 3, True, 10), "b": ("Same", 2.0, 4, True, 10)}


value = st.tuples(
    st.sampled_from("abc"), st.sampled_from([None, "", " ", "x", "y"]), st.sampled_from([None, 0.0, 7.0]),
    st.sampled_from([None, 0, 2]), st.sampled_from([None, False, True]), st.integers(1, 9),
)
batches = st.lists(value, min_size=1, max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches, batches)
def test_merges_are_idempotent_and_lose_nothing(spark, old, new):
    old = merge.argmax_rows(frame(spark, [(*r, i) for i, r in enumerate(old)]), ["url"], ORDER)
    new = frame(spark, [(*r, 100 + i) for i, r in enumerate(new)])
    for fn in (merge.upsert_last_wins, merge.upsert_null_safe):
        once = fn(old, new, ORDER)
        assert rows_of(fn(once, new, ORDER)) == rows_of(once)
    before, after = rows_of(old), rows_of(merge.upsert_null_safe(old, new, ORDER))
    for url, row in before.items():
        assert all(b is None or a is not None for b, a in zip(row, after[url]))


def test_batches_are_appended_and_folded(spark):
    path = scratch_path(spark, "t")
    schema = frame(spark, []).drop("seq").schema
    many = [(f"u{i}", "t", 1.0, 1, True, 1, 0) for i in range(200)]
    merge.append_batch(frame(spark, many), path, 0, ORDER)

    def files():
        return set(glob.glob(f"{path}/*.parquet"))

    def table():
        return rows_of(merge.read_merged(spark, path, schema))

    before = files()
    batch = frame(spark, [("u1", None, 2.0, None, None, 2, 1), ("u1", "new", None, None, None, 3, 2)])
    merge.append_batch(batch, path, 1, ORDER)
    added = files() - before
    assert before < files() and spark.read.parquet(*added).count() == 1  # the batch's one row, and nothing again
    got = table()
    assert len(got) == 200 and got["u1"] == ("new", 2.0, 1, True, 3)
    merge.append_batch(batch, path, 1, ORDER)  # run again
    assert table() == got
    merge.append_batch(batch.where("false"), path, 2, ORDER)
    assert table() == got
    merge.append_batch(batch, path, 3, ORDER, whole_rows=True)
    assert table()["u1"] == ("new", None, None, None, 3)


def test_two_writers_of_one_number_lose_nothing(spark):
    path = scratch_path(spark, "t")
    one = frame(spark, [("u1", "a", None, None, None, 1, 0), ("u2", "b", None, None, None, 1, 0)])
    two = frame(spark, [("u1", None, 2.0, None, None, 1, 0), ("u3", "c", None, None, None, 1, 0)])
    for part in (one, two):
        merge.append_batch(part, path, 1, ORDER)
    got = rows_of(merge.read_merged(spark, path, one.drop("seq").schema))
    assert got["u1"][:2] == ("a", 2.0) and set(got) == {"u1", "u2", "u3"}


def test_snapshots_replace_their_day(spark):
    def snaps(rows):
        df = spark.createDataFrame(rows, "url string, seen_at string, price_php double, seq int").withColumns(
            {
                "seen_at": F.col("seen_at").cast("timestamp"), "area_sqm": F.lit(2.0), "price_per_sqm": F.lit(1.0),
                "property_type": F.lit("x"), "source": F.lit("s"),
            }
        )
        return merge.daily_snapshots(df, ["seen_at", "seq"])

    path = scratch_path(spark, "snap")
    merge.append_snapshots(snaps([("a", "2024-01-01 01:00:00", 1.0, 1), ("a", "2024-01-01 05:00:00", 2.0, 2), ("b", "2024-01-02", 3.0, 3)]), path)
    for _ in range(2):
        merge.append_snapshots(snaps([("a", "2024-01-02", 4.0, 1), ("b", "2024-01-02", 5.0, 2)]), path)
    rows = spark.read.parquet(path).collect()
    assert sorted((str(r["day"]), r["price_php"], r["is_active"]) for r in rows) == [
        ("2024-01-01", 2.0, True), ("2024-01-02", 4.0, True), ("2024-01-02", 5.0, True),
    ]
    with pytest.raises(Exception, match="no id"):
        snaps([(None, "2024-01-01", 1.0, 1)]).collect()


# --- loaders on literal records -------------------------------------------------

LINES = """
{"url":"https://p.example.com/property/1","title":"Unit A","price":{"raw":"₱ 95,200 /month","currency":"PHP","value":95200.0,"period":"month"},"area":{"raw":"184 sqm","sqm":184.0},"scraped_at":"2024-01-02T03:04:05.000001+00:00","published_at":"2024-01-01T00:00:00+08:00","description":" "}
{"url":"https://p.example.com/property/2","title":"Unit B","price":"{\\"value\\":\\"1200\\",\\"currency\\":\\"PHP\\"}","area":"1,200 m²","scraped_at":"2024-01-02T03:04:05+00:00"}
{"url":"https://p.example.com/property/3","title":" Unit\\u00a0 C ","price":"₱ 123,456","area":"500 sq ft","scraped_at":null}
{"url":"https://p.example.com/property/4","title":"Unit D","price":{"value":10,"currency":"USD"},"area":{"sqm":0}}
{"url":null,"title":"No url","description":"x"}
[1, 2]
not json
""".strip().splitlines()


def now():
    return F.lit("2024-06-01").cast("timestamp")


@pytest.fixture(scope="module")
def staged(spark):
    from plotwise.sources.staged import read_dumps

    base = scratch_path(spark, "dump")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(
        f"{base}/run_20240101_000000/staged/shop_listings.jsonl"
    )
    return read_dumps(spark, base, "listings")


def by_unit(df, *columns):
    return {r["url"][-1] if r["url"] else None: tuple(r[c] for c in columns) for r in df.collect()}


def test_scan(staged):
    rows = staged.collect()
    assert {(r["run"], r["portal"]) for r in rows} == {("20240101_000000", "shop")}
    assert len(rows) == 7 and sum(r["_corrupt"] is not None for r in rows) == 2


def test_relational(staged):
    got = by_unit(loaders.load(staged, loaders.RELATIONAL, now()), "price_php", "area_sqm", "price_per_sqm", "price_value", "as_of_date")
    day = dt.date(2024, 1, 2)
    assert got["1"] == (95200.0, 184.0, 95200 / 184, 95200.0, day)
    assert got["2"] == (1200.0, 1200.0, 1.0, 1200.0, day)
    assert got["3"] == (None, 46.45, None, None, None)
    assert got["4"] == (None, 0.0, None, 10.0, None)
    titles = by_unit(loaders.load(staged, loaders.RELATIONAL, now()), "listing_title")
    assert titles["1"] == ("Unit A",) and titles["2"] == ("Unit B",)
    assert None in got and loaders.load(staged, loaders.RELATIONAL, now()).columns == list(loaders.RELATIONAL_COLUMNS)


def test_given_amounts_go_first(spark):
    df = spark.sql(
        """select 'u' as url, 'Given' as listing_title, 'No' as title, parse_json('{"value":1,"currency":"USD"}') as price,
        parse_json('"5 sqm"') as area, parse_json('7') as area_sqm, 'PHP' as price_currency, '70' as price_value"""
    )
    row = loaders.load(df, loaders.RELATIONAL, now()).first()
    assert (row["listing_title"], row["price_php"], row["area_sqm"], row["price_per_sqm"]) == ("Given", 70.0, 7.0, 10.0)
    assert str(row["as_of_date"]) == "2024-06-01"  # no scraped_at column at all


def test_publish(staged):
    got = loaders.load(staged, loaders.PUBLISH, now(), "shop")
    assert by_unit(got, "price_php", "area_sqm", "source") == {"1": (95200.0, 184.0, "shop")}
    assert set(got.columns) == set(loaders.PUBLISH_COLUMNS)


def test_dump(staged):
    rows = loaders.writable(loaders.load(staged, loaders.DUMP, now(), "shop"), now())
    got = by_unit(rows, "listing_title", "price_php", "scraped_at", "published_at", "description", "source_env")
    assert got["1"] == ("Unit A", 95200.0, dt.datetime(2024, 1, 2, 3, 4, 5, 1), dt.datetime(2023, 12, 31, 16), " ", "prod")
    assert got["3"][:3] == ("Unit C", None, dt.datetime(2024, 6, 1)) and None not in got
    counts = loaders.ingest_counters(staged, now(), "shop").first().asDict()
    assert counts == {
        "rows_read": 5, "rows_written": 4, "has_description": 1, "has_published_at": 1, "price_and_area": 1,
        "skipped_invalid_url": 1,
    }


def test_flat_and_staged(staged):
    got = by_unit(loaders.load(staged, loaders.FLAT, now()), "price_value", "price_currency", "price_per_sqm", "scraped_at")
    assert got["1"] == (95200.0, "PHP", 95200 / 184, "2024-01-02T03:04:05") and got["4"] == (10.0, "USD", None, None)
    got = by_unit(loaders.load(staged, loaders.STAGED, now(), "shop"), "price_php", "price_per_sqm", "scraped_at")
    assert got["4"] == (10.0, None, dt.datetime(2024, 6, 1))


SECOND = [
    '{"url":"https://p.example.com/property/1","title":"","price":null,"area":{"sqm":100},"scraped_at":"2024-02-01T00:00:00+00:00"}',
    '{"url":"https://p.example.com/property/5","title":"Unit E","scraped_at":"2024-02-01T00:00:00+00:00"}',
]


def drop(spark, base, run, rows):
    lines = spark.createDataFrame([(x,) for x in rows], "value string").coalesce(1)
    lines.write.text(f"{base}/run_{run}/staged/shop_listings.jsonl")


def streamed(spark, base, checkpoint, **options):
    from plotwise.streaming import ingest

    ingest.ingest_listings(ingest.stream_staged(spark, base), checkpoint, now(), **options).awaitTermination()
    rows = ingest.listings(spark, checkpoint).withColumns({c: F.to_json(c) for c in ("price_json", "area_json")})
    return {r["url"]: r.asDict() for r in rows.collect()}


def test_drops_in_any_order_equal_one_batch(spark):
    results = []
    for drops in ([LINES, SECOND], [SECOND, LINES], [LINES + SECOND]):
        base, checkpoint = (scratch_path(spark, n) for n in ("drops", "cp"))
        for rows in drops:
            drop(spark, base, {id(LINES): "20240101_000000", id(SECOND): "20240102_000000"}.get(id(rows), "20240101_000000"), rows)
            got = streamed(spark, base, checkpoint)
        assert streamed(spark, base, checkpoint) == got  # nothing new, nothing changes
        results.append(got)
    assert results[0] == results[1] == results[2] and len(got) == 5
    row = got["https://p.example.com/property/1"]
    assert row["listing_title"] == "Unit A" and row["price_php"] == 95200.0 and row["area_sqm"] == 100.0
    assert row["scraped_at"] == dt.datetime(2024, 2, 1)


def test_late_rows_change_nothing_if_asked(spark):
    line = '{{"url":"u","title":"{}","address":{},"scraped_at":"2024-0{}-01T00:00:00+00:00"}}'
    base, checkpoint = (scratch_path(spark, n) for n in ("drops", "cp"))
    drop(spark, base, "1", [line.format("March", "null", 3)])
    streamed(spark, base, checkpoint, ignore_late=True)
    drop(spark, base, "2", [line.format("January", '"old"', 1), line.format("May", "null", 5), line.format("April", '"kept"', 4)])
    row = streamed(spark, base, checkpoint, ignore_late=True)["u"]
    assert (row["listing_title"], row["address"], row["scraped_at"].month) == ("May", "kept", 5)


def test_a_failed_batch_is_run_again_from_the_state_before_it(spark, monkeypatch):
    from plotwise.streaming import ingest

    base, checkpoint = (scratch_path(spark, n) for n in ("drops", "cp"))
    drop(spark, base, "1", LINES)
    before = streamed(spark, base, checkpoint)
    drop(spark, base, "2", SECOND)

    def broken(self, key, rows, timers):
        raise RuntimeError("lost")
        yield

    with monkeypatch.context() as m:
        m.setattr(ingest.ListingState, "handleInputRows", broken)
        with pytest.raises(Exception, match="lost"):
            ingest.ingest_listings(ingest.stream_staged(spark, base), checkpoint, now()).awaitTermination()
    kept = ingest.listings(spark, checkpoint).count()
    after = streamed(spark, base, checkpoint)
    assert kept == len(before) < len(after) == 5


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.text(max_size=2))), min_size=1, max_size=8), st.randoms())
def test_folding_does_not_depend_on_the_order(rows, draw):
    from plotwise.streaming.ingest import folded

    made = [[*values, [None if v is None else f"{i:03d}" for v in values], f"{i:03d}"] for i, values in enumerate(rows)]
    shuffled = draw.sample(made, len(made))

    def fold(some):
        held = None
        for row in some:
            held = folded(held, row)
        return held

    whole = fold(made)
    cut = draw.randint(0, len(made))
    halves = [h for h in (fold(shuffled[:cut]), fold(shuffled[cut:])) if h is not None]
    assert fold(shuffled) == whole == fold(halves)
    for column in (0, 1):
        assert whole[column] == next((v[column] for v in reversed(rows) if v[column] is not None), None)


def test_snapshots_written_twice_are_worked_out_once(spark, monkeypatch):
    from checks import merging

    plans, write = [], merge.append_snapshots

    def seen(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path)

    monkeypatch.setattr(merge, "append_snapshots", seen)
    assert merging.snapshot_seen_dates(spark, "/root/testdata/sf0.001").count() > 0
    assert len(plans) == 2 and not any("lineitem" in p or "Join" in p for p in plans)


@pytest.fixture
def freed_while_written(monkeypatch):
    """What the setting that drops shuffle files says at each write of Parquet."""
    from pyspark.sql.readwriter import DataFrameWriter

    from plotwise.session import FREED

    said, write = [], DataFrameWriter.parquet

    def seen(self, *args, **kwargs):
        said.append(self._spark.conf.get(FREED))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    return said


def test_shuffle_files_go_with_the_write_they_were_for(spark, freed_while_written):
    from plotwise.plans import metrics
    from plotwise.session import FREED, stored

    before = spark.conf.get(FREED)
    rows = spark.createDataFrame([("a", "2024-01-01 01:00:00"), ("b", "2024-01-02 01:00:00")], "listing_id string, seen_at string")
    rows = rows.select("listing_id", F.col("seen_at").cast("timestamp").alias("seen_at"), F.to_date("seen_at").alias("day"))
    path = scratch_path(spark, "snapshots")
    merge.append_snapshots(stored(rows, "rows"), path)
    metrics.fold_sightings(spark.read.parquet(path), [dt.date(2024, 1, 1)], scratch_path(spark, "sightings"))
    assert freed_while_written == ["true"] * 3 and spark.conf.get(FREED) == before


def test_snapshots_travel_by_url(spark):
    rows = spark.createDataFrame([("u", dt.datetime(2024, 1, 1, h), float(h)) for h in (1, 5, 3)], "url string, seen_at timestamp, price_php double")
    for name in ("area_sqm", "price_per_sqm", "property_type", "source"):
        rows = rows.withColumn(name, F.lit(None).cast("string"))
    got = merge.daily_snapshots(rows, ["seen_at"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(url" in plan and "hashpartitioning(listing_id" not in plan
    (row,) = got.collect()
    assert row["price_php"] == 5.0 and row["listing_id"] == spark.range(1).select(F.sha2(F.lit("u"), 256)).first()[0]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, 1, 2]), st.sampled_from([None, 0.0, float("nan"), 3.0]), st.sampled_from([None, "x", "y"])), max_size=12))
def test_a_row_compared_whole_is_the_row_picked_by_its_order(spark, rows):
    from plotwise.operators.dedupe import argmax_rows, row_hash

    df = spark.createDataFrame(rows, "k string, o int, v double, t string")
    for order in (["o"], [F.col("o").isNull(), "v"], ["t", "o", "t"]):
        picks = [F.col(c) if isinstance(c, str) else c for c in order]
        plain = df.groupBy("k").agg(F.max_by(F.struct("o", "v", "t"), F.struct(*picks, row_hash(df))).alias("r")).select("k", "r.*")
        got, want = (sorted(map(repr, d.collect())) for d in (argmax_rows(df, ["k"], order), plain))
        assert got == want
