import pytest
from pyspark.sql import functions as F

from plotwise.operators import discovery, projection, quality
from plotwise.session import scratch_path, shared_folder
from plotwise.sources import staged, tables


def lines(spark, path, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)


def test_latest_run_per_portal(spark):
    base = scratch_path(spark, "runs")
    for run, portal, url in (("1", "a", "u1"), ("2", "a", "u2"), ("1", "b", "u3"), ("10", "c", "u4")):
        lines(spark, f"{base}/run_2024010{run[0]}_00000{run}/staged/{portal}_listings.jsonl", [f'{{"url":"{url}"}}'])
    lines(spark, f"{base}/run_20240109_000000/staged/a_urls.jsonl", ['{"url":"x"}'])
    rows = staged.only_objects(staged.read_latest_dumps(spark, base, "listings"))
    assert {(r["portal"], r["url"]) for r in rows.collect()} == {("a", "u2"), ("b", "u3"), ("c", "u4")}
    assert staged.read_latest_dumps(spark, base, "listings", "b").first()["url"] == "u3"
    with pytest.raises(FileNotFoundError):
        staged.read_latest_dumps(spark, base, "failures")
    assert staged.read_dumps(spark, base, "listings").count() == 4


def test_single_file_dumps_are_read_like_folders(spark, tmp_path):
    folder = tmp_path / "run_20240101_000000" / "staged"
    folder.mkdir(parents=True)
    (folder / "shop_urls.jsonl").write_text('{"url":"a","discovered_at":"x"}\n{"url":""}\n{}\n[1]\n')
    rows = staged.read_latest_dumps(spark, str(tmp_path), "urls")
    assert rows.count() == 4 and rows.first()["portal"] == "shop"
    assert [r["url"] for r in staged.named_urls(rows).collect()] == ["a"]


def test_rerun_replaces_its_own_partition(spark):
    base = scratch_path(spark, "urls")
    at = F.lit("2024-01-01T00:00:00+00:00")

    def write(rows):
        staged.write_staged_urls(spark.createDataFrame(rows, "url string, run string, portal string"), base, at)

    write([("u1", "r1", "a"), ("u2", "r1", "b"), ("u3", "r2", "a")])
    write([("u9", "r1", "a")])
    got = {(r["run"], r["portal"], r["url"]) for r in staged.read_staged(spark, base, "urls").collect()}
    assert got == {("r1", "a", "u9"), ("r1", "b", "u2"), ("r2", "a", "u3")}


def test_save_modes(spark):
    df = spark.range(3)
    path = scratch_path(spark, "saved")
    name = "t_" + path.rsplit("-", 1)[1]
    tables.save_table(df, name, "fail", path)
    with pytest.raises(Exception, match="exists"):
        tables.save_table(df, name, "fail", path)
    tables.save_table(df, name, "append", path)
    assert spark.table(name).count() == 6
    tables.save_table(df, name, "replace", path)
    assert spark.table(name).count() == 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))


GOOD = '{"portal_name":"a","seed_urls":["https://x"],"scraping_mode":"requests","listing_selector":"a","headers":{"k":"v"}}'


def test_registry_shapes(spark):
    docs = spark.createDataFrame(
        [(f'{{"portals":[{GOOD},{GOOD.replace(chr(34) + "a" + chr(34), chr(34) + "b" + chr(34), 1)}]}}',), (f"[{GOOD}]",), (GOOD,), ("bad",)],
        "value string",
    )
    entries = tables.registry_entries(docs)
    assert entries.count() == 4
    rows = tables.portals(entries, ["b", " "]).collect()
    assert [(r["portal_name"], r["max_pages"], r["respect_robots"], r["headers"]) for r in rows] == [("b", 200, False, {"k": "v"})]
    assert tables.portals(entries, []).count() == 4
    with pytest.raises(LookupError):
        tables.require_portals(tables.portals(entries, ["zz"]), ["zz"])


def test_registry_and_pages_from_files(spark, tmp_path):
    (tmp_path / "portals.json").write_text('{\n "portals": [\n  ' + GOOD + "\n ]\n}\n")
    entries = tables.read_registry_entries(spark, str(tmp_path / "portals.json"))
    assert tables.portals(entries).first()["seed_urls"] == ["https://x"]
    path = scratch_path(spark, "pages")
    spark.createDataFrame([("u", "<h1>x</h1>", 1), ("v", None, 2)], "url string, html string, n int").write.parquet(path)
    pages = tables.read_pages_table(spark, path)
    assert pages.columns == ["url", "html"] and pages.count() == 2


def test_good_entry_breaks_no_rule(spark):
    entries = tables.registry_entries(spark.createDataFrame([(GOOD,), ("{}",)], "value string"))
    rows = quality.violations(entries, ["position"], quality.portal_rules(F.col("portal"), F.col("position"))).collect()
    assert sorted(r["message"] for r in rows) == sorted(
        f"[(index 0)] missing required key: {k}" for k in quality.REQUIRED_KEYS
    )


def test_summary_and_its_assertion(spark):
    registry = spark.createDataFrame([("a",), ("b",)], "portal string")
    urls = spark.createDataFrame([("a", "u")], "portal string, url string")
    rows = {r["portal"]: (r["urls"], r["is_total"]) for r in quality.discovery_summary(registry, urls).collect()}
    assert rows == {"a": (1, 0), "b": (0, 0), None: (1, 1)}
    with pytest.raises(Exception, match="no urls discovered"):
        quality.require_discovered(quality.discovery_summary(registry, urls.where("false"))).collect()


@pytest.mark.parametrize("cap", [0, 1, 2, 3, 5, 8, 100])
def test_walks(spark, cap):
    nxt = {f"l{i}": f"l{i + 1}" for i in range(12)} | {"l12": None}
    nxt |= {"c0": "c1", "c1": "c2", "c2": "c3", "c3": "c1", "lost": "nowhere", "self": "self", "x": "l5"}
    pages = spark.createDataFrame(list(nxt.items()), "url string, next_url string")
    seeds = {"long": "l0", "loop": "c0", "gone": "nowhere", "dead": "lost", "me": "self", "late": "x", "again": "l0"}
    got = {}
    for r in discovery.walk_pages(pages, spark.createDataFrame(list(seeds.items()), "portal string, url string"), cap).collect():
        got.setdefault(r["portal"], {})[r["page_no"]] = r["url"]
    want = {}
    for portal, url in seeds.items():
        seen = []
        while url in nxt and url not in seen and (not cap or len(seen) < cap):
            seen.append(url)
            url = nxt[url]
        if seen:
            want[portal] = dict(enumerate(seen))
    assert got == want


def test_next_links(spark):
    def page(attrs):
        return f'<a data-test="pagination-next" {attrs}>next</a><a data-test="pagination-next" href="/no">x</a>'

    cases = {
        'href="?page=2"': "https://h.org/list?page=2", 'href="/l/3"': "https://h.org/l/3", "": None, 'href=""': None,
        'href="/x" data-islast="TRUE"': None, 'href="/x" data-islast="1"': None, 'href="/x" data-islast="0"': "https://h.org/x",
    }
    df = spark.createDataFrame([(k, "https://h.org/list?page=1", page(k)) for k in cases], "k string, url string, html string")
    rows = discovery.next_links(discovery.read_result_pages(df)).collect()
    assert {r["k"]: r["next_url"] for r in rows} == cases


def test_listing_links(spark):
    html = '<a href="/property/1?x">a</a><a href="">b</a><a href="https://o.org/property/2/">c</a><a href="/other">d</a><a href="property/1">e</a>'
    df = spark.createDataFrame([("https://h.org/l/", html)], "url string, html string")
    rows = discovery.listing_links(discovery.read_result_pages(df)).orderBy("pos").collect()
    assert [(r["pos"], r["url"]) for r in rows] == [(0, "https://h.org/property/1"), (1, "https://o.org/property/2")]


def test_projections(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, id string, c double")
    assert projection.prefer_columns(df, ("c", "zz")).columns == ["c", "a", "id"]
    assert projection.allow_columns(df, {"a", "id", "q"}).columns == ["a"]
    from pyspark.sql import types as T

    kept = projection.keep_columns(df, T.StructType.fromDDL("c string, q int"))
    assert kept.schema.simpleString() == "struct<c:string,q:int>" and tuple(kept.first()) == ("2.0", None)
