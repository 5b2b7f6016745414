import datetime as dt
import json
import random

import pyarrow as pa
from pyspark.sql import functions as F

from plotwise.functions.html import ORDER, _as_arrow, parse_blocks, strict_blocks, tokens_of
from plotwise.operators import extract, jsonld, quality, selectors
from plotwise.operators.selectors import Probe
from plotwise.plans import details

def at():
    return F.lit("2024-05-05").cast("timestamp")


def probes(spark, html, named):
    """What the probes read of a page, None where a selector matches nothing."""
    df = spark.createDataFrame([(html,)], "html string")
    found = selectors.with_found(selectors.tokenised(df), {str(i): p for i, p in enumerate(named)})
    got = found.select("found").first()["found"]
    return [got.get(str(i)) for i in range(len(named))]


PAGE = """<!doctype html><html><head><title>T &amp; t</title><script>var a = "<h1>no</h1>";</script></head>
<body><nav aria-label="breadcrumb"><a href="/a">A</a> &gt; <a href='/b' class="x y">B</a></nav>
<div id="main" class="card big"><h2> In <em>two</em><!-- gone -->parts</h2><p>one<p>two <br>lines</div>
<meta itemprop=price content="5"><time datetime="2024-01-02">Jan</time><time>bare</time></body>"""


ON_PAGE = {
    "title": "T & t",
    "h1": None,
    "h2": "In two parts",
    "#main h2 em": "two",
    "div > em": None,
    "div.card.big > h2": "In two parts",
    "[aria-label='breadcrumb'] a": "A",
    "a.y": "B",
    "a[href$='b']": "B",
    "a[href^=\"/b\"], a": "A",
    "a[class~=y]": "B",
    "p": "one",
    "p br": "",
    "meta[itemprop=price]": "5",
    "time": "Jan",
    "body *": "A > B",
    "p:first-child": None,
    "div[[": None,
    "": None,
}


def test_selectors_on_a_page(spark):
    assert dict(zip(ON_PAGE, probes(spark, PAGE, [Probe(s) for s in ON_PAGE]))) == ON_PAGE


def test_reads(spark):
    named = [
        Probe("time[datetime]", "datetime"), Probe("time:has(x), b", "datetime"), Probe("a", "@href"), Probe("meta", "element"),
        Probe("a", "@gone"), Probe("time:not([datetime])", "datetime"),
    ]
    assert probes(spark, PAGE, named) == ["2024-01-02", None, "/a", "", None, "bare"]


def test_unclosed_markup_ends_where_a_browser_ends_it(spark):
    assert probes(spark, "<p><b>bold<br><p>next", [Probe("b")]) == ["bold"]
    assert probes(spark, "<ul><li>a<li>b</ul>c", [Probe("li")]) == ["a"]
    assert probes(spark, "<h1>x<p>y</p>", [Probe("h1")]) == ["x"]


def test_page_text_skips_scripts():
    assert " ".join(tokens_of(PAGE)["texts"]) == "T & t A > B In two parts one two lines Jan bare"


def test_elements_are_intervals():
    """Starts count up; what a start and an end hold is the subtree; parents and places agree."""
    elements = tokens_of(PAGE)["elements"]
    assert [e["start"] for e in elements] == list(range(1, len(elements) + 1))
    for e in elements:
        children = [c for c in elements if c["parent"] == e["start"]]
        assert e["end"] == max([e["start"], *[c["end"] for c in children]])
        assert [c["nth"] for c in children] == list(range(1, len(children) + 1))
        assert [c["last"] for c in children] == [False] * (len(children) - 1) + [True] * bool(children)
        assert all(e["text_from"] <= c["text_from"] <= c["text_to"] <= e["text_to"] for c in children)


def test_bad_pages_are_data(spark):
    html = ["<a href=x>ok", "", None, "<" * 50, "<a\x00b><![CDATA[", "<a href=y>" * 3000]
    df = spark.createDataFrame(list(enumerate(html)), "i int, html string")
    rows = selectors.with_links(selectors.tokenised(df), {"a": "a"}).orderBy("i").select("groups", "_tokens.error").collect()
    assert rows[0]["groups"] == {"a": ["x"]} and rows[1]["groups"] is None and all(r["error"] is None for r in rows)
    assert rows[5]["groups"] == {"a": ["y"] * 3000}


BLOCKS = {
    '{"a":1}': [{"a": 1}],
    '[{"a":1},2]': [[{"a": 1}, 2]],
    '{"a":1}\n{"b":2}': [{"a": 1}, {"b": 2}],
    '{"a":1}\n{"b":2}\n{bad': [{"a": 1}, {"b": 2}],
    '{bad}\n{"b":2}': [],
    '{"a":1} garbage': [],
    "  ": [],
    '{"a":1,"a":2}': [{"a": 2}],
}


def test_blocks():
    assert {k: [json.loads(b) for b in parse_blocks([k])] for k in BLOCKS} == BLOCKS
    assert [json.loads(b) for b in parse_blocks(list(BLOCKS))] == [b for v in BLOCKS.values() for b in v]
    assert parse_blocks(["[" * 100_000, '{"ok":1}']) == ['{"ok": 1}']


def nodes_of(spark, *scripts):
    df = spark.createDataFrame(list(enumerate(scripts)), "i int, s array<string>")
    nodes = jsonld.jsonld_nodes(df, strict_blocks("s"), ["i"])
    rows = nodes.select("i", "block", "path", "types", F.to_json("body").alias("body")).orderBy("i", "block", "path").collect()
    return [[r for r in rows if r["i"] == i] for i in range(len(scripts))]


def walked(tree):
    """Every object of a tree, parents first, in document order."""
    if isinstance(tree, dict):
        yield {k: v for k, v in tree.items()}
        for value in tree.values():
            yield from walked(value)
    elif isinstance(tree, list):
        for value in tree:
            yield from walked(value)


def unmarked(tree):
    if isinstance(tree, dict):
        return {k: unmarked(v) for k, v in tree.items() if k != ORDER}
    return [unmarked(v) for v in tree] if isinstance(tree, list) else tree


def random_tree(draw, depth):
    kind = draw.random()
    if depth == 0 or kind < 0.2:
        return draw.choice([1, "x", True, ""])
    if kind < 0.5:
        return [random_tree(draw, depth - 1) for _ in range(draw.randint(0, 3))]
    names = draw.sample(["@type", "z", "a", "offers", "é", "k.x", "m"], draw.randint(0, 5))
    return {n: draw.choice(["A", ["A", "B"], 5]) if n == "@type" else random_tree(draw, depth - 1) for n in names}


def test_nodes_equal_a_walk(spark):
    draw = random.Random(2)
    trees = [random_tree(draw, draw.randint(1, 9)) for _ in range(60)]
    for tree, rows in zip(trees, nodes_of(spark, *[[json.dumps(t)] for t in trees])):
        assert [unmarked(json.loads(r["body"])) for r in rows] == list(walked(tree))


def test_nodes_in_document_order(spark):
    tree = {"@type": "A", "z": {"@type": ["B", "C"], "q": [{"n": 1}, [{"n": 2}]]}, "a": {"@type": "D"}}
    (rows,) = nodes_of(spark, [json.dumps(tree)])
    assert [r["types"] for r in rows] == [["A"], ["B", "C"], [], [], ["D"]]


def test_half_an_emoji_and_numbers_beyond_json(spark):
    bad = '{"@type":"Offer","name":"cut \\ud83d","price":5,"x":NaN,"y":-Infinity,"z":1e999}'
    deep = '{"@type":"Offer","a":' * 70 + "1" + "}" * 70
    got = nodes_of(spark, [bad], [deep], ["[" * 100_000], None, [None, " "])
    assert json.loads(got[0][0]["body"]) == {"@type": "Offer", "name": "cut \ufffd", "price": 5, "x": None, "y": None, "z": None}
    assert len(got[1]) == 70 and got[2:] == [[], [], []]
    page = f"<h1>T</h1><script type='application/ld+json'>{bad}</script>"
    assert record(spark, page)["price"]["value"] == 5.0


def test_a_row_that_cannot_be_converted_fails_alone():
    kind = pa.struct([("x", pa.string())])
    got = _as_arrow([{"x": "a"}, {"x": "\ud83d"}, {"x": "b"}], kind, lambda e: {"x": type(e).__name__})
    assert [r["x"] for r in got.to_pylist()] == ["a", "UnicodeEncodeError", "b"]


LIST = "<h1>T</h1><p>a</p><ul><li id=A class='x y'>1<li>2<li>3</ul><p class=x>b</p><a HREF=X>l</a>"
SELECTED = {
    "li:nth-child(2)": "2",
    "li:nth-child(2n+1)": "1",
    "li:nth-child(odd):not(.x)": "3",
    "li:nth-child(-n+1)": "1",
    "li:nth-child(7)": None,
    "ul > li:first-child": "1",
    "li:last-child": "3",
    "h1 + p": "a",
    "h1 ~ p.x": "b",
    "h1 + ul": None,
    "li:not(#A)": "2",
    "li + li + li": "3",
    "a[href='x']": None,
    "a[href='x' i]": "l",
    "p.x,li": "1",
    "p:not(.x) ~ a": "l",
}


def test_selectors(spark):
    assert dict(zip(SELECTED, probes(spark, LIST, [Probe(s) for s in SELECTED]))) == SELECTED


TAGS, CLASSES = ("div", "p", "b", "ul"), ("x", "y", "z")


def random_html(draw, depth):
    tag = draw.choice(TAGS[:1] + TAGS[2:])
    classes = " ".join(draw.sample(CLASSES, draw.randint(0, 2)))
    inner = "".join(random_html(draw, depth - 1) for _ in range(draw.randint(0, 3 if depth else 0)))
    return f'<{tag} class="{classes}" id="{draw.choice("uv")}">{inner}</{tag}>'


def plain_fits(e, compound):
    classes = dict(e["attrs"])["class"].split()
    tag, *rest = compound
    return tag in ("*", e["tag"]) and all(
        {".": lambda v: v in classes, "#": lambda v: dict(e["attrs"])["id"] == v, "!": lambda v: v not in classes, ":": lambda v: e["nth"] == v}[k](v)
        for k, v in rest
    )


def plain_matches(elements, chain):
    """Elements at the end of a chain of (relation, compound), every pair compared."""
    related = {
        " ": lambda a, b: a["start"] < b["start"] <= a["end"],
        ">": lambda a, b: b["parent"] == a["start"],
        "+": lambda a, b: a["parent"] == b["parent"] and b["nth"] == a["nth"] + 1,
        "~": lambda a, b: a["parent"] == b["parent"] and b["nth"] > a["nth"],
    }
    reached = [e for e in elements if plain_fits(e, chain[0][1])]
    for relation, compound in chain[1:]:
        reached = [e for e in elements if plain_fits(e, compound) and any(related[relation](a, e) for a in reached)]
    return {e["start"] for e in reached}


def written(chain):
    shown = {".": ".{}", "#": "#{}", "!": ":not(.{})", ":": ":nth-child({})"}
    return "".join(f" {r} " * bool(i) + c[0] + "".join(shown[k].format(v) for k, v in c[1:]) for i, (r, c) in enumerate(chain))


def test_joins_equal_comparing_every_pair(spark):
    draw = random.Random(6)
    pages = ["".join(random_html(draw, 5) for _ in range(3)) for _ in range(12)]
    chains = []
    for _ in range(80):
        compounds = [
            (draw.choice(["*", *TAGS]), *[draw.choice([(".", "x"), (".", "z"), ("#", "u"), ("!", "y"), (":", 2)]) for _ in range(draw.randint(0, 2))])
            for _ in range(draw.randint(1, 4))
        ]
        chains.append([(draw.choice(" >+~"), c) for c in compounds])
    rules = selectors.selector_rules(("", str(i), written(c)) for i, c in enumerate(chains))
    assert not rules.unsupported
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    tokens = selectors.tokenised(df)
    found = selectors.matches(selectors.elements_of(tokens), rules).join(tokens.select("_page", "i"), "_page")
    got = {(r["i"], int(r["name"]), r["start"]) for r in found.collect()}
    want = {(i, n, start) for i, p in enumerate(pages) for n, c in enumerate(chains) for start in plain_matches(tokens_of(p)["elements"], c)}
    assert got == want and len(want) > 500


def test_structural_joins_have_keys(spark):
    """No pair of elements is compared but by page and chain, and containment makes no pairs at all."""
    rules = selectors.selector_rules([("", "x", "div b > p + b ~ ul p")])
    tokens = selectors.tokenised(spark.createDataFrame([("<p>a",)], "html string"))
    text = selectors.matches(selectors.elements_of(tokens), rules)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text and "Window" in text


def test_unsupported_selectors_are_no_misses(spark):
    df = spark.createDataFrame([(1, LIST)], "i int, html string")
    bad = ["div[[", "li:has(a)", "", "a >", "::before", "li:nth-child(x)", "li:not(:not(a))"]
    hits = extract.selector_hits(df, {s: s for s in [*bad, "h1", "h6"]}, ["i"]).collect()
    assert {r["selector"]: r["hit"] for r in hits} == {**dict.fromkeys(bad), "h1": True, "h6": False}


def test_first_typed_takes_node_order(spark):
    script = '{"@graph":[{"@type":"Offer","n":1},{"@type":"Product","n":2}]}'
    df = spark.createDataFrame([(7, [script])], "i int, s array<string>")
    nodes = jsonld.jsonld_nodes(df, strict_blocks("s"), ["i"])
    got = jsonld.first_typed(nodes, ["i"], {"a": ("Product", "Offer"), "b": ("Thing",), "c": ("Product",)})
    got = got.select(*[F.try_variant_get(c, "$.n", "int") for c in "abc"]).first()
    assert tuple(got) == (1, None, 2)


def records(spark, pages, **options):
    df = spark.createDataFrame(pages, "url string, html string")
    return extract.detail_records(extract.read_details(df), at(), "Asia/Manila", **options)


def record(spark, html, **options):
    return records(spark, [("u", html)], **options).first()


def ld(text):
    return f'<script type="application/ld+json">{text}</script>'


FIELDS = [
    ("title", "<h1>a</h1><h1 data-testid='ad-title'>b</h1>", "b"),
    ("title", "<h1> </h1><h1>b</h1><meta property='og:title' content=' og '>", "og"),
    ("title", "<p>x</p>", None),
    ("address", "<span itemprop='address'>s</span><p class=address>p</p>", "p"),
    ("address", "<meta property='og:street-address' content='m'><p class=Breadcrumbs>c</p>", "m"),
    ("address", "<nav aria-label='breadcrumb'>a <b>b</b></nav>", "a b"),
    ("description", "<section data-testid='description'>d<br>e</section>", "d e"),
    ("published_at_text", "<time datetime='2024-01-02'>x</time><p class=date>y</p>", "2024-01-02"),
    ("published_at_text", "<div class=posted-date><time>12 Sep 2023</time></div>", "12 Sep 2023"),
    ("published_at_text", "<p class=date>2 months ago</p>", "2 months ago"),
    ("published_at", "<p class=date>on 12 Sept 2023</p>", dt.datetime(2023, 9, 11, 16)),
    ("published_at", "<time datetime='2024-01-02'>x</time>", None),
    ("published_at", "<p class=date>2 months ago</p>", None),
    ("property_type", ld('{"@type":"Offer","category":"Shop"}'), "Shop"),
    ("property_type", ld('{"@type":"RealEstateAgent"}'), "RealEstateAgent"),
    ("property_type", "nice officespace", "Offices"),
    ("property_type", "noncommercial", "Offices"),
    ("property_type", "backoffice", None),
    ("area", "<p>1,200 SQM lot, 5 m2</p>", ("1,200 SQM", 1200.0)),
    ("area", "<p>none</p>", None),
    ("price", "<p class=price>₱ 1,200.5 per MONTH</p>", ("₱ 1,200.5 per MONTH", "PHP", 1200.5, "month")),
    ("price", "<p class=price>call</p>" + ld('{"@type":"Offer","price":25000.5,"priceCurrency":"PHP"}'), ("call", "PHP", 25000.5, None)),
    ("price", ld('{"@type":"Offer","price":0,"offers":{"price":"1,5","priceCurrency":"USD"}}'), ("1,5", "USD", 15.0, None)),
    ("price", ld('{"@type":"Offer","price":"","offers":[{"price":1}]}'), None),
    ("price", ld('{"@type":"Offer","price":"POA"}'), ("POA", None, None, None)),
    ("price", "<p class=price>5</p>" + ld('{"@type":"Offer","price":9}'), ("5", None, 5.0, None)),
]


def test_fields(spark):
    pages = [(str(i), html) for i, (_, html, _) in enumerate(FIELDS)]
    got = {int(r["url"]): r for r in records(spark, pages).collect()}
    for i, (field, html, want) in enumerate(FIELDS):
        value = got[i][field]
        assert (tuple(value) if isinstance(value, tuple) else value) == want, html


def test_offer_date_needs_no_shown_text(spark):
    offer = ld('{"@type":"Article","datePublished":"soon","dateCreated":"2024-01-02T08:00:00"}')
    got = record(spark, offer)
    assert got["published_at_text"] == "2024-01-02T08:00:00" and got["published_at"] == dt.datetime(2024, 1, 2)
    got = record(spark, offer + "<p class=date>2 months ago</p>")
    assert got["published_at_text"] == "2 months ago" and got["published_at"] is None


def test_lenient_dates(spark):
    assert record(spark, "<p class=date>2 days ago</p>", lenient_dates=True)["published_at"] == dt.datetime(2024, 5, 3)
    assert record(spark, "<time datetime='2024-01-02'>x</time>", lenient_dates=True)["published_at"] == dt.datetime(2024, 1, 2)


def test_outcomes(spark):
    pages = spark.createDataFrame(
        [("a", "<h1>t</h1>"), ("b", "<p>no title</p>"), ("c", ""), ("d", None), ("z", "<h1>unused</h1>")],
        "url string, html string",
    )
    urls = spark.createDataFrame([(u, "p", "r") for u in "aabcde"], "url string, portal string, run string")
    rows = details.detail_outcomes(urls, pages, at())
    got = sorted((r["url"], r["reason"]) for r in rows.collect())
    assert got == [
        ("a", None), ("a", None), ("b", "missing_title"), ("c", "no_html"), ("d", "no_html"), ("e", "no_html"),
    ]
    counts = {r["outcome"]: r["urls"] for r in quality.outcome_counts(rows, ["portal"]).collect()}
    assert counts == {"ok": 2, "missing_title": 1, "no_html": 3}


def test_reason_order(spark):
    df = spark.createDataFrame(
        [("x", "ValueError", True, "t"), (None, "E", False, None), ("x", None, False, "t"), ("x", None, True, ""), ("x", None, True, "t")],
        "html string, error string, parsed boolean, title string",
    )
    got = df.select(quality.failure_reason(*[F.col(c) for c in df.columns])).collect()
    assert [r[0] for r in got] == ["exception:ValueError", "no_html", "parse_returned_none", "missing_title", None]


def test_failure_detail_is_cut(spark):
    df = spark.createDataFrame([("u", "exception:E", "x" * 3000), ("v", "no_html", "y")], "url string, reason string, detail string")
    rows = {r["url"]: r["detail"] for r in quality.failures(df, F.lit("now")).collect()}
    assert rows == {"u": "x" * 1000, "v": None}


def test_reader_keeps_first_of_doubled_attributes():
    assert tokens_of('<a href="1" href="2">')["elements"][0]["attrs"] == [("href", "1")]


def test_configured_fields(spark):
    html = "<h1>Head</h1><p class=p>₱ 5,000 / mo</p><i>40 sqm</i>"
    df = spark.createDataFrame([("u", html)], "url string, html string")
    got = extract.configured_fields(df, {"title": "h1", "price": ".p", "area": "i", "none": "b", "_w": "h1"}).first()
    assert got["fields"] == {"title": "Head", "price": "₱ 5,000 / mo", "area": "40 sqm"}
    assert got["price"]["value"] == 5000.0 and got["price"]["period"] == "month" and got["area"]["sqm"] == 40.0


def test_pages_are_tokenised_in_slices(monkeypatch):
    """Python objects of some pages at a time, whatever the size of the batch."""
    import pyarrow as pa

    from plotwise.functions import html

    held, whole = [], html._as_arrow

    def seen(rows, *rest):
        held.append(len(rows))
        return whole(rows, *rest)

    pages = [None, "", "<p>one</p>", "<b>" + "x" * 3000, "<i>é</i>", None, "<li>" * 50, "<h1>last</h1>"] * 40
    want = whole([html.tokens_of(p) for p in pages], html._ARROW_TYPE, html._failure)
    monkeypatch.setattr(html, "_as_arrow", seen)
    monkeypatch.setattr(html, "SLICE_BYTES", 4000)
    assert html._in_slices(pa.array(pages, pa.string()), html.tokens_of, html._ARROW_TYPE, html._failure).equals(want)
    assert max(held) < 20 and sum(held) == len(pages)
    assert len(html._in_slices(pa.array([], pa.string()), html.tokens_of, html._ARROW_TYPE, html._failure)) == 0
