"""CSS selectors as joins: elements are intervals, a selector is a chain of tests and relations.

A selector becomes rules, one per compound (`nav`, `a.next[href]`): an anchor that every
element it means must have, further tests, and how it stands to the compound before it.
Elements meet rules by anchor (equality join) and tests (filter). Child and next-sibling
relations are equality joins, a later sibling is one after the first, and containment goes
by one pass over a page's intervals in order: an element lies in another exactly if the
furthest end of those that began before it reaches it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plotwise.functions.html import tokenise
from plotwise.session import stored

TEST = "struct<kind string, name string, value string, fold boolean, step int, offset int>"
RULE = (
    "scope string, name string, chain int, step int, last_step boolean, relation string, anchor string, "
    f"tests array<{TEST}>, refused array<array<{TEST}>>"
)
FIELDS = ("start", "end", "parent", "nth", "last", "tag", "attrs", "text_from", "text_to")
LISTED_ANCHORS = 500  # so many are compared as a list before the join, to spare rows
SENT_RULES = 10_000  # so many go to the tasks whole

# one simple selector; an attribute's value may be followed by the flag i
_SIMPLE = re.compile(
    r"(?P<tag>[\w-]+|\*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)"
    r"|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[*^$~|]?=)\s*"
    r"(?:\"(?P<dq>[^\"]*)\"|'(?P<sq>[^']*)'|(?P<bare>[^\s\"'\]]+))(?:\s*(?P<flag>[iIsS]))?\s*)?\]"
    r"|:(?P<edge>first-child|last-child)|:nth-child\(\s*(?P<nth>[^()]*?)\s*\)|:not\(\s*(?P<no>[^():]*?)\s*\)"
)
_COMBINED = re.compile(r"\s*([>+~])\s*|\s+")
_NTH = re.compile(r"(?P<step>[+-]?\d*)n(?:\s*(?P<plus>[+-]\s*\d+))?|(?P<only>[+-]?\d+)")


class Probe(NamedTuple):
    """What to read of the first element a selector group matches.

    read: 'text' (a meta element gives its content), 'datetime' (that attribute, else
    the text), 'element' (always its text), or '@name' for an attribute.
    """

    selector: str
    read: str = "text"


# --- selectors as rules ---------------------------------------------------------


def _test(kind, name=None, value=None, fold=False, step=None, offset=None):
    return kind, name, value, fold, step, offset


def _nth(text: str):
    """(step, offset) of an+b, or None."""
    named = {"odd": "2n+1", "even": "2n"}.get(text.lower(), text.lower())
    m = _NTH.fullmatch(named)
    if not m:
        return None
    if m["only"]:
        return 0, int(m["only"])
    step = {"": 1, "+": 1, "-": -1}.get(m["step"])
    return int(m["step"]) if step is None else step, int((m["plus"] or "0").replace(" ", ""))


def _compound(text: str, at: int, nested=False):
    """(tests, refused groups, end) of the simple selectors that stand side by side, or None."""
    tests, refused, start = [], [], at
    while m := _SIMPLE.match(text, at):
        if m["tag"] and at > start:
            return None
        at = m.end()
        if m["tag"]:
            tests.append(_test("tag", value=m["tag"].lower()))
        elif m["id"]:
            tests.append(_test("=", "id", m["id"]))
        elif m["cls"]:
            tests.append(_test("~=", "class", m["cls"]))
        elif m["attr"]:
            value = next((m[g] for g in ("dq", "sq", "bare") if m[g] is not None), "")
            fold = (m["flag"] or "").lower() == "i"
            tests.append(_test(m["op"] or "has", m["attr"].lower(), value.lower() if fold else value, fold))
        elif m["edge"]:
            tests.append(_test(m["edge"]))
        elif m["nth"] is not None:
            if (nth := _nth(m["nth"])) is None:
                return None
            tests.append(_test("nth", step=nth[0], offset=nth[1]))
        else:
            inner = None if nested else _compound(m["no"], 0, nested=True)
            if not inner or inner[2] != len(m["no"]):
                return None
            refused.append(inner[0])
    return (tests, refused, at) if at > start else None


def _chains(selector: str):
    """A selector group as chains [(relation, tests, refused), ...] from the left; None if unsupported.

    Supported are tag, #id, .class, [attr] (with flag i), first, last and nth child, :not of
    simple selectors, the four combinators and groups.
    """
    chains = []
    for alternative in re.split(r",(?![^\[(]*[\])])", selector):
        text, chain, at, relation = alternative.strip(), [], 0, ""
        while True:
            found = _compound(text, at)
            if not found:
                return None
            tests, refused, at = found
            chain.append((relation, tests, refused))
            if at == len(text):
                break
            m = _COMBINED.match(text, at)
            if not m:
                return None
            relation, at = m[1] or " ", m.end()
        chains.append(chain)
    return chains


def _anchor(tests) -> str:
    """The rarest thing an element must have to pass the tests."""
    named = {("class" if k == "~=" and n == "class" else "attr" if n else k): (n, v) for k, n, v, *_ in reversed(tests)}
    if "class" in named and named["class"][1]:
        return f"class {named['class'][1]}"
    if "attr" in named:
        return f"attr {named['attr'][0]}"
    return f"tag {named['tag'][1] if 'tag' in named else '*'}"


class Rules(NamedTuple):
    rows: list  # of RULE
    unsupported: frozenset  # names of selectors that are no rules

    @property
    def steps(self) -> list[set[str]]:
        """The relations that occur at each step."""
        out: list[set[str]] = []
        for _, _, _, step, _, relation, *_ in sorted(self.rows, key=lambda r: r[3]):
            out += [set()] * (step + 1 - len(out))
            out[step] = out[step] | {relation}
        return out


def selector_rules(selectors: Iterable[tuple[str, str, str]]) -> Rules:
    """Rules of (scope, name, selector); the rules of a scope apply to the pages of that scope alone."""
    rows, unsupported, number = [], set(), 0
    for scope, name, selector in selectors:
        chains = _chains(selector)
        if chains is None:
            unsupported.add(name)
            continue
        for chain in chains:
            for step, (relation, tests, refused) in enumerate(chain):
                rows.append((scope, name, number, step, step == len(chain) - 1, relation, _anchor(tests), tests, refused))
            number += 1
    return Rules(rows, frozenset(unsupported))


def supported(selector: str) -> bool:
    """Is the selector one that can be answered?"""
    return _chains(selector) is not None


# --- rules against elements -------------------------------------------------------


def _passes(test: Column) -> Column:
    """Does the element of the row pass a test?"""
    kind, value = test["kind"], test["value"]
    have = F.coalesce(F.try_element_at("attrs", test["name"]), F.lit(""))
    have = F.when(test["fold"], F.lower(have)).otherwise(have)
    away = F.col("nth") - test["offset"]
    nth = F.when(test["step"] == 0, away == 0).otherwise((away % test["step"] == 0) & (away / test["step"] >= 0))
    told = value != ""
    by_value = (
        F.when(kind == "has", True)
        .when(kind == "=", have == value)
        .when(kind == "*=", told & F.contains(have, value))
        .when(kind == "^=", told & F.startswith(have, value))
        .when(kind == "$=", told & F.endswith(have, value))
        .when(kind == "~=", told & F.array_contains(F.split(have, r"\s+"), value))
        .otherwise((have == value) | F.startswith(have, F.concat(value, F.lit("-"))))
    )
    return (
        F.when(kind == "tag", (value == "*") | (value == F.col("tag")))
        .when(kind == "first-child", F.col("nth") == 1)
        .when(kind == "last-child", F.col("last"))
        .when(kind == "nth", nth)
        .otherwise(F.map_contains_key(F.col("attrs"), test["name"]) & by_value)
    )


def _anchors(used: set[str]) -> Column:
    """What rules may be anchored to in the element of the row."""
    classes = F.split(F.coalesce(F.try_element_at("attrs", F.lit("class")), F.lit("")), r"\s+")
    every = F.concat(
        F.array(F.concat(F.lit("tag "), F.col("tag")), F.lit("tag *")),
        F.transform(F.map_keys("attrs"), lambda name: F.concat(F.lit("attr "), name)),
        F.transform(classes, lambda name: F.concat(F.lit("class "), name)),
    )
    every = F.array_distinct(every)
    return F.filter(every, lambda a: a.isin(sorted(used))) if len(used) <= LISTED_ANCHORS else every


def candidates(elements: DataFrame, rules: Rules) -> DataFrame:
    """The elements that pass a compound's own tests, a row per compound."""
    spark = elements.sparkSession
    table = spark.createDataFrame(rules.rows, RULE)
    anchored = elements.withColumn("anchor", F.explode(_anchors({r[6] for r in rules.rows})))
    # Spark cannot tell the size of the rules, and a file's tells little of the elements in it: it would send those
    met = anchored.join(table.hint("broadcast" if len(rules.rows) <= SENT_RULES else "merge"), ["scope", "anchor"])
    refused = F.forall("refused", lambda group: F.exists(group, lambda t: ~_passes(t)))
    met = met.where(F.forall("tests", _passes) & refused)
    return met.select("_page", "scope", "name", "chain", "step", "last_step", "relation", *FIELDS)


def _children(inner: DataFrame, outer: DataFrame) -> DataFrame:
    return inner.join(outer.select("_page", "chain", F.col("start").alias("parent")), ["_page", "chain", "parent"], "left_semi")


def _next_siblings(inner: DataFrame, outer: DataFrame) -> DataFrame:
    beside = outer.select("_page", "chain", "parent", (F.col("nth") + 1).alias("nth"))
    return inner.join(beside, ["_page", "chain", "parent", "nth"], "left_semi")


def _later_siblings(inner: DataFrame, outer: DataFrame) -> DataFrame:
    first = outer.groupBy("_page", "chain", "parent").agg(F.min("nth").alias("_first"))
    return inner.join(first, ["_page", "chain", "parent"]).where("nth > _first").drop("_first")


def _descendants(inner: DataFrame, outer: DataFrame) -> DataFrame:
    both = outer.withColumn("_outer", F.lit(True)).unionByName(inner.withColumn("_outer", F.lit(False)))
    # an element that is both stands before itself, so it does not hold itself
    before = Window.partitionBy("_page", "chain").orderBy("start", "_outer").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(F.col("_outer"), F.col("end"))).over(before)
    held = both.withColumn("_reach", reach).where(~F.col("_outer") & (F.col("_reach") >= F.col("start")))
    return held.drop("_outer", "_reach")


RELATED = {">": _children, "+": _next_siblings, "~": _later_siblings, " ": _descendants}


def matches(elements: DataFrame, rules: Rules) -> DataFrame:
    """_page, scope, name and the element, for every element a selector matches.

    elements: _page, scope and the fields of an element. Only elements that pass some
    compound are joined with one another; chains advance together, a step at a time, whatever the
    number of selectors. An element that two alternatives match comes twice.
    """
    met, steps = candidates(elements, rules), rules.steps
    if len(steps) > 1:
        met = stored(met, "compounds")
    reached = met.where("step = 0")
    found = reached.where("last_step")
    for step, relations in enumerate(steps[1:], 1):
        outer, now = reached.where("NOT last_step"), None
        for relation in sorted(relations):
            inner = met.where((F.col("step") == step) & (F.col("relation") == relation))
            part = RELATED[relation](inner, outer).select(*met.columns)
            now = part if now is None else now.unionByName(part)
        reached = now
        found = found.unionByName(reached.where("last_step"))
    return found.select("_page", "scope", "name", *FIELDS)


# --- pages --------------------------------------------------------------------------


def tokenised(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with a number for each row and its tokens in place of the HTML, stored.

    Each page is read once; the readers below take the elements or the texts of the table.
    """
    read = pages.withColumn("_tokens", tokenise(html)).drop(html)
    return stored(read.withColumn("_page", F.monotonically_increasing_id()), "tokens")


def elements_of(tokens: DataFrame, scope: Column | None = None) -> DataFrame:
    """A row per element."""
    scope = F.lit("") if scope is None else scope
    return tokens.select("_page", scope.alias("scope"), F.inline("_tokens.elements"))


def first_elements(found: DataFrame) -> DataFrame:
    """_page, firsts: the first element of each selector, by name."""
    first = F.min_by(F.struct("tag", "attrs", "text_from", "text_to"), "start")
    each = found.groupBy("_page", "name").agg(first.alias("element"))
    return each.groupBy("_page").agg(F.map_from_entries(F.collect_list(F.struct("name", "element"))).alias("firsts"))


def linked(found: DataFrame) -> DataFrame:
    """_page, groups: the non-empty hrefs of each selector's elements, in page order, by name."""
    href = F.try_element_at("attrs", F.lit("href"))
    links = found.select("_page", "name", "start", href.alias("href")).where("href <> ''")
    each = links.groupBy("_page", "name").agg(F.sort_array(F.collect_set(F.struct("start", "href"))).alias("links"))
    hrefs = F.transform("links", lambda link: link["href"])
    return each.groupBy("_page").agg(F.map_from_entries(F.collect_list(F.struct("name", hrefs))).alias("groups"))


def _said(element: Column, texts: Column, read: str) -> Column:
    """What a probe reads of an element; NULL if there is none or the attribute is absent."""
    text = F.array_join(F.slice(texts, element["text_from"] + 1, element["text_to"] - element["text_from"]), " ")
    if read.startswith("@"):
        return F.try_element_at(element["attrs"], F.lit(read[1:]))
    if read == "datetime":
        return F.coalesce(F.nullif(F.try_element_at(element["attrs"], F.lit("datetime")), F.lit("")), text)
    if read == "text":
        content = F.coalesce(F.try_element_at(element["attrs"], F.lit("content")), F.lit(""))
        return F.when(element["tag"] == "meta", content).otherwise(text)
    return text


def with_found(tokens: DataFrame, probes: dict[str, Probe]) -> DataFrame:
    """Tokenised pages plus found: what each probe reads, for the probes whose selector matched."""
    rules = selector_rules(("", name, p.selector) for name, p in probes.items())
    if not rules.rows:
        return tokens.withColumn("found", F.create_map().cast("map<string,string>"))
    firsts = first_elements(matches(elements_of(tokens), rules))
    texts = F.col("_tokens")["texts"]
    said = [
        F.struct(F.lit(name).alias("key"), _said(F.try_element_at("firsts", F.lit(name)), texts, p.read).alias("value"))
        for name, p in probes.items()
    ]
    found = F.map_from_entries(F.filter(F.array(*said), lambda s: s["value"].isNotNull()))
    return tokens.join(firsts, "_page", "left").withColumn("found", found).drop("firsts")


def with_links(tokens: DataFrame, selectors: dict[str, str]) -> DataFrame:
    """Tokenised pages plus groups: the hrefs of each named selector, in page order."""
    rules = selector_rules(("", name, selector) for name, selector in selectors.items())
    if not rules.rows:
        return tokens.withColumn("groups", F.create_map().cast("map<string,array<string>>"))
    return tokens.join(linked(matches(elements_of(tokens), rules)), "_page", "left")


def page_text() -> Column:
    """All texts of a tokenised page."""
    return F.array_join(F.col("_tokens")["texts"], " ")
