"""URL work as column expressions: canonical form, link resolution, page numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plotwise.functions import add_layers
from plotwise.functions.text import empty_to_null

# scheme, authority (with its slashes), path, query, fragment
URL_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


CONTROL = "".join(chr(c) for c in range(0x21))


def _tidy(url: Column) -> Column:
    """Line breaks and tabs are dropped anywhere, control characters in front."""
    return F.ltrim(F.translate(url, "\t\r\n", ""), F.lit(CONTROL))


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL_PARTS, group)


# An address that needs no tidying: a lower-case scheme, no ;params.
PLAIN_URL = r"^[a-z][a-z0-9+.\-]*://[^\t\r\n;]*$"


def canonical_url(url: Column) -> Column:
    """scheme://host/path without query, fragment, ;params and trailing slashes.

    NULL for an address without a scheme: it names no page on its own. Plain addresses, by
    far the most, are only cut.
    """
    cut = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    tidy = _tidy(url)
    bare = F.regexp_replace(F.regexp_replace(tidy, "(?s)[?#].*$", ""), r"(?<=/)([^/;]*);[^/]*$", "$1")
    scheme = F.lower(_part(tidy, 1))
    rest = F.regexp_replace(F.substr(bare, F.length(scheme) + 2), "^//", "")
    return (
        F.when(url.rlike(PLAIN_URL), F.rtrim(cut, F.lit("/")))
        .when(tidy.rlike(r"^[a-z][a-z0-9+.\-]*://"), F.rtrim(bare, F.lit("/")))
        .when(scheme != "", F.rtrim(F.concat(scheme, F.lit("://"), rest), F.lit("/")))
    )


def with_resolved(df: DataFrame, out: str, page_url: Column, href: Column) -> DataFrame:
    """Absolute address of a link found on a page (RFC 3986 reference resolution).

    Rooted links without dots, by far the most, need no parts: theirs stay NULL.
    """

    def c(name):
        return F.col(f"__{out}_{name}")

    def layer(**columns):
        return {f"__{out}_{name}": column for name, column in columns.items()}

    origin = F.regexp_extract(c("base"), r"^[a-z][a-z0-9+.\-]*://[^/?#]*", 0)
    rooted = c("link").rlike(r"^/(?!/)[^?#]*$") & ~c("link").contains("/.")
    hard = c("easy").isNull()
    own = F.split(c("path"), "/")
    folder = F.split(F.regexp_replace(c("base_path"), r"[^/]*$", ""), "/")
    beside = F.concat(F.slice(folder, F.lit(1), F.greatest(F.size(folder) - 1, F.lit(0))), own)
    # empty segments survive only at both ends of a path put together from two
    merged = F.filter(
        c("parts"), lambda seg, i: (seg != "") | (i == 0) | (i == F.size(c("parts")) - 1)
    )
    kept = F.aggregate(
        c("parts"),
        F.array().cast("array<string>"),
        lambda done, seg: F.when(
            seg == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        )
        .when(seg == ".", done)
        .otherwise(F.concat(done, F.array(seg))),
    )
    open_end = F.element_at(c("parts"), -1).isin(".", "..")
    joined = F.concat(F.array_join(c("kept"), "/"), F.when(open_end & (F.size(c("kept")) > 0), "/").otherwise(""))
    whole = F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))
    root = F.concat(c("scheme"), F.lit(":"), c("host"))
    address = (
        F.when(c("base") == "", c("link"))
        .when(c("link") == "", c("base"))
        .when((c("own_scheme") != "") & (c("own_scheme") != c("scheme")), c("link"))
        .when(
            c("own_host") != "",
            F.concat(c("scheme"), F.lit(":"), c("own_host"), c("path"), c("query"), c("fragment")),
        )
        .when(
            c("path") == "",
            F.concat(
                root,
                c("base_path"),
                F.when(c("query") != "", c("query")).otherwise(c("base_query")),
                c("fragment"),
            ),
        )
        .otherwise(F.concat(root, whole, c("query"), c("fragment")))
    )
    base_parts = {"scheme": 1, "host": 2, "base_path": 3, "base_query": 4}
    link_parts = {"own_scheme": 1, "own_host": 2, "path": 3, "query": 4, "fragment": 5}
    parts = {n: _part(c("base"), g) for n, g in base_parts.items()}
    parts |= {n: _part(c("link"), g) for n, g in link_parts.items()}
    for name in ("scheme", "own_scheme"):
        parts[name] = F.lower(parts[name])
    for name in ("query", "fragment"):  # a bare '?' or '#' is dropped
        parts[name] = F.regexp_replace(parts[name], "^[?#]$", "")
    return add_layers(
        df,
        layer(base=_tidy(page_url), link=_tidy(href)),
        layer(easy=F.when(rooted & (origin != ""), F.concat(origin, c("link")))),
        layer(**{n: F.when(hard, p) for n, p in parts.items()}),
        layer(parts=F.when(c("path").startswith("/"), own).otherwise(beside)),
        layer(parts=F.when(c("path").startswith("/"), c("parts")).otherwise(merged)),
        layer(kept=kept),
        {out: F.coalesce(c("easy"), address)},
    )


def _quote(text: Column) -> Column:
    """Form encoding with '~' left alone and '*' encoded."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _unquote(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))


def with_page_number(url: Column, page: Column) -> Column:
    """The address with its `page` parameter set; a repeated name keeps its last value."""
    scheme, query = F.lower(_part(url, 1)), F.regexp_replace(_part(url, 4), r"^\?", "")
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda kv: kv != ""),
        lambda kv: F.struct(
            _unquote(F.substring_index(kv, "=", 1)).alias("name"),
            _unquote(
                F.when(kv.contains("="), F.regexp_replace(kv, "^[^=]*=", "")).otherwise("")
            ).alias("value"),
        ),
    )
    named = F.array_append(
        pairs, F.struct(F.lit("page").alias("name"), page.cast("string").alias("value"))
    )
    names = F.array_distinct(F.transform(named, lambda kv: kv["name"]))
    encoded = F.transform(
        names,
        lambda name: F.concat(
            _quote(name),
            F.lit("="),
            _quote(F.element_at(F.filter(named, lambda kv: kv["name"] == name), -1)["value"]),
        ),
    )
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        _part(url, 2),
        _part(url, 3),
        F.lit("?"),
        F.array_join(encoded, "&"),
        F.when(_part(url, 5) != "#", _part(url, 5)).otherwise(""),
    )


def listing_id(url: Column) -> Column:
    """Stable id of a listing. A missing address is an error, never an empty id."""
    return F.when(
        empty_to_null(url).isNull(), F.raise_error(F.lit("a listing without url has no id"))
    ).otherwise(F.sha2(url, 256))
