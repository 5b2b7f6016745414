"""One vectorised function from captured HTML to tokens.

A page is tokenised once, in the Arrow batch Spark hands over: its elements as intervals,
its texts and its JSON-LD blocks. Which elements a selector means and what a JSON-LD tree
holds is decided by joins and column expressions on these (operators/selectors.py,
operators/jsonld.py).
"""

from __future__ import annotations

import json
import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

import plotwise

# Python workers get these helpers with the function itself: nothing has to be installed
# on the executors, and the driver's working folder does not matter.
cloudpickle.register_pickle_by_value(plotwise)

# An element holds the elements numbered from its start to its end, itself first, and the
# texts from text_from up to text_to; nth and last are its place among its siblings.
_TEXTS = T.ArrayType(T.StringType())
ELEMENT = (
    T.StructType()
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("parent", T.IntegerType())
    .add("nth", T.IntegerType())
    .add("last", T.BooleanType())
    .add("tag", T.StringType())
    .add("attrs", T.MapType(T.StringType(), T.StringType()))
    .add("text_from", T.IntegerType())
    .add("text_to", T.IntegerType())
)
TOKENS_TYPE = (
    T.StructType()
    .add("elements", T.ArrayType(ELEMENT))
    .add("texts", _TEXTS)
    .add("blocks", _TEXTS)
    .add("error", T.StringType())
    .add("detail", T.StringType())
)
_ARROW_TYPE = to_arrow_type(TOKENS_TYPE)
SLICE_BYTES = 1 << 20  # HTML whose elements are held as Python objects at a time; one page at least
ORDER = "plotwise:order"  # a member naming an object's nested members in document order

# Fixed values of HTML: elements without an end tag, elements whose text is not page
# text, and the start tags that end an open element of the same list of names.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(("script", "style", "template"))
BLOCK = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header "
    "hr main nav ol p pre section table ul".split()
)
ENDS = {
    "p": BLOCK,
    "li": frozenset(("li",)),
    "a": frozenset(("a", "fieldset", "table", "td", "th")),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "option": frozenset(("option", "optgroup")),
    "tr": frozenset(("tr",)),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
    "head": frozenset(("body",)),
}
ENDS |= {name: frozenset(("p",)) for name in "b big i s small strike tt u".split()}
ENDS |= {f"h{n}": frozenset(("p", "table", "form", "fieldset")) for n in range(1, 7)}


class _PageReader(HTMLParser):
    """Elements of a page as rows, its texts and ld+json scripts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements, self.path, self.children = [], [], [None]
        self.texts, self.buffer, self.scripts = [], [], []

    def flush(self):
        text = "".join(self.buffer)
        self.buffer = []
        inner = self.path[-1] if self.path else {"tag": "", "attrs": []}
        if inner["tag"] in HIDDEN:
            if inner["tag"] == "script" and ("type", "application/ld+json") in inner["attrs"]:
                self.scripts.append(text)
        elif text.strip():
            self.texts.append(text.strip())

    def end_children(self):
        last = self.children.pop()
        if last is not None:
            last["last"] = True

    def handle_starttag(self, tag, attributes):
        self.flush()
        while self.path and tag in ENDS.get(self.path[-1]["tag"], ()):
            self.end(len(self.path) - 1)
        before = self.children[-1]
        element = {
            "start": len(self.elements) + 1,
            "end": len(self.elements) + 1,
            "parent": self.path[-1]["start"] if self.path else 0,
            "nth": before["nth"] + 1 if before else 1,
            "last": False,
            "tag": tag,
            "attrs": list(dict(reversed(attributes)).items()),
            "text_from": len(self.texts),
            "text_to": len(self.texts),
        }
        self.elements.append(element)
        self.children[-1] = element
        if tag not in VOID:
            self.path.append(element)
            self.children.append(None)

    def handle_endtag(self, tag):
        self.flush()
        for depth in range(len(self.path) - 1, -1, -1):
            if self.path[depth]["tag"] == tag:
                self.end(depth)
                break

    def end(self, depth):
        """Close the open elements from a depth on."""
        while len(self.path) > depth:
            element = self.path.pop()
            element["end"], element["text_to"] = len(self.elements), len(self.texts)
            self.end_children()

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_comment(self, data):
        self.flush()

    def finish(self):
        self.close()
        self.flush()
        self.end(0)
        self.end_children()


_LONE = re.compile("[\ud800-\udfff]")  # half of a pair: a text cut inside an emoji


def _sound(text: str) -> str:
    return _LONE.sub("�", text)


def _finite(text: str):
    value = float(text)
    return value if math.isfinite(value) else None


def _ordered(members: list) -> dict:
    """A JSON object whose nested members are named in document order where it matters."""
    made = dict(members)
    nested = [k for k, v in made.items() if isinstance(v, (dict, list))]
    return made | {ORDER: nested} if len(nested) > 1 else made


def _loads(text: str):
    """JSON as the web has it: NaN and infinities are read, as null."""
    return json.loads(text, parse_constant=lambda _: None, parse_float=_finite, object_pairs_hook=_ordered)


def parse_blocks(scripts) -> list[str]:
    """Strict JSON of each script; glued objects are split, a bad piece ends its script."""
    blocks = []
    for script in scripts:
        text = (script or "").strip()
        try:
            pieces = [_loads(text)] if text else []
        except (ValueError, RecursionError):
            pieces = []
            for piece in re.split(r"(?<=\})\n(?=\{)|\n\n", text):
                try:
                    pieces.append(_loads(piece))
                except (ValueError, RecursionError):
                    break
        for piece in pieces:
            try:
                blocks.append(_sound(json.dumps(piece, ensure_ascii=False)))
            except RecursionError:
                break
    return blocks


def _as_arrow(rows: list[dict], kind: pa.DataType, failed) -> pa.Array:
    """Rows as an Arrow array; if one cannot be converted, that one alone is replaced."""
    try:
        return pa.array(rows, type=kind)
    except Exception:
        sound = []
        for row in rows:
            try:
                pa.array([row], type=kind)
                sound.append(row)
            except Exception as problem:
                sound.append(failed(problem))
        return pa.array(sound, type=kind)


def _failure(problem: Exception) -> dict:
    return {"elements": [], "texts": [], "blocks": [], "error": type(problem).__name__, "detail": _sound(str(problem))}


def tokens_of(html: str | None) -> dict:
    """The tokens of a page. An error is data, never a failed task."""
    try:
        reader = _PageReader()
        reader.feed(html or "")
        reader.finish()
        return {"elements": reader.elements, "texts": reader.texts, "blocks": parse_blocks(reader.scripts)}
    except Exception as problem:  # reported in the failure table
        return _failure(problem)


def _in_slices(pages: pa.Array, read, kind: pa.DataType, failed) -> pa.Array:
    """read() of each page as an Arrow array. Python objects are held for a slice of the batch at a time.

    A slice ends with the page that fills it: what a task holds does not grow with its batches.
    """
    sizes = pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    slot = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(pages)]
    made = [_as_arrow([read(p) for p in pages[a:b].to_pylist()], kind, failed) for a, b in zip(cuts, cuts[1:])]
    return made[0] if len(made) == 1 else pa.concat_arrays(made)


def _once(udf):
    """Mark a function as not to be repeated.

    Spark copies a deterministic function into every filter it derives or pushes down;
    each copy would read all pages again.
    """
    return udf.asNondeterministic()


def tokenise(html: str):
    """A column of TOKENS_TYPE from a column of HTML."""

    @F.arrow_udf(TOKENS_TYPE)
    def read(batch: pa.Array) -> pa.Array:
        return _in_slices(batch, tokens_of, _ARROW_TYPE, _failure)

    return _once(read)(html)


def strict_blocks(scripts: str):
    """JSON texts of the ld+json script texts of a page that was tokenised elsewhere."""

    @F.arrow_udf(_TEXTS)
    def read(batch: pa.Array) -> pa.Array:
        return _as_arrow([parse_blocks(s or []) for s in batch.to_pylist()], pa.list_(pa.string()), lambda _: [])

    return _once(read)(scripts)
