"""The library's functions for SQL text: CREATE TEMPORARY FUNCTION for rules, a table function for pages.

    register(spark)
    spark.sql("SELECT canonical_url(url) FROM pages")
    spark.sql("SELECT key, tag, text FROM page_elements(TABLE(SELECT page_id, html FROM pages))")
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

import plotwise
from plotwise.functions import text, urls
from plotwise.functions.html import ELEMENT, tokens_of

# Python workers get the table function's module with it.
cloudpickle.register_pickle_by_value(plotwise)

# name: arguments, result, the rule as a column of the arguments
FUNCTIONS: dict[str, tuple[dict[str, str], str, Callable[..., Column]]] = {
    "canonical_url": ({"url": "STRING"}, "STRING", urls.canonical_url),
    # no error for a missing url here, but NULL
    "listing_id": ({"url": "STRING"}, "STRING", lambda url: F.sha2(text.empty_to_null(url), 256)),
    "clean_text": ({"t": "STRING"}, "STRING", text.clean_text),
    "normalize_text": ({"t": "STRING"}, "STRING", text.normalize_text),
    "first_integer": ({"t": "STRING"}, "INT", text.first_integer),
    "lenient_number": ({"t": "STRING"}, "DOUBLE", text.to_number),
}


def _sql(spark: SparkSession, arguments: dict[str, str], rule: Callable[..., Column]) -> str:
    """The rule as SQL text, as the analyser writes it."""
    kinds = ", ".join(f"{name} {kind}" for name, kind in arguments.items())
    made = spark.createDataFrame([], kinds).select(rule(*[F.col(a) for a in arguments]).alias("out"))
    expression = made._jdf.queryExecution().analyzed().expressions().head()
    return expression.child().sql()


def register(spark: SparkSession) -> list[str]:
    """Register the functions in the session's catalog; returns their names.

    The rules become SQL expressions: a query that calls them is planned as if it had been
    written out, with no Python in it. `page_elements(TABLE(...))` gives a row per element.
    """
    for name, (arguments, result, rule) in FUNCTIONS.items():
        declared = ", ".join(f"{a} {kind}" for a, kind in arguments.items())
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({declared}) RETURNS {result} RETURN {_sql(spark, arguments, rule)}")
    spark.udtf.register("page_elements", _page_elements())
    return [*FUNCTIONS, "page_elements"]


def _page_elements():
    key = T.StructField("key", T.StringType())
    kind = T.StructType([key, *ELEMENT.fields, T.StructField("text", T.StringType())])
    schema = to_arrow_schema(kind)

    class PageElements:
        """The elements of pages as intervals (see functions/html.py), with the first text each holds.

        The argument is a table of two columns: what names a page, and its HTML. A page that
        fails has no elements.
        """

        def eval(self, pages: pa.RecordBatch):
            keys = pages.column(0).cast(pa.string()).to_pylist()
            for key, page in zip(keys, pages.column(1).to_pylist()):
                read = tokens_of(page)
                # the first text alone: an element's whole text would be told again by all it lies in
                rows = [
                    e | {"key": key, "text": " ".join(read["texts"][e["text_from"] : e["text_to"]][:1])} for e in read["elements"]
                ]
                if rows:
                    yield pa.Table.from_pylist(rows, schema)

    return F.arrow_udtf(PageElements, returnType=kind)
