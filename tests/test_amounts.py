import pytest
from pyspark.sql import functions as F

from plotwise.functions import amounts


def stage(fn):
    return lambda v: lambda df: fn(df, "out", v)


def as_dicts(rows):
    return [r and {k: v for k, v in r.asDict().items() if v is not None} for r in rows]


def test_price_text(column):
    got = as_dicts(
        column(
            ["₱ 95,200 /month", "Php 95,200 / mo", "₱ 95,200.50 /month", "PHP1,000/ YR", "₱5/day", "call", "₱ ,", "", " ", None],
            stage(amounts.with_price_from_text),
        )
    )
    php = {"currency": "PHP"}
    assert got == [
        {"raw": "₱ 95,200 /month", "value": 95200.0, "period": "month", **php},
        {"raw": "Php 95,200 / mo", "value": 95200.0, "period": "month", **php},
        {"raw": "₱ 95,200.50 /month", "value": 95200.0, **php},
        {"raw": "PHP1,000/ YR", "value": 1000.0, "period": "year", **php},
        {"raw": "₱5/day", "value": 5.0, "period": "day", **php},
        {"raw": "call"},
        {"raw": "₱ ,", **php},
        None,
        {"raw": ""},
        None,
    ]


def test_area_text(column):
    values = ["184 sqm", "1,200 m²", "1,234.5 sq. m", "9 SQ m", "500 sq ft", "1.2.3 sqm", None]
    got = as_dicts(column(values, stage(amounts.with_area_from_text)))
    assert [g and g.get("sqm") for g in got] == [184.0, 1200.0, 1234.5, 9.0, None, None, None]


def test_price_page(column):
    values = ["₱ 95,200.50 / Month", "php call", "1,000", "", None]
    got = as_dicts(column(values, stage(amounts.with_price_from_page)))
    assert got == [
        {"raw": "₱ 95,200.50 / Month", "currency": "PHP", "value": 95200.5, "period": "month"},
        {"raw": "php call", "currency": "PHP"},
        {"raw": "1,000", "value": 1000.0},
        None,
        None,
    ]


def test_area_page(column):
    values = ["big 1,200 sqm or 3 m2", "12 SQM", "x 5.5.5 m²", "none", None]
    got = as_dicts(column(values, stage(amounts.with_area_from_page)))
    assert got == [{"raw": "1,200 sqm", "sqm": 1200.0}, {"raw": "12 SQM", "sqm": 12.0}, None, None, None]


def test_round_cents_follows_the_binary_value(column):
    feet = [5000, 15000, 25000, 35000, 45000, 1, 7, 123456, 999.5, 5000000]
    got = column([float(f) for f in feet], lambda v: amounts.round_cents(v.cast("double") * 0.092903), "double")
    assert got == [round(f * 0.092903, 2) for f in feet]


def variant(column, values, fn):
    """fn on each JSON text read as VARIANT."""
    return column(values, lambda v: lambda df: fn(df.withColumn("x", F.parse_json("v"))))


JSON = [
    '{"value":10,"currency":"USD"}', '"{\\"value\\":\\"1200\\",\\"currency\\":\\"PHP\\"}"', '"₱ 123,456"',
    '{"value":"12"}', '{"value":true}', "null", "12", "[1]", '"{bad}"', '{"value":"x"}',
]


def test_price_value(column):
    def fn(df):
        df = amounts.with_objects(df, json_text=True, x=F.col("x"))
        return df.withColumn("out", amounts.price_value(F.col("_x")))

    assert variant(column, JSON, fn) == [10.0, 1200.0, None, 12.0, 1.0, None, None, None, None, None]


def test_flat_takes_objects_only(column):
    def fn(df):
        return amounts.with_objects(df, x=F.col("x")).withColumn("out", amounts.price_currency(F.col("_x")))

    assert variant(column, JSON, fn)[:3] == ["USD", None, None]


def test_area_sqm(column):
    def fn(df):
        df = amounts.with_objects(df, json_text=True, x=F.col("x"))
        return amounts.with_area_sqm(df, "out", F.col("_x"), F.col("_x_text"))

    values = [
        '{"sqm":0}', '{"sqm":"184"}', '"184 sqm"', '"1,200 m²"', '"1,234,567 sqm"', '"12,5 sqm"', '"500 sq ft"',
        '"5000 square feet"', '"{\\"raw\\":\\"184 sqm\\"}"', '"{\\"sqm\\":7}"', '"no"', "5", "null",
    ]
    assert variant(column, values, fn) == [
        0.0, 184.0, 184.0, 1200.0, 234567.0, 125.0, 46.45, 464.51, None, 7.0, None, None, None,
    ]


def test_publish_price(column):
    def fn(df):
        df = amounts.with_objects(df, json_text=True, x=F.col("x"))
        given = F.when(F.col("i") == 5, 77.0)
        return df.withColumn("out", amounts.publish_price(F.col("_x"), F.col("_x_text"), given))

    values = [
        '{"value":10,"currency":"php"}', '{"value":10}', '{"value":10,"currency":"USD"}', '{"value":"10"}',
        '"₱ 123,456"', '{"value":10,"currency":"USD"}', '"{\\"value\\":9,\\"currency\\":\\"USD\\"}"',
        '"{\\"value\\":9}"', '"call"', '"1.2.3"', "null", '{"value":true}',
    ]
    assert variant(column, values, fn) == [10.0, 10.0, None, None, 123456.0, 77.0, None, 9.0, None, None, None, 1.0]


def test_publish_area(column):
    def fn(df):
        df = amounts.with_objects(df, json_text=True, x=F.col("x"))
        given = F.when(F.col("i") == 3, "41").when(F.col("i") == 4, "bad")
        return df.withColumn("out", amounts.publish_area(F.col("_x"), given, F.lit("about 55 m2")))

    values = ['{"sqm":5}', '{"sqm":"bad"}', '{"sqm":null}', "{}", "{}", '"30 sqm"', "null"]
    assert variant(column, values, fn) == [5.0, None, 55.0, 41.0, None, 55.0, 55.0]


def test_jsonish(column):
    def fn(df):
        return df.withColumn("out", F.to_json(amounts.jsonish(F.col("x"))))

    values = ['{"a":1}', '" {\\"a\\":1} "', '"[1]"', '"{bad}"', '"x"', "5"]
    assert variant(column, values, fn) == ['{"a":1}', '{"a":1}', "[1]", None, None, None]


@pytest.mark.parametrize(
    "rule, want",
    [
        ("any", [1.0] * 6),
        ("strict", [1.0, None, 1.0, None, None, None]),
        ("lenient", [1.0, 1.0, 1.0, 1.0, 1.0, None]),
    ],
)
def test_currency_rules(column, rule, want):
    got = column([None, "", "PHP", "php", "₱", "USD"], lambda v: amounts.peso_price(F.lit(1.0), v, rule))
    assert got == want


def test_unknown_rule():
    with pytest.raises(ValueError):
        amounts.peso_price(None, None, "x")


def test_per_sqm(column):
    got = column([2.0, 0.0, -1.0, None], lambda v: amounts.per_sqm(F.lit(10.0), v), "double")
    assert got == [5.0, None, None, None]
