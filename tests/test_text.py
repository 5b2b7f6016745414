import datetime as dt

import pytest
from pyspark.sql import functions as F

from plotwise.functions import dates, text

AS_OF = dt.datetime(2024, 1, 31)


def test_clean_and_normalize(column):
    values = [" a  b\n c ", "â‚± 5", "", " ", None]
    assert column(values, text.clean_text) == ["a b c", "₱ 5", "", "", None]
    assert column(values, text.normalize_text) == ["a b c", "â‚± 5", None, None, None]


def test_spaces_are_the_ones_python_strips(column):
    every = [chr(c) for c in range(1, 0x3100) if chr(c).isspace()]
    assert column([f"{c}x{c}y{c}" for c in every], text.clean_text) == ["x y"] * len(every)
    kept = ["​", "⁠", "᠎"]  # look like spaces, are none
    assert column(kept, text.clean_text) == kept


def test_blank(column):
    assert column([" ", " ", "0", " a ", None], text.blank_to_null) == [None, None, "0", " a ", None]


def test_numbers(column):
    values = ["12", " 1.5 ", "-3e2", "nan", "two", "", "1,2", None, "inf"]
    assert column(values, text.to_number) == [12.0, 1.5, -300.0, None, None, None, None, None, float("inf")]
    assert column(["2", "2.0", "1.5", "x", None], text.to_count) == [2, 2, None, None, None]
    assert column(["a12b3", "none", "", None], text.first_integer) == [12, None, None, None]


def test_city(column):
    values = ["Lahug, Cebu City", "Cebu", "x Mandaue y", "Lapu-Lapu", "LapuLapu, Cebu", "cebu", None]
    assert column(values, text.city_of) == [
        "Cebu City", "Cebu", "Mandaue", "Lapu-Lapu", "LapuLapu", "Unknown", "Unknown",
    ]


def ago(**parts):
    return AS_OF - dt.timedelta(**parts)


RELATIVE = {
    "2 months ago": ago(days=60),
    "1 year, 2 weeks, 3 minutes ago": ago(days=379, minutes=3),
    "1 day, 6 hours ago": ago(days=1, hours=6),
    "1 day and 6 hours ago": ago(hours=6),
    "2 days, 1 month ago": ago(days=30),
    "Posted 3 WEEKS  AGO": ago(weeks=3),
    "99999999999999999999 years ago": None,
}


def test_relative(column):
    def fn(v):
        return lambda df: dates.with_relative(df, "out", v, F.lit(AS_OF))

    assert column(RELATIVE, fn) == list(RELATIVE.values())
    assert column(["ago", "12 Sep 2023", None], fn) == [None, None, None]


def test_published(column):
    def fn(v):
        return lambda df: dates.with_published(df, "out", v, F.lit(AS_OF))

    assert column(["just ago", "5 days ago"], fn) == [AS_OF, ago(days=5)]
    day = dt.datetime(2023, 9, 5)
    shapes = [
        "5 Sep 2023", "5 Sept 2023", "5 September 2023", "Sep 5, 2023", "September 5, 2023", "Sep. 5 2023",
        "2023-09-05", "9/5/2023", "2023/9/5", "20230905", "Tue, 5 Sep 2023 00:00:00 +0000", " 5  Sep  2023 ",
        "2023-09-05T08:00:00+08:00",
    ]
    assert column(shapes, fn) == [day] * len(shapes)
    assert column(["", "soon", "5 Foo 2023", "31 Feb 2023", None], fn) == [None] * 5


def test_free_form_dates(column):
    def fn(v):
        return lambda df: dates.with_absolute(df, "out", v, F.lit(dt.datetime(2024, 3, 31, 9)))

    day = dt.datetime(2023, 9, 12)
    want = {
        "12-Sep-2023": day, "12th September 2023": day, "12 Sep 23": day, "2023.09.12": day, "09-12-2023": day,
        "12.09.2023": dt.datetime(2023, 12, 9), "25/12/2023": dt.datetime(2023, 12, 25), "13/13/2023": None,
        "Sep 2023": dt.datetime(2023, 9, 30), "September 12": dt.datetime(2024, 9, 12), "12 Sep": dt.datetime(2024, 9, 12),
        "Tue 12 Sep 2023 3:04 PM": dt.datetime(2023, 9, 12, 15, 4), "2023-09-12 3:04 PM": dt.datetime(2023, 9, 12, 15, 4),
        "Sep 12 2023 at 12am": day, "12 Sep 2023 10:00:30 +08:00": dt.datetime(2023, 9, 12, 2, 0, 30),
        "Tuesday, September 12th, 2023": day, "12 of Sept. '23": day, "2023 Sep 12": day, "20230912": day,
        "12:30": dt.datetime(2024, 3, 31, 12, 30), "Sep 12, 75": dt.datetime(1975, 9, 12), "12/31/74": dt.datetime(1974, 12, 31),
        "31 Feb 2023": None, "12 Sep 2023 25:00": None, "12 Sep 2023 13 pm": None, "maybe 2023": None, "12": None, "": None,
    }
    assert dict(zip(want, column(list(want), fn))) == want
    no_clock = column(["12:30", "Sep 2023", "September 12", "Sep 12 2023"], lambda v: lambda df: dates.with_absolute(df, "out", v))
    assert no_clock == [None, None, None, day]


def test_token_in_source_zone(column):
    got = column(
        ["Posted 12 Sep 2023 by x", "12 September 2023", "12 Sept 2023", "2023-09-12", "2 months ago", "45 May 2023"],
        lambda v: dates.token_timestamp(v, "Asia/Manila"),
    )
    assert got == [dt.datetime(2023, 9, 11, 16)] * 3 + [None] * 3


def test_zoned(column):
    def fn(v):
        return lambda df: dates.with_zoned(df, "out", v, "Asia/Manila")

    values = ["2024-01-02T03:00:00+00:00", "2024-01-02T03:00:00Z", "2024-01-02T11:00:00", "bad", None]
    assert column(values, fn) == [dt.datetime(2024, 1, 2, 3)] * 3 + [None, None]


def test_written_date(column):
    def fn(v):
        return lambda df: dates.with_written_date(df, "out", v)

    values = ["2024-01-02T23:00:00-08:00", "2024-01-02", "2 Jan 2024", "never", None]
    assert column(values, fn) == [dt.date(2024, 1, 2)] * 3 + [None, None]
    assert column([None], lambda v: lambda df: dates.with_written_date(df, "out", v, F.lit(dt.date(2024, 5, 1)))) == [
        dt.date(2024, 5, 1)
    ]


@pytest.mark.parametrize("value, want", [("2024-01-02 03:04:05.5", "2024-01-02T03:04:05.500000+00:00"), ("bad", None)])
def test_iso(column, value, want):
    assert column([value], lambda v: dates.iso_utc(dates.parse_timestamp(v))) == [want]
