"""Dates: relative texts, absolute texts, ISO forms. No clock is read anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plotwise.functions import add_layers
from plotwise.functions.text import SPACE, empty_to_null, squeeze, strip

# The order of units in a relative date, each with its length in seconds.
UNITS = (
    ("year", 365 * 86400),
    ("month", 30 * 86400),
    ("week", 7 * 86400),
    ("day", 86400),
    ("hour", 3600),
    ("minute", 60),
)
AGO = "(?i)(?=[0-9 ,a])" + "".join(rf"(?:([0-9]+) ?{unit}s?)? ?,? ?" for unit, _ in UNITS[:-1]) + (
    r"(?:([0-9]+) ?minutes?)? ?ago"
)  # on squeezed text; the look-ahead spares the places where none can begin
DATE_TOKEN = rf"([0-9]{{1,2}}{SPACE}+[A-Za-z]{{3,}}{SPACE}+[0-9]{{4}})"

# Free-form dates, on lower-case text without weekday and time. Month names, then the
# shapes, each with its groups as year|month|day.
MONTHS = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
_MON, _DAY, _GAP, _YEAR = rf"({MONTHS})\.?", r"([0-9]{1,2})(?:st|nd|rd|th)?", r"[ ./,-]", r"'?([0-9]{4}|[0-9]{2})"
SHAPES = (
    (rf"^{_DAY}(?: of)?{_GAP}*{_MON}(?:{_GAP}*{_YEAR})?$", "$3|$2|$1"),
    (rf"^{_MON}{_GAP}*{_DAY}(?:{_GAP}+{_YEAR})?$", "$3|$1|$2"),
    (rf"^{_MON}{_GAP}*([0-9]{{4}})$", "$2|$1|"),
    (rf"^([0-9]{{4}}){_GAP}*{_MON}{_GAP}*{_DAY}$", "$1|$2|$3"),
    (r"^([0-9]{4})[-/. ]([0-9]{1,2})[-/. ]([0-9]{1,2})$", "$1|$2|$3"),
    (r"^([0-9]{1,2})[-/. ]([0-9]{1,2})[-/. ]([0-9]{4}|[0-9]{2})$", "$3|$1|$2"),
    (r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1|$2|$3"),
)
WEEKDAY = r"\b(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\b\.?,? ?"
CLOCK = r"(?<![0-9:.])([0-9]{1,2})(?::([0-9]{2})(?::([0-9]{2}(?:[.,][0-9]+)?))?(?: ?([ap])\.?m\b\.?)?| ?([ap])\.?m\b\.?)"
ZONE = r"(?: ?(?:z|gmt|utc))?(?: ?([+-])([0-9]{2}):?([0-9]{2})?)?"
DAY_FORMAT = "d [MMMM][MMM] yyyy"


def parse_timestamp(text: Column) -> Column:
    """ISO-shaped text to a timestamp, each value on its own; NULL when unreadable.

    A bare time is no date: Spark would add the day from its clock.
    """
    return F.when(text.rlike(r"^\s*[+-]?[0-9]{4,}(?:-|\s*$)"), F.try_to_timestamp(text))


def _plain(text: Column) -> Column:
    """Lower case, one space, no weekday, a time's T as a space."""
    lower = F.lower(strip(squeeze(text)))
    return strip(F.regexp_replace(F.regexp_replace(lower, WEEKDAY, ""), r"(?<=[0-9])t(?=[0-9]{1,2}:)", " "))


AT_CLOCK = rf",? ?(?:at )?{CLOCK}{ZONE}$"


def looks_dated(text: Column) -> Column:
    """Would with_absolute read a full date here, going by the shape?"""
    day = strip(F.regexp_replace(_plain(text), AT_CLOCK, ""))
    any_shape = "|".join(shape for shape, _ in SHAPES)
    return parse_timestamp(strip(text)).isNotNull() | F.coalesce(day.rlike(any_shape), F.lit(False))


def _full_year(digits: Column, as_of: Column | None) -> Column:
    """Two digits mean the year nearest to as_of; without one 1969 to 2068."""
    year = digits.try_cast("int")
    now = F.year(as_of) if as_of is not None else F.lit(2019)
    near = now - F.pmod(now, F.lit(100)) + year
    near = F.when(near >= now + 50, near - 100).when(near < now - 50, near + 100).otherwise(near)
    return F.when(F.length(digits) == 2, near).otherwise(year)


def with_absolute(df: DataFrame, out: str, text: Column, as_of: Column | None = None) -> DataFrame:
    """ISO text or a free-form date; a naive value is UTC, an unreadable one NULL.

    Read are a day, a month name or number and a year in the usual orders, with a time of
    12 or 24 hours and an offset. Numbers alone are month first; day first when the first
    exceeds 12. A year, day or date left out is that of as_of; without it such a text is
    unreadable.
    """
    names = ("iso", "plain", "clock", "day", "ymd", "hms", "y", "m", "d", "h", "offset")
    c, name = {n: F.col(f"__{out}_{n}") for n in names}, {n: f"__{out}_{n}" for n in names}
    now = as_of if as_of is not None else F.lit(None).cast("timestamp")
    ordered = F.lit(None).cast("string")
    for shape, groups in reversed(SHAPES):
        ordered = F.when(c["day"].rlike(shape), F.regexp_replace(c["day"], shape, groups)).otherwise(ordered)
    ordered = F.when((c["day"] == "") & c["clock"].isNotNull(), "||").otherwise(ordered)

    def part(of: str, n: int) -> Column:
        return empty_to_null(F.get(c[of], F.lit(n)))

    number = part("ymd", 1).try_cast("int")
    place = F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.substring(part("ymd", 1), 1, 3))
    month = F.coalesce(number, F.floor((F.nullif(place, F.lit(0)) + 2) / 3).cast("int"))
    day = part("ymd", 2).try_cast("int")
    day_first = (number > 12) & (day <= 12)
    year = F.coalesce(_full_year(part("ymd", 0), as_of), F.when(part("ymd", 1).isNotNull(), F.year(now)))
    bare = c["ymd"].isNotNull() & part("ymd", 1).isNull()  # a time alone
    hour, half = part("hms", 0).try_cast("int"), part("hms", 3)
    hour = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    ahead = F.coalesce(part("hms", 5).try_cast("int"), F.lit(0)) * 60 + F.coalesce(part("hms", 6).try_cast("int"), F.lit(0))
    seconds = F.replace(F.coalesce(part("hms", 2), F.lit("0")), F.lit(","), F.lit(".")).try_cast("decimal(16,6)")
    # only of a month that is known: a format is written, and a cast fails, for NULLs too
    first = F.when(c["y"].isNotNull() & c["m"].isNotNull(), F.format_string("%04d-%02d-01", c["y"], c["m"]))
    last = F.day(F.last_day(F.try_to_date(first)))
    made = F.try_make_timestamp(
        c["y"],
        c["m"],
        F.coalesce(c["d"], F.when(now.isNotNull(), F.least(F.day(now), last))),
        F.coalesce(c["h"], F.lit(0)),
        F.coalesce(part("hms", 1).try_cast("int"), F.lit(0)),
        seconds,
    )
    shifted = F.timestamp_micros(F.unix_micros(made) - c["offset"].cast("bigint") * 60_000_000)
    sound = c["ymd"].isNotNull() & (c["clock"].isNull() | c["h"].isNotNull())
    return add_layers(
        df,
        {name["iso"]: parse_timestamp(strip(text))},
        {name["plain"]: F.when(c["iso"].isNull(), _plain(text))},
        {name["clock"]: empty_to_null(F.regexp_extract(c["plain"], AT_CLOCK, 0))},
        {name["day"]: strip(F.when(c["clock"].isNotNull(), F.regexp_replace(c["plain"], AT_CLOCK, "")).otherwise(c["plain"]))},
        {
            name["ymd"]: F.split(ordered, r"\|", -1),
            name["hms"]: F.split(F.regexp_replace(c["clock"], AT_CLOCK, "$1|$2|$3|$4$5|$6|$7|$8"), r"\|", -1),
        },
        {
            name["y"]: F.when(bare, F.year(now)).otherwise(year),
            name["m"]: F.when(bare, F.month(now)).otherwise(F.when(day_first, day).otherwise(month)),
            name["d"]: F.when(bare, F.day(now)).otherwise(F.when(day_first, number).otherwise(day)),
            name["h"]: hour,
            name["offset"]: F.when(part("hms", 4) == "-", -ahead).otherwise(ahead),
        },
        {out: F.coalesce(c["iso"], F.when(sound, shifted))},
    )


def _age_seconds(run: Column) -> Column:
    """Seconds of a matched lower-case run such as '1 day, 6 hours ago'."""
    total = F.lit(0.0)
    for unit, seconds in UNITS:
        digits = F.when(run.contains(unit), F.regexp_extract(run, rf"([0-9]+) ?{unit}", 1))
        total = total + F.coalesce(empty_to_null(digits).try_cast("double"), F.lit(0.0)) * seconds
    return total


def _before(as_of: Column, seconds: Column) -> Column:
    """NULL when the age is out of range."""
    micros = (seconds * 1_000_000.0).try_cast("bigint")
    return F.timestamp_micros(F.try_subtract(F.unix_micros(as_of), micros))


def with_relative(df: DataFrame, out: str, text: Column, as_of: Column) -> DataFrame:
    """'2 months ago' counted back from as_of; NULL unless a unit is given."""
    run = F.col(f"__{out}_run")
    return add_layers(
        df,
        {f"__{out}_run": F.lower(F.regexp_extract(squeeze(text), AGO, 0))},
        {out: F.when(run.rlike("[0-9]"), _before(as_of, _age_seconds(run)))},
    )


def with_published(df: DataFrame, out: str, text: Column, as_of: Column) -> DataFrame:
    """Relative text first (a bare 'ago' means now), else an absolute date."""
    run, absolute = F.col(f"__{out}_run"), f"__{out}_abs"
    df = df.withColumn(f"__{out}_run", F.lower(F.regexp_extract(squeeze(text), AGO, 0)))
    df = with_absolute(df, absolute, F.when(run == "", text), as_of)
    age = F.when(run != "", _before(as_of, _age_seconds(run)))
    return df.withColumn(out, F.coalesce(age, F.col(absolute))).drop(f"__{out}_run", absolute)


def token_timestamp(text: Column, source_tz: str) -> Column:
    """The first 'd Month yyyy' inside a text, read in the source's own zone."""
    token = F.regexp_replace(squeeze(F.regexp_extract(text, DATE_TOKEN, 1)), r"(?i)\bsept\b", "Sep")
    day = F.when(token != "", F.try_to_timestamp(token, F.lit(DAY_FORMAT)))
    return F.to_utc_timestamp(day, source_tz)


OFFSET = r"(?:Z|GMT|UTC|:[0-9.]+ ?[+-][0-9]{2}:?(?:[0-9]{2})?)\s*$"


def with_zoned(df: DataFrame, out: str, text: Column, source_tz: str) -> DataFrame:
    """Absolute text; a value without an offset is read in the source's own zone."""
    parsed = f"__{out}_utc"
    df = with_absolute(df, parsed, text)
    zoned = F.when(text.rlike(OFFSET), F.col(parsed)).otherwise(
        F.to_utc_timestamp(parsed, source_tz)
    )
    return df.withColumn(out, zoned).drop(parsed)


def iso_utc(ts: Column) -> Column:
    """Timestamp as ISO text with offset, microseconds always written."""
    return F.date_format(F.to_timestamp(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def with_written_date(df: DataFrame, out: str, text: Column, run_date: Column | None = None) -> DataFrame:
    """The day as written in a timestamp text, not shifted to UTC."""
    parsed = f"__{out}_abs"
    day = F.substring(strip(text), 1, 10).try_cast("date")
    df = with_absolute(df, parsed, F.when(day.isNull(), text))
    days = [day, F.col(parsed).cast("date")] + ([run_date] if run_date is not None else [])
    return df.withColumn(out, F.coalesce(*days)).drop(parsed)
