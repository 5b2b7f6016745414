"""Text clean-up. Whitespace means every Unicode space, as the stored dumps need."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: every character that counts as a space, as a regex class (Java's \\s knows
# ASCII only and its Unicode mode is slower) and spelled out.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]))
SPACES += "\u2028\u2029\u202f\u205f\u3000"

# The peso sign and its mis-decoded form.
PESO = "₱"
BROKEN_PESO = "â‚±"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def blank_to_null(text: Column) -> Column:
    """NULL for text without any visible character, else the text unchanged."""
    return F.when(strip(text) != "", text)


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_filled(*texts: Column) -> Column:
    """First candidate that is neither NULL nor the empty string."""
    return F.coalesce(*[empty_to_null(t) for t in texts])


def clean_text(text: Column) -> Column:
    repaired = F.replace(strip(text), F.lit(BROKEN_PESO), F.lit(PESO))
    return squeeze(repaired)


def normalize_text(text: Column) -> Column:
    """One space between words, none at the ends, NULL when nothing is left."""
    return empty_to_null(strip(squeeze(text)))


def strip_text(text: Column) -> Column:
    """No-break spaces become spaces, the ends are stripped, NULL becomes ''."""
    return strip(F.replace(F.coalesce(text, F.lit("")), F.lit("\xa0"), F.lit(" ")))


def captured(text: Column, pattern: str, group: int) -> Column:
    """A regex group, NULL where the pattern or the group did not match."""
    return empty_to_null(F.regexp_extract(text, pattern, group))


def squeeze(text: Column) -> Column:
    """Every run of spaces becomes one space."""
    return F.regexp_replace(text, f"{SPACE}+", " ")


def first_integer(text: Column) -> Column:
    return empty_to_null(F.regexp_extract(text, r"[0-9]+", 0)).try_cast("bigint")


def to_number(text: Column) -> Column:
    """Lenient number: bad text and NaN are NULL.

    Text of another shape is not cast at all: a failing cast costs an exception per row.
    """
    shaped = text.rlike(r"(?i)^\s*[-+]?(?:\.?[0-9]|inf)")
    return F.when(shaped, text.try_cast("double"))


def to_count(text: Column) -> Column:
    """Lenient nullable integer; a number with a fraction is not a count."""
    number = to_number(text)
    return F.when(number == F.floor(number), number).try_cast("int")


def city_of(address: Column, pattern: str | None = None) -> Column:
    """First city name found in the address, else 'Unknown'."""
    return F.coalesce(captured(address, pattern or CITY_PATTERN, 1), F.lit("Unknown"))


# Fixed value: the city names looked for in an address.
CITY_PATTERN = r"(Cebu(?:\s+City)?|Mandaue|Lapu[- ]?Lapu)"
