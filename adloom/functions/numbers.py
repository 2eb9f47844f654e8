"""Numeric expressions (NUM-*, STR-3, CAN-5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.markup import once
from adloom.functions.text import WHITE_SPACE, YEAR_PATTERN, ascii_digits, blank_to_null, strip

# what ``(?U)\s`` is in a pattern: white space without the four separators
PATTERN_SPACE = WHITE_SPACE.translate(dict.fromkeys(range(0x1C, 0x20)))


def clean_number(c: Column) -> Column:
    """STR-3: first run of digits after dropping commas (``2.0`` gives ``2``)."""
    digits = F.regexp_extract(F.translate(c.cast("string"), ",", ""), r"(?U)(\d+)", 1)
    return blank_to_null(digits)


def clean_cylinders(c: Column) -> Column:
    """CAN-5: digits, else the text itself."""
    return F.coalesce(clean_number(c), blank_to_null(strip(c)))


def _digits_and_dots(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[^\d.]+", "")


def parse_price(c: Column) -> Column:
    """NUM-1: digits and dots as a double; anything else (``1.2.3``) is NULL. Expects text."""
    return ascii_digits(_digits_and_dots(c)).try_cast("double")


def _plain(value: Column) -> Column:
    """Double to text without an exponent: whole numbers without decimals."""
    whole = value.try_cast("decimal(38,0)").cast("string")
    # through text, as that holds the digits of the double and no others
    fixed = F.regexp_replace(value.cast("string").try_cast("decimal(38,16)").cast("string"), "0+$", "")
    part = F.when(value < 1e7, value.cast("string")).otherwise(fixed)
    return F.when(value == F.floor(value), whole).otherwise(part)


def price_digits(c: Column, keep_junk: bool = True) -> Column:
    """NUM-2: price as digits; unparseable text keeps its digits, or is NULL."""

    def plain(digits: Column) -> Column:
        junk = blank_to_null(digits) if keep_junk else F.lit(None).cast("string")
        return once(ascii_digits(digits).try_cast("double"), lambda value: F.when(value.isNull(), junk).otherwise(_plain(value)))

    return once(_digits_and_dots(c), plain)


def price_with_commas(c: Column) -> Column:
    """NUM-3: truncated price with thousands separators."""
    value = parse_price(c)
    return F.format_number(F.floor(value), 0)


def first_number(c: Column) -> Column:
    """NUM-4: first group of digits and commas as a double."""
    group = F.regexp_extract(c.cast("string"), r"(?U)([\d,]+)", 1)
    return ascii_digits(F.translate(group, ",", "")).try_cast("double")


def parse_year(c: Column) -> Column:
    """NUM-5: word-bounded year 1950-2029."""
    found = F.regexp_extract(c.cast("string"), YEAR_PATTERN, 1)
    return ascii_digits(found).try_cast("int")


def clean_year(c: Column) -> Column:
    """NUM-5: word-bounded year 1900-2099."""
    found = F.regexp_extract(c.cast("string"), r"(?U)\b(19\d{2}|20\d{2})\b", 1)
    return ascii_digits(found).try_cast("int")


def clean_mileage(c: Column, thousands: bool = True) -> Column:
    """NUM-6: drop separators and the unit; ``210 ألف`` is 210000 unless switched off."""

    def without_unit(text: Column) -> Column:
        led = once(F.rtrim(text, F.lit(PATTERN_SPACE)), lambda t: F.when(
            F.lower(F.substring(t, -2, 2)).isin("كم", "km"), F.substring(t, F.lit(1), F.length(t) - 2)
        ))
        return strip(F.coalesce(led, text))

    def scaled(text: Column) -> Column:
        count = F.regexp_extract(text, rf"(?U)^(\d+)\s*{V.THOUSAND}\s*$", 1)
        number = (ascii_digits(count).try_cast("bigint") * 1000).cast("string")
        return F.coalesce(F.when(text.contains(V.THOUSAND), number), blank_to_null(text))

    bare = once(F.translate(c, ",،٬", ""), without_unit)
    return once(bare, scaled) if thousands else once(bare, blank_to_null)


def extract_mileage(c: Column) -> Column:
    """NUM-7: the first number of a text with its unit, when it lies in 100..1 000 000."""
    pattern = r"(?iU)(\+?[\d,]+)\s*(كم|km|كيلو|كيلومتر)?"

    def written(number: Column) -> Column:
        unit = once(F.regexp_extract(c, pattern, 2), lambda u: F.when(u == "", F.lit(V.KM_UNIT)).otherwise(u))
        value = ascii_digits(F.translate(number, ",+", "")).try_cast("bigint")
        return once(value, lambda v: F.when(v.between(100, 1_000_000), F.concat_ws(" ", number, unit)))

    return once(F.regexp_extract(c, pattern, 1), written)
