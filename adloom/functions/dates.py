"""Date expressions (DAT-*). All return ``DateType``; nothing reads the wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.text import ascii_digits, contains_any, strip

ISO = "yyyy-MM-dd"


def _date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.try_to_date(text, ISO)


def iso_date(c: Column) -> Column:
    """DAT-1: date from an ISO prefix."""
    return F.try_to_date(F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})", 1), ISO)


def month_name_date(c: Column) -> Column:
    """DAT-2: ``month day, year`` with an Arabic or English month name (substring match)."""
    month = F.coalesce(
        *[F.when(c.contains(name), F.lit(str(number))) for name, number in V.MONTH_NAMES.items()]
    )
    pattern = r"(?U)(\d{1,2})[,،]?\s*(\d{4})"
    day, year = F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 2)
    return _date(ascii_digits(year), month, ascii_digits(day))


def compact_date(c: Column) -> Column:
    """DAT-3: first eight digits of ``YYYYMMDD...``."""
    return F.try_to_date(F.regexp_extract(c, r"^(\d{8})", 1), "yyyyMMdd")


def day_first_date(c: Column) -> Column:
    """DAT-4: first ``DD-MM-YYYY`` in a text."""
    return F.try_to_date(F.regexp_extract(c, r"(\d{2}-\d{2}-\d{4})", 1), "dd-MM-yyyy")


def date_argument(c: Column) -> Column:
    """DAT-4: a date given either as ISO or day first."""
    text = strip(c)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, ISO))
    return F.coalesce(iso, F.when(text.rlike(r"^\d{2}-\d{2}-\d{4}$"), day_first_date(text)))


def relative_date(
    english: Column, arabic: Column, as_of: Column, blank_is_today: bool = True
) -> Column:
    """DAT-5: ``4 days ago`` / ``منذ 4 أيام`` counted back from ``as_of``."""
    english = F.when(english != "", english)
    text = F.lower(strip(F.coalesce(english, arabic, F.lit(""))))

    def back(source: Column, units: dict[str, int]) -> Column:
        pattern = r"(?U)(\d+)\s*(" + "|".join(units) + ")"
        count = ascii_digits(F.regexp_extract(source, pattern, 1)).try_cast("int")
        unit = F.regexp_extract(source, pattern, 2)
        days = F.try_element_at(
            F.create_map(*[F.lit(x) for pair in units.items() for x in pair]), unit
        )
        return F.date_sub(as_of, count * days)

    today = contains_any(text, V.NOW_WORDS)
    if blank_is_today:
        today = today | (text == "")
    return F.when(today, as_of).otherwise(
        F.coalesce(
            back(text, V.UNIT_DAYS_EN), back(strip(F.coalesce(arabic, F.lit(""))), V.UNIT_DAYS_AR)
        )
    )


def first_date(*candidates: Column) -> Column:
    """DAT-6: cascade of date sources (page meta, time element, embedded JSON, card)."""
    return F.coalesce(*candidates)
