"""Dates written as text, each form read by one anchored pattern. JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import squeeze

# English month abbreviations.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def month_number(name: Column) -> Column:
    """1 to 12 by the first three letters of an English month name, else null."""
    key = F.substring(F.lower(name), 1, 3)
    branch = F.when(key == MONTHS[0], 1)
    for i, m in enumerate(MONTHS[1:], 2):
        branch = branch.when(key == m, i)
    return branch


def calendar_date(y: Column, m: Column, d: Column) -> Column:
    """The date of three numbers, null where any is null or the day does not exist."""
    text = F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"), F.lit("-"), F.lpad(d.cast("string"), 2, "0"))
    return text.try_cast("date")


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


# Fixed patterns of whole cells: year first, day first in figures, eight digits, day and month name, month name and day.
YEAR_FIRST = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[t ]\d{1,2}:\d{2}.*)?$"
DAY_FIRST = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?:[t ]\d{1,2}:\d{2}.*)?$"
EIGHT = r"^(\d{4})(\d{2})(\d{2})$"
DAY_NAME = r"^(\d{1,2})(?:st|nd|rd|th)?[-/., ]*([a-z]{3,9})[-/., ]*(\d{4})$"
NAME_DAY = r"^([a-z]{3,9})[-/., ]*(\d{1,2})(?:st|nd|rd|th)?[-/., ]+(\d{4})$"


def parse_date_cell(c: Column) -> Column:
    """The DATE that a whole cell writes, day before month; null if it is no date or none that exists."""
    s = F.lower(squeeze(c))
    forms = {
        YEAR_FIRST: lambda p: calendar_date(p(1), p(2), p(3)), DAY_FIRST: lambda p: calendar_date(p(3), p(2), p(1)), EIGHT: lambda p: calendar_date(p(1), p(2), p(3)),
        DAY_NAME: lambda p: calendar_date(p(3), month_number(p(2)), p(1)), NAME_DAY: lambda p: calendar_date(p(3), month_number(p(1)), p(2)),
    }
    # The form first: the parts are taken out of the one that fits.
    out = F.lit(None).cast("date")
    for pattern, read in reversed(forms.items()):
        out = F.when(s.rlike(pattern), read(lambda i, pattern=pattern: _part(s, pattern, i))).otherwise(out)
    return out
