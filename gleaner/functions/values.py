"""Money, percentages, multipliers, caps, floors and dates found inside text. JVM-side expressions.

Each function reads the first match of its pattern, as the engine's users expect; text without one gives null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.dates import calendar_date

# The patterns of amounts.
CURRENCY = r"(?:₹|Rs\.?|INR)"
NUMBER = r"\d[\d,]*(?:\.\d+)?"
MONEY_PREFIX = rf"(?i){CURRENCY}\s*({NUMBER})\s*(lakh|lakhs|lac|cr|crore|k)?\b"
MONEY_SUFFIX = rf"(?i)({NUMBER})\s*(?:{CURRENCY}|/-)"
PERCENT = rf"({NUMBER})\s*%"
TIMES = r"(?i)\b(\d+(?:\.\d+)?)\s*x\b"
AMOUNT = rf"({CURRENCY}\s*{NUMBER}(?:\s*(?:lakh|lakhs|lac|k))?)"

# What the scale words multiply by.
SCALE = {"k": 1e3, "lakh": 1e5, "lakhs": 1e5, "lac": 1e5, "cr": 1e7, "crore": 1e7}

# Patterns of caps and floors, in order of priority.
CAPS = (
    rf"(?i)max(?:imum)?\.?\s*(?:discount|cashback|benefit|savings?)?\s*[:\-]?\s*(?:of\s*)?{AMOUNT}",
    rf"(?i)up\s*to\s*{AMOUNT}",
    rf"(?i)capped?\s*at\s*{AMOUNT}",
)
FLOORS = (
    rf"(?i)min(?:imum)?\.?\s*(?:tra?n?s?a?c?t?i?o?n?|trxn|txn|spend|purchase|booking|order|cart|bill)?\s*(?:value|amount|size)?\s*[:\-]?\s*(?:of\s*)?{AMOUNT}",
    rf"(?i)on\s*(?:a\s*)?min(?:imum)?\.?\s*(?:spend|purchase|transaction)\s*of\s*({CURRENCY}\s*{NUMBER})",
)
UPPER_BOUND = r"(?i)(?:up\s*to|as\s*much\s*as|max(?:imum)?(?:\s*of)?)\s*$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once; keeps generated code small where a body uses it many times."""
    return F.transform(F.array(value), body)[0]


def part(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none or it is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def number(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("double")


def scale_of(word: Column) -> Column:
    out = F.lit(1.0)
    for w, by in SCALE.items():
        out = F.when(F.lower(word) == w, by).otherwise(out)
    return out


def money(c: Column) -> Column:
    """The first rupee amount: a currency before the number (with a scale word) goes before one after it."""
    prefix = number(part(c, MONEY_PREFIX)) * scale_of(part(c, MONEY_PREFIX, 2))
    return F.round(F.coalesce(prefix, number(part(c, MONEY_SUFFIX))), 2)


def all_money(c: Column) -> Column:
    """Every amount with its currency before it, in order; an empty array for none, null for null."""
    numbers = F.regexp_extract_all(c, F.lit(MONEY_PREFIX), F.lit(1))
    words = F.regexp_extract_all(c, F.lit(MONEY_PREFIX), F.lit(2))
    return F.zip_with(numbers, words, lambda n, w: F.round(number(n) * scale_of(w), 2))


def percentage(c: Column) -> Column:
    """The first percentage; null if it is not within 0 to 100, without a look at later ones."""
    p = number(part(c, PERCENT))
    return F.when(p.between(0, 100), p)


def rate_type(c: Column) -> Column:
    """UP_TO where the words right before the first percentage bound it from above, else EXACT; null without one."""
    before = F.regexp_extract(c, rf"(?s)^(.*?){NUMBER}\s*%", 1)
    return F.when(part(c, PERCENT).isNotNull(), F.when(before.rlike(UPPER_BOUND), "UP_TO").otherwise("EXACT"))


def reward_multiplier(c: Column) -> Column:
    """N of the first "N x"; null outside 1 to 200."""
    x = number(part(c, TIMES))
    return F.when(x.between(1, 200), x)


def maximum_benefit(c: Column) -> Column:
    return F.coalesce(*[money(part(c, p)) for p in CAPS])


def minimum_spend(c: Column) -> Column:
    return F.coalesce(*[money(part(c, p)) for p in FLOORS])


# Patterns of dates inside text, and of ranges that share month or year.
ORDINAL = r"(?i)(?<=\d)\s*(?:st|nd|rd|th)\b"
ISO = r"\b(\d{4})-(\d{2})-(\d{2})\b"
DAY_MONTH = r"\b(\d{1,2})[\s\-/.]+([A-Za-z]{3,9})[\s\-/.,]+(\d{4})\b"
MONTH_DAY = r"\b([A-Za-z]{3,9})[\s\-/.]+(\d{1,2})[\s\-/.,]+(\d{4})\b"
NUMERIC = r"\b(\d{1,2})[/-](\d{1,2})[/-](\d{4})\b"
COMPACT = r"(?i)\b(\d{1,2})\s*([A-Za-z]{3,9})?\s*(?:-|–|to|till|until)\s*(\d{1,2})\s*([A-Za-z]{3,9})\s*(\d{4})\b"
SPLIT = r"(?i)\s*(?:-|–|to|till|until|through)\s*"
ENDS = r"(?i)\b(?:valid\s*(?:till|until|up\s*to)|expires?|ends?)\b"

# Month names.
MONTH_NAMES = {n: i for i, n in enumerate("january february march april may june july august september october november december".split(), 1)}
MONTHS = {**MONTH_NAMES, **{n[:3]: i for n, i in MONTH_NAMES.items()}, "sept": 9}


def month_of(name: Column) -> Column:
    """1 to 12 for an English month name or its abbreviation, else null."""
    pairs = [x for n, i in MONTHS.items() for x in (F.lit(n), F.lit(i))]
    return F.try_element_at(F.create_map(*pairs), F.lower(name))


def _int(c: Column) -> Column:
    return c.try_cast("int")


def date(c: Column) -> Column:
    """The first date, day before month. A year-first or a named month that names no day of the calendar gives null."""
    return let(F.regexp_replace(c, ORDINAL, ""), _date)


def _date(t: Column) -> Column:
    iso = calendar_date(part(t, ISO, 1), part(t, ISO, 2), part(t, ISO, 3))
    dm, md = month_of(part(t, DAY_MONTH, 2)), month_of(part(t, MONTH_DAY, 1))
    first = _int(part(t, NUMERIC, 1))
    return (
        F.when(part(t, ISO).isNotNull(), iso)
        .when(dm.isNotNull(), calendar_date(part(t, DAY_MONTH, 3), dm, part(t, DAY_MONTH, 1)))
        .when(md.isNotNull(), calendar_date(part(t, MONTH_DAY, 3), md, part(t, MONTH_DAY, 2)))
        .when(first.isNotNull(), calendar_date(part(t, NUMERIC, 3), part(t, NUMERIC, 2), first))
    )


def date_range(c: Column) -> Column:
    """struct(start, end). A compact range's start takes month and year from its end, a year less if its month is later.

    Else the text is cut at the first separator and each side read as a date; a single date is the
    end where the text says that something ends, else the start.
    """
    return let(F.regexp_replace(c, ORDINAL, ""), _range)


def _range(t: Column) -> Column:
    end_month = month_of(part(t, COMPACT, 4))
    start_month = month_of(F.coalesce(part(t, COMPACT, 2), part(t, COMPACT, 4)))
    year = _int(part(t, COMPACT, 5))
    start_year = F.when(start_month > end_month, year - 1).otherwise(year)
    pair = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    compact = pair(calendar_date(start_year, start_month, part(t, COMPACT, 1)), calendar_date(year, end_month, part(t, COMPACT, 3)))
    sides = F.split(t, SPLIT, 2)
    left, right, single = let(sides[0], _date), let(F.get(sides, F.lit(1)), _date), let(t, _date)
    none = F.lit(None).cast("date")
    return (
        F.when(start_month.isNotNull() & end_month.isNotNull(), compact)
        .when((F.size(sides) == 2) & (left.isNotNull() | right.isNotNull()), pair(left, right))
        .when(single.isNotNull() & t.rlike(ENDS), pair(none, single))
        .otherwise(pair(single, none))
    )
