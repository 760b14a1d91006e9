"""Quantities in different units, parsed by a grammar and brought to canonical units.

A unit is a vector of exponents over base dimensions with a scale and an offset; products, quotients
and prefixes of units are worked out on the vectors. The text grammar reads

    amount   := [currency] number [scale] [unit]
    number   := digits with group separators (any script) | number words
    cap      := lead [what is capped] [mark] [link words] amount
    rate     := points "per" amount, in either order | N "X" over a stated rate

Texts are parsed in Arrow batches, each distinct text of a batch once; the rest is column work.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal
from math import isfinite

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.session import small_side

#: A longer run of digits is no number.
MOST_DIGITS = 300

#: Base dimensions, in the order of a unit's exponents.
DIMENSIONS = ("money", "points", "length", "mass", "time", "temperature")


@dataclass(frozen=True)
class Unit:
    """value in canonical units = value * scale + offset; `dims` are the exponents over DIMENSIONS."""

    dims: tuple[int, ...]
    scale: Decimal = Decimal(1)
    offset: Decimal = Decimal(0)

    def __mul__(self, other: Unit) -> Unit:
        return Unit(tuple(a + b for a, b in zip(self.dims, other.dims, strict=True)), self.scale * other.scale)

    def __truediv__(self, other: Unit) -> Unit:
        return Unit(tuple(a - b for a, b in zip(self.dims, other.dims, strict=True)), self.scale / other.scale)

    def scaled(self, by: Decimal) -> Unit:
        return Unit(self.dims, self.scale * by, self.offset)


def base(name: str, scale: str = "1", offset: str = "0") -> Unit:
    return Unit(tuple(int(d == name) for d in DIMENSIONS), Decimal(scale), Decimal(offset))


NONE = Unit((0,) * len(DIMENSIONS))

# Unit words. Canonical units: paise, point, metre, gram, second, kelvin.
UNITS = {
    "rs": base("money", "100"), "re": base("money", "100"), "inr": base("money", "100"), "₹": base("money", "100"), "rupee": base("money", "100"), "rupees": base("money", "100"),
    "rupaye": base("money", "100"), "/-": base("money", "100"), "/=": base("money", "100"), "p": base("money"), "paise": base("money"), "paisa": base("money"), "ps": base("money"),
    "point": base("points"), "points": base("points"), "pt": base("points"), "pts": base("points"), "rp": base("points"), "rps": base("points"), "coin": base("points"), "coins": base("points"),
    "mm": base("length", "0.001"), "cm": base("length", "0.01"), "m": base("length"), "km": base("length", "1000"),
    "mg": base("mass", "0.001"), "g": base("mass"), "kg": base("mass", "1000"),
    "second": base("time"), "seconds": base("time"), "minute": base("time", "60"), "minutes": base("time", "60"), "hour": base("time", "3600"), "hours": base("time", "3600"), "day": base("time", "86400"), "days": base("time", "86400"),
    "kelvin": base("temperature"), "celsius": base("temperature", "1", "273.15"), "fahrenheit": base("temperature", "0.55555555555555555556", "255.37222222222222222"),
}

# Scale words.
SCALES = {
    "'000": 1000, "000s": 1000, "k": 1000, "thousand": 1000, "thousands": 1000, "hundred": 100, "l": 100000, "lac": 100000, "lacs": 100000, "lakh": 100000, "lakhs": 100000,
    "cr": 10000000, "crore": 10000000, "crores": 10000000, "m": 1000000, "mn": 1000000, "million": 1000000,
}

# Number words.
SMALL = {
    w: i
    for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())
} | {w: 10 * i for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
BIG = {"hundred": 100, "thousand": 1000, "lakh": 100000, "lac": 100000, "crore": 10000000}

TOKEN = re.compile(r"\d[\d,]*(?:\.\d+)?|\.\d+|'000|/-|/=|₹|[^\W\d_]+\.?|[%(){}\[\]:;|,/&+=*x×.-]", re.UNICODE)


def tokens_of(text: str) -> list[str]:
    """Tokens in lower case; digits of any script as ASCII, the final dot of an abbreviation dropped."""
    s = unicodedata.normalize("NFKC", text)
    s = "".join(str(unicodedata.digit(c)) if not c.isascii() and c.isdigit() else c for c in s).lower().replace("’", "'")
    return [t.rstrip(".") or t for t in TOKEN.findall(s)]


class Reader:
    """A recursive-descent reader over tokens; each rule gives what it read and the next place, or None."""

    def __init__(self, text: str) -> None:
        self.t = tokens_of(text)

    def at(self, i: int) -> str:
        return self.t[i] if 0 <= i < len(self.t) else ""

    def number(self, i: int) -> tuple[Decimal, int] | None:
        s = self.at(i)
        if len(s) <= MOST_DIGITS and (s[:1].isdigit() or (s[:1] == "." and len(s) > 1)):
            return Decimal(s.replace(",", "")), i + 1
        total, part, j = 0, 0, i
        while (w := self.at(j)) in SMALL or w in BIG or (w in ("and", "-") and j > i and self.at(j + 1) in SMALL):
            if w in SMALL:
                part += SMALL[w]
            elif w == "hundred":
                part = max(part, 1) * 100
            elif w in BIG:
                total, part = total + max(part, 1) * BIG[w], 0
            j += 1
        return (Decimal(total + part), j) if j > i and self.at(i) not in ("and", "-", *BIG) else None

    def scale(self, i: int) -> tuple[Decimal, int]:
        by = Decimal(1)
        while self.at(i) in SCALES:
            by, i = by * SCALES[self.at(i)], i + 1
        return by, i

    def unit(self, i: int) -> tuple[Unit, int] | None:
        return (UNITS[self.at(i)], i + 1) if self.at(i) in UNITS else None

    def amount(self, i: int) -> tuple[Decimal, Unit | None, int] | None:
        """Number, unit with its scale (None if no unit is written) and the next place."""
        before = self.unit(i)
        if before and not any(before[0].dims[:1]):
            before = None
        if not (n := self.number(before[1] if before else i)):
            return None
        by, j = self.scale(n[1])
        after = self.unit(j)
        if before and after and before[0].dims == after[0].dims and self.at(j) in ("/-", "/=", "rupees", "rupee"):
            j = after[1]  # both ends write the currency
        elif not before and after:
            return n[0], after[0].scaled(by), after[1]
        elif not before:
            return n[0] * by, None, j
        return n[0], before[0].scaled(by), j


def money(u: Unit | None) -> bool:
    return u is not None and u.dims == UNITS["paise"].dims


def points(u: Unit | None) -> bool:
    return u is not None and u.dims == UNITS["points"].dims


# The words of a cap. A lead may be followed by what is capped, a mark and a link word.
LEADS = [p.split() for p in ("max", "maximum", "up to", "upto", "as much as", "capped", "cap", "limit", "limited", "ceiling", "not exceeding", "not more than", "no more than", "not above")]
CAPPED = ("discount", "discounts", "cashback", "cash", "back", "benefit", "benefits", "saving", "savings", "reward", "rewards", "instant", "total", "overall", "value", "amount", "off", "limit", "cap")
MARKS, LINKS = (":", "-", "="), ("of", "at", "to", "is", "a", "up", "the")
LEAD_BY_FIRST = {first: [p for p in LEADS if p[0] == first] for first in {p[0] for p in LEADS}}
POINT_WORDS = {w for w, u in UNITS.items() if u.dims == UNITS["points"].dims}


def cap_amount(r: Reader, i: int) -> tuple[Decimal, Unit | None, int] | None:
    """The amount of a cap whose lead ends before `i`: [what is capped] [mark] [link words] amount."""
    for words in (CAPPED, MARKS, LINKS):
        i = skip(r, i, *words)
    return r.amount(i)


def cap_of(r: Reader) -> tuple[str, Decimal | None, Unit | None] | None:
    """('money', value, unit), ('bare', value, None) or ('points', ...): the first cap that the text states."""
    found = None
    for i in range(len(r.t)):
        for lead in LEAD_BY_FIRST.get(r.t[i], ()):
            if r.t[i : i + len(lead)] != lead or (r.at(i - 1) in ("min", "minimum", "no")):
                continue
            if not (a := cap_amount(r, i + len(lead))):
                continue
            n, u, j = a
            if r.at(j) in ("%", "percent", "pct", "x", "×") or (r.at(j) == "per" and r.at(j + 1) == "cent"):
                continue
            if r.at(j) == "reward" and r.at(j + 1) in UNITS or r.at(j) == "bonus":
                j, u = j + 1, UNITS["points"]
            if money(u):
                return "money", n, u
            if points(u):
                return "points", n, u
            if u is None and found is None and not r.at(j).isalpha():
                found = ("bare", n, None)
    return found


def skip(r: Reader, i: int, *words: str) -> int:
    while r.at(i) in words:
        i += 1
    return i


PER = ("per", "/", "for", "on", "each", "every", "a", "an", "=", "of")
BASE_WORDS = ("base", "usual", "standard", "regular", "normal")


def points_at(r: Reader, i: int) -> tuple[Decimal, int] | None:
    if not (n := r.number(i)):
        return None
    by, j = r.scale(n[1])
    j = skip(r, j, "reward", "bonus", "edge", "loyalty", "extra")
    if points(UNITS.get(r.at(j))):
        return n[0] * by, j + 1
    return (n[0] * by, j) if r.at(i - 1) in BASE_WORDS and r.at(j) in PER else None  # "base 50 per Rs 1000"


def spend_at(r: Reader, i: int) -> tuple[Decimal, int] | None:
    """Paise of a stated spend at `i`; a unit without a number is one of it."""
    if a := r.amount(i):
        return (a[0] * a[1].scale, a[2]) if money(a[1]) else None
    u = r.unit(i)
    return (u[0].scale, u[1]) if u and money(u[0]) else None


def per_spend(r: Reader, i: int) -> tuple[Decimal, int] | None:
    j = skip(r, i, *PER)
    return spend_at(r, j) if j > i else None


RATE = UNITS["points"] / UNITS["paise"]
#: Thousandths of a point for Rs 100.
RATE_CANONICAL = Unit(RATE.dims, Decimal(1000 * 100 * 100))


def rate_of(r: Reader) -> Decimal | None:
    """Points for one paisa of a stated spend, an nX over a stated base included, else None."""
    times = None
    if POINT_WORDS.isdisjoint(r.t):
        return None
    for i in range(len(r.t)):
        if (n := r.number(i)) and r.at(n[1]) in ("x", "×"):
            times = n[0]
        if p := points_at(r, i):
            if (s := per_spend(r, p[1])) and s[0] > 0:
                plain = p[0] / s[0]
                stated_base = {*BASE_WORDS, "over"} & set(r.t[max(0, i - 4) : i])
                return plain * times if times is not None and stated_base else plain
        if r.at(i) in ("each", "every", "per") and (s := spend_at(r, skip(r, i, *PER))) and s[0] > 0:
            j = skip(r, s[1], "spent", "spend", ",", "you", "get", "earn", "receive", "gives", "fetches", ":", "=")
            if p := points_at(r, j):
                return p[0] / s[0]
    return None


def unit_of(text: str | None) -> Unit | None:
    """The unit that a whole cell writes, such as "INR thousand", "Rs '000" or "PAISE"; money if only a scale is written."""
    if text is None or not str(text).strip():
        return None
    r, by, unit = Reader(str(text)), Decimal(1), None
    for t in r.t:
        if t in UNITS and unit is None:
            unit = UNITS[t]
        elif t in SCALES:
            by *= SCALES[t]
        elif t not in ("in", "of", "(", ")"):
            return None
    return (unit or (UNITS["rs"] if by != 1 else None)) and (unit or UNITS["rs"]).scaled(by)


def to_int(x: Decimal) -> int:
    """The nearest whole number, halves up, of any size."""
    return int(x.to_integral_value(ROUND_HALF_UP))


def fits(n: int | None) -> bool:
    """Whether a number can stand in a BIGINT column."""
    return n is not None and abs(n) < 2**63


def quantities_of(text: str | None, number: float | None, currency: str | None, amount_unit: str | None) -> tuple[int | None, int | None]:
    """(cap in paise, thousandths of a point per Rs 100); None where the record states none. An infinite number is none."""
    cap = rate = stated = None
    if text is not None and text.strip():
        r = Reader(text)
        stated = cap_of(r)
        if (x := rate_of(r)) is not None:
            rate = to_int(x * RATE_CANONICAL.scale)
    unit = unit_of(currency) or unit_of(amount_unit)
    if stated and stated[0] == "money":
        cap = to_int(stated[1] * stated[2].scale + stated[2].offset)
    elif stated and stated[0] == "points":
        cap = None
    elif stated and money(unit):
        cap = to_int(stated[1] * unit.scale)
    elif number is not None and isfinite(number) and money(unit):
        cap = to_int(Decimal(repr(float(number))) * unit.scale)
    return cap, rate


def read_quantities(offers: DataFrame, sources: DataFrame) -> DataFrame:
    """(offer_id, quantity, amount, beyond) of every offer that states a cap in money or points for a spend.

    `beyond` holds as text the amounts that no BIGINT can hold; `amount` is null there. Each distinct
    text of a batch is parsed once.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[tuple, tuple] = {}
            out: list[tuple[str | None, str, int | None, str | None]] = []
            for oid, *key in zip(*(c.to_pylist() for c in b.columns), strict=True):
                k = tuple(None if x != x else x for x in key)
                if k not in seen:
                    seen[k] = quantities_of(*k)
                for name, amount in zip(("cap_paise", "points_per_100_milli"), seen[k], strict=True):
                    if amount is not None:
                        out.append((oid, name, amount, None) if fits(amount) else (oid, name, None, f"{Decimal(amount):.6E}"))
            columns = zip(*out, strict=True) if out else [()] * 4
            types = (pa.string(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["offer_id", "quantity", "amount", "beyond"])

    units = sources.groupBy(F.trim("url").alias("url")).agg(F.max("amount_unit").alias("amount_unit"))
    stated = offers.select(
        F.col("identity.offer_id").alias("offer_id"), "benefit.benefit_text", "benefit.maximum_benefit", "benefit.currency", F.trim("source_url").alias("url")
    )
    read_columns = ("offer_id", "benefit_text", "maximum_benefit", "currency", "amount_unit")
    return stated.join(small_side(units), "url", "left").select(*read_columns).mapInArrow(read, "offer_id string, quantity string, amount bigint, beyond string")


def offer_quantities(offers: DataFrame, sources: DataFrame) -> DataFrame:
    """(offer_id, quantity, amount) of every offer that states a cap in money or points for a spend.

    The unit of the cap is the one in the text, else `currency`, else the source's amount_unit; a
    number without any unit, text that states no amount and caps in points give no row. Equal rows
    come out once; offers that differ under one offer_id each give theirs. Nulls in any column,
    blank and very long texts are read as what they hold; an infinite number counts as not stated.
    Amounts beyond BIGINT are left out here and reported by `quantities_beyond`.
    """
    return read_quantities(offers, sources).where("amount is not null").select("offer_id", "quantity", "amount").distinct()


def quantities_beyond(offers: DataFrame, sources: DataFrame) -> DataFrame:
    """(offer_id, quantity, beyond): the stated amounts that no BIGINT can hold, in scientific notation."""
    return read_quantities(offers, sources).where("beyond is not null").select("offer_id", "quantity", "beyond").distinct()
