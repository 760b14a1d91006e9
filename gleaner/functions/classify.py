"""Categories, transaction kinds and comparison keys from text. JVM-side expressions, but for what `text.clean` leaves to Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import clean

# Category labels of sources and the shared category of each; the first that fits counts.
CATEGORIES = {
    "electronics-n-mobiles": "ELECTRONICS", "electronics": "ELECTRONICS", "mobile": "ELECTRONICS",
    "fashion-n-lifestyle": "FASHION", "fashion_items": "FASHION", "fashion": "FASHION", "lifestyle": "FASHION",
    "jewellery": "JEWELLERY",
    "dept-stores-n-groceries": "GROCERY", "grocery": "GROCERY", "departmental-stores": "GROCERY",
    "online-marketplace": "ECOMMERCE", "e-commerce": "ECOMMERCE", "ecommerce": "ECOMMERCE", "shopping": "ECOMMERCE",
    "travel-n-lodging": "TRAVEL", "travel": "TRAVEL",
    "dining": "DINING", "food": "DINING",
    "health-and-wellness": "HEALTH", "health": "HEALTH", "wellness": "HEALTH",
    "insurance": "INSURANCE", "fuel": "FUEL", "entertainment": "ENTERTAINMENT", "education": "EDUCATION",
    "mall-offers": "RETAIL", "my-city-offers": "RETAIL", "retail": "RETAIL",
    "others": "OTHER",
}


def category(c: Column) -> Column:
    """The shared category of a label: an exact one, else the first that contains it or that it contains, else OTHER; null for blank."""
    key = F.regexp_replace(F.lower(F.trim(c)), r"[\s_]+", "-")
    exact = F.try_element_at(F.create_map(*[x for k, v in CATEGORIES.items() for x in (F.lit(k), F.lit(v))]), key)
    entries = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in CATEGORIES.items()])
    near = F.filter(entries, lambda e: key.contains(e["k"]) | e["k"].contains(key))
    return F.when(F.trim(c) != "", F.coalesce(exact, F.get(near, F.lit(0))["v"], F.lit("OTHER")))


# Patterns of transaction kinds, and flags.
EMI, UPI = r"(?i)\bemi\b", r"(?i)\bupi\b"
IN_STORE, ONLINE = r"(?i)\bin[-\s]*store\b|\boffline\b|\bat\s*(?:the\s*)?outlet", r"(?i)\bonline\b|\bwebsite\b|\bapp\b"
YES, NO = ("Y", "YES", "TRUE", "ONLINE"), ("N", "NO", "FALSE", "OFFLINE")


def transaction_type(text: Column, flag: Column) -> Column:
    """EMI_ONLY and UPI_ONLY by the text, then the flag, then words for stores and for online; null where all are silent."""
    f = F.upper(flag.cast("string"))
    return (
        F.when(text.rlike(EMI), "EMI_ONLY").when(text.rlike(UPI), "UPI_ONLY").when(f.isin(*YES), "ONLINE").when(f.isin(*NO), "OFFLINE").when(text.rlike(IN_STORE), "OFFLINE").when(text.rlike(ONLINE), "ONLINE")
    )


# Names that stay apart though they share a stem, and words that do not tell names apart.
DISTINCT_NAMES = (
    "amazon", "amazon pay", "amazon fresh", "amazon business", "flipkart", "flipkart health", "myntra", "ajio", "tata cliq",
    "tata cliq luxury", "tata neu", "reliance digital", "reliance smart", "reliance trends", "jiomart",
)
NOISE = r"(?U)\b(?:pvt|private|ltd|limited|india|indian|online|store|stores|shop|shopping|gift|vouchers?|e-?voucher|gift\s*cards?|offers?|deals?|com|in)\b"


def alias_key(c: Column) -> Column:
    """The key by which merchant names are compared: no case, punctuation or noise words, the order kept; null if nothing is left."""
    low = F.lower(clean(c))
    plain = lambda x: F.nullif(F.trim(F.regexp_replace(x, r"[^a-z0-9]+", " ")), F.lit(""))
    return F.when(low.isin(*DISTINCT_NAMES), plain(low)).otherwise(F.coalesce(plain(F.regexp_replace(low, NOISE, " ")), plain(low)))


# Words that do not tell cards apart.
CARD_STOP_WORDS = ("credit", "card", "cards", "the", "a", "an", "in", "association", "with", "apply", "for", "online", "bank", "co", "branded")


def card_tokens(c: Column) -> Column:
    """The sorted set of telling words of a card's name or slug; empty for null."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\+", " plus "), r"[^a-z0-9]+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: (w != "") & ~w.isin(*CARD_STOP_WORDS))))
