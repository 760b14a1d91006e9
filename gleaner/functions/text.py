"""Text columns: blank and filler tests, white space, keys. JVM-side, but for Unicode normal forms of texts that are not ASCII."""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Entries that only say that nothing is known, in lower case, outer blanks removed.
FILLERS = (
    "-", "--", "---", "?", "??", "???", ".", "n.a.", "n.a", "n/a", "na", "nil", "none", "not applicable",
    "not available", "not known", "not specified", "null", "nan", "tba", "tbc", "tbd", "to be announced",
    "to be confirmed", "to be decided", "to be updated", "undefined", "unknown", "unspecified", "xx", "xxx",
)

#: White space in the Unicode sense, the no-break space and zero-width characters included.
BLANKS = r"[\s\u00a0\u1680\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"


def squeeze(c: Column) -> Column:
    """Outer blanks removed, inner runs of white space as one blank; null stays null."""
    return F.trim(F.regexp_replace(c, BLANKS + "+", " "))


def is_filler(c: Column) -> Column:
    """True for null, blank and filler text; never null."""
    s = F.lower(squeeze(c))
    return F.coalesce(s.isin("", *FILLERS), F.lit(True))


def reference_key(c: Column) -> Column:
    """Lower case, outer blanks removed, each run of blanks, hyphens and underscores as one underscore.

    Null and blank give null.
    """
    inner = F.regexp_replace(F.lower(squeeze(c)), r"[\s_-]+", "_")
    return F.nullif(inner, F.lit(""))


def no_blanks(c: Column) -> Column:
    """Lower case without any blank; null if nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(c, BLANKS + "+", "")), F.lit(""))


# --- generic helpers on text and nested values -----------------------------------------------------


def _sanitized(text: str) -> str:
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text).replace("\u200b", "")).strip()


def _sanitize(texts: pd.Series) -> pd.Series:
    return texts.map(_sanitized, na_action="ignore")


def _sanitize_lists(lists: pd.Series) -> pd.Series:
    return lists.map(lambda xs: [None if x is None else _sanitized(x) for x in xs], na_action="ignore")


def _to_ascii(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode(), na_action="ignore")


# Spark has no expression for normal forms; these see only the texts that are not ASCII, null for the others.
_sanitize_udf, _sanitize_lists_udf, _to_ascii_udf = F.pandas_udf(_sanitize, StringType()), F.pandas_udf(_sanitize_lists, ArrayType(StringType())), F.pandas_udf(_to_ascii, StringType())


def _beyond_ascii(c: Column) -> Column:
    return c.rlike(r"[^\x00-\x7f]")


def _sanitize_ascii(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\s\x1c-\x1f]+", " "))


def _without_separator(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c, r"\s*[|·•]\s*$", "")), F.lit(""))


def sanitize(c: Column) -> Column:
    """NFKC, zero-width spaces removed, runs of white space as one blank, outer blanks off."""
    return F.when(_beyond_ascii(c), _sanitize_udf(F.when(_beyond_ascii(c), c))).otherwise(_sanitize_ascii(c))


def clean(c: Column) -> Column:
    """`sanitize` and one trailing separator dropped; null if nothing is left. Not for use within a lambda."""
    return _without_separator(sanitize(c))


def slugify(c: Column, separator: str = "_") -> Column:
    """NFKD to ASCII (a letter loses its accent, what has no ASCII form goes), lower case, each run of other than letters and digits as one separator, none outside."""
    ascii_ = F.lower(F.when(_beyond_ascii(c), _to_ascii_udf(F.when(_beyond_ascii(c), c))).otherwise(c))
    return F.regexp_replace(F.regexp_replace(ascii_, r"[^a-z0-9]+", separator), rf"^\{separator}+|\{separator}+$", "")


def stable_hash(*parts: Column, length: int = 12) -> Column:
    """The first `length` hexadecimal digits of SHA-256 over the parts, joined by U+241F; a null part counts as empty."""
    return F.substring(F.sha2(F.concat_ws("␟", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, length)


def first_given(*values: Column) -> Column:
    """The first that is neither null nor blank text; 0 and false count."""
    return F.coalesce(*[F.when(F.trim(v.cast("string")) != "", v) for v in values])


def titleise(c: Column) -> Column:
    """A slug as a display name; short capitals and mixed case stay, and so does text with blanks and no - or _."""
    t = clean(c)
    words = F.filter(F.split(t, r"[-_\s]+"), lambda w: w != "")

    def word(w: Column) -> Column:
        rest = F.substring(w, F.lit(2), F.char_length(w))
        keep = ((F.upper(w) == w) & (F.lower(w) != w) & (F.char_length(w) <= 4)) | rest.rlike(r"\p{Lu}")
        return F.when(keep, w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(rest)))

    return F.when(t.contains(" ") & ~t.rlike("[-_]"), t).otherwise(F.nullif(F.array_join(F.transform(words, word), " "), F.lit("")))


def split_list(c: Column, separators: str = ",;|") -> Column:
    """The cleaned parts between separators (or a written \\n), the first of those that differ in case only."""
    split = F.split(c, r"[" + "".join("\\" + s for s in separators) + r"]|\\n")
    sanitized = F.when(_beyond_ascii(c), _sanitize_lists_udf(F.when(_beyond_ascii(c), split))).otherwise(F.transform(split, _sanitize_ascii))
    parts = F.filter(F.transform(sanitized, _without_separator), lambda x: x.isNotNull())
    empty = F.array().cast("array<string>")
    return F.aggregate(parts, empty, lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x)))


def json_path(c: Column, path: str, default: str | None = None) -> Column:
    """The text at a dotted path (a.b[0].c) of a JSON text; missing, null or unreadable gives the default."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(c), f"$.{path}", "string"), F.lit(default))


# --- URLs, and numbers as text ------------------------------------------------------------------------


@F.pandas_udf(StringType())
def _joined(href: pd.Series, base: pd.Series) -> pd.Series:
    def one(h: str | None, b: str | None) -> str | None:
        try:
            return None if h is None or not h.strip() else urljoin(b or "", h.strip()).replace(" ", "%20")
        except ValueError:
            return None

    return pd.Series([one(h, b) for h, b in zip(href, base, strict=True)], dtype=object)


def absolutise(href: Column, base: Column) -> Column:
    """A link as an absolute URL against the page's own, blanks as %20; null for none and for one that cannot be read. No built-in expression resolves links."""
    return F.when(href.rlike(r"^[a-z][a-z0-9+.-]*://[^ ]+$") & ~href.contains("/."), href).otherwise(_joined(href, base))


def whole_number(c: Column) -> Column:
    """A number without decimals, halves to even, thousands apart by commas."""
    return F.format_number(c, 0)


def short_number(c: Column) -> Column:
    """A number as short as it can be written: 5.0 as 5, at most four decimals."""
    return F.when(c.isNotNull(), F.regexp_replace(F.format_string("%.4f", c), r"\.?0+$", ""))


def percent_text(c: Column) -> Column:
    """A share as whole percents."""
    return F.concat(F.format_number(c * 100, 0), F.lit("%"))
