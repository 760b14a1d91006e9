"""Building records: fields through transforms, ids, evidence, unions by priority, documents fetched once and joined back."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from gleaner.functions.text import clean, stable_hash
from gleaner.session import own_exchange

#: Characters of evidence that are kept.
EVIDENCE_CHARS = 2000


def guarded(function: Callable[[Any], Any], to: DataType | str = StringType()) -> Callable[[Column], Column]:
    """A Python transform as a column function: null for null, and null where it fails; other rows are not touched by a failure."""

    def one(value: Any) -> Any:
        try:
            return None if value is None else function(value)
        except Exception:
            return None

    def batch(values: pd.Series) -> pd.Series:
        return pd.Series([one(v) for v in values], dtype=object)

    return F.pandas_udf(batch, to)


def parse_records(df: DataFrame, transforms: Mapping[str, Callable[[Column], Column]], keep: Sequence[str] = (), drop_unmapped: bool = False) -> DataFrame:
    """`df` with each field of `transforms` replaced by its transform; a field that `df` lacks is null.

    Other text fields are cleaned, or dropped with `drop_unmapped`; those in `keep` stay as they are. Use
    try_* functions or `guarded` in transforms, so that one failing value becomes null.
    """
    out = []
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    for c in df.columns:
        if c in transforms:
            out.append(transforms[c](F.col(f"`{c}`")).alias(c))
        elif c in keep:
            out.append(F.col(f"`{c}`"))
        elif not drop_unmapped:
            out.append((clean(F.col(f"`{c}`")) if c in text else F.col(f"`{c}`")).alias(c))
    out += [t(F.lit(None).cast("string")).alias(c) for c, t in transforms.items() if c not in df.columns]
    return df.select(*out)


def record_id(key: Column, ref: Column, title: Column) -> Column:
    """The id of a record: its source's key and ten digits of the hash of key, reference and title as delivered."""
    return F.concat(key, F.lit("__"), stable_hash(key, ref, title, length=10))


def evidence(field: str, value: Column, text: Column, source_url: Column, needs_review: Column | bool = False, reason: Column | None = None) -> Column:
    """An evidence entry: the field, its value as JSON text, at most EVIDENCE_CHARS of the text it was read from, and where."""
    shown = F.coalesce(F.to_json(F.struct(value.alias("v"))), F.lit("{}"))
    inner = F.nullif(F.regexp_extract(shown, r'(?s)^\{"v":(.*)\}$', 1), F.lit(""))
    review = needs_review if isinstance(needs_review, Column) else F.lit(needs_review)
    none = F.lit(None).cast("string")
    return F.struct(F.lit(field).alias("field"), inner.alias("value"), F.substring(text, 1, EVIDENCE_CHARS).alias("evidence"), source_url.alias("source_url"), review.alias("needs_review"), (none if reason is None else reason).alias("review_reason"))


def with_validity(df: DataFrame, start: Column, end: Column, text: Column, source_url: Column) -> DataFrame:
    """`df` with `valid_from`, `valid_until` and `evidence`: one entry if either bound is known, else none."""
    bounds = F.concat_ws(" to ", F.coalesce(start.cast("string"), F.lit("?")), F.coalesce(end.cast("string"), F.lit("?")))
    entry = F.when(start.isNotNull() | end.isNotNull(), evidence("validity", bounds, text, source_url))
    return df.withColumns({"valid_from": start, "valid_until": end, "evidence": F.array_compact(F.array(entry))})


def set_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """`df` with the nested field at a dotted path set; the structs on the way keep their other fields."""
    top, _, rest = path.partition(".")
    return df.withColumn(top, F.col(top).withField(rest, value) if rest else value)


def priority_union(tables: Sequence[DataFrame], key: str, order: str) -> DataFrame:
    """The rows of all tables, one for each `key`: from the first table that has it, there the least by `order`. Rows without a key are left out.

    A minimum that combines before the shuffle, so a key that holds a third of the rows stays cheap.
    """
    parts = [t.select(F.lit(i).alias("__priority"), F.struct(*[F.col(c) for c in tables[0].columns]).alias("__row")) for i, t in enumerate(tables)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    best = every.where(F.col(f"__row.{key}").isNotNull()).groupBy(F.col(f"__row.{key}").alias("__key")).agg(F.min_by("__row", F.struct(F.col("__priority"), F.col(f"__row.{order}"), F.col("__row"))).alias("__row"))
    return best.select("__row.*")


def document_links(offers: DataFrame) -> DataFrame:
    """(offer_id, pos, url) of the documents that offers link to; null entries and blank URLs are left out."""
    docs = offers.select(F.col("identity.offer_id").alias("offer_id"), F.posexplode("eligibility.linked_eligibility_documents").alias("pos", "doc"))
    return docs.select("offer_id", "pos", F.trim("doc.url").alias("url")).where("url <> ''")


def enrich(links: DataFrame, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`links` with the columns that `read` gives for each distinct URL (url, ...), each URL read once however many rows link to it."""
    return links.join(own_exchange(read(links.select("url").distinct())), "url", "left")


def pick_column(cells: Column, pattern: str) -> Column:
    """The value of the first cell (name, value), in order, whose name matches and whose value is not blank; null for none."""
    return F.get(F.filter(cells, lambda c: c["name"].rlike(pattern) & (F.trim(c["value"]) != "")), F.lit(0))["value"]


def entry_lines(text: Column, noise: str = r"(?i)^page\s*\d+|^\W*$", shortest: int = 3, longest: int = 160, limit: int = 400) -> Column:
    """The lines of a document that may be entries: tidied, of a usable length, without noise, the first of those that differ in case only, at most `limit`."""
    lines = F.transform(F.split(text, r"\r\n|\n|\r"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " ")))
    kept = F.filter(lines, lambda s: F.char_length(s).between(shortest, longest) & ~s.rlike(noise))
    low = F.transform(kept, F.lower)
    first = F.filter(F.transform(kept, lambda s, i: F.struct(s.alias("s"), i.alias("i"))), lambda x: F.array_position(low, F.lower(x["s"])) == x["i"] + 1)
    return F.slice(F.transform(first, lambda x: x["s"]), 1, limit)
