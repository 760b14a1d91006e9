"""What changed between consecutive full snapshots.

Each key is windowed by the dense index of its snapshot: a lagged hash that differs is a change, a gap
in the index is a removal and, where the key comes back, an addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.dates import parse_date_cell
from gleaner.functions.text import is_filler, no_blanks, squeeze
from gleaner.session import small_side


def latest_per_snapshot(df: DataFrame, key: str, snapshot: str, version: str, values: Sequence[str]) -> DataFrame:
    """One row for each key and snapshot: the values of the row with the latest `version`.

    Rows with a null key or snapshot are left out. A null version is the oldest; of rows with equal
    versions the one with the largest values counts, so that the result is the same on every run.
    The maximum is combined before the shuffle, so a key or date that holds many rows stays cheap.
    """
    best = F.max(F.struct(F.col(version).alias("v"), *[F.col(c) for c in values]))
    return (
        df.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull())
        .groupBy(key, snapshot)
        .agg(best.alias("best"))
        .select(key, snapshot, *[F.col(f"best.{c}").alias(c) for c in values])
    )


def snapshot_changes(df: DataFrame, key: str, snapshot: str, values: Sequence[str]) -> DataFrame:
    """(snapshot, key, change_kind) for each key added, removed or changed against the preceding snapshot.

    `df` holds at most one row for each key and snapshot. The first snapshot has no cases; an empty
    table gives an empty result. Null values are values: null against null is no change. The distinct
    dates are few however large the table is (one for each delivery), so numbering them in one task
    is bounded by the number of deliveries.
    """
    dates = df.select(F.col(snapshot).alias("__d")).distinct()
    every = Window.orderBy("__d")
    dates = dates.select(
        "__d",
        F.row_number().over(every).alias("__i"),
        F.lead("__d").over(every).alias("__next"),
    )
    hashed = df.select(F.col(key).alias("__k"), F.col(snapshot).alias("__d"), F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in values]).alias("__h"))
    w = Window.partitionBy("__k").orderBy("__i")
    seen = hashed.join(small_side(dates), "__d").select(
        "*",
        F.lag("__i").over(w).alias("__pi"),
        F.lag("__h").over(w).alias("__ph"),
        F.lead("__i").over(w).alias("__ni"),
    )
    added = F.when((F.col("__i") > 1) & (F.col("__pi").isNull() | (F.col("__pi") < F.col("__i") - 1)), F.struct(F.col("__d").alias("d"), F.lit("added").alias("kind")))
    changed = F.when((F.col("__pi") == F.col("__i") - 1) & (F.col("__ph") != F.col("__h")), F.struct(F.col("__d").alias("d"), F.lit("changed").alias("kind")))
    removed = F.when(F.col("__next").isNotNull() & (F.col("__ni").isNull() | (F.col("__ni") > F.col("__i") + 1)), F.struct(F.col("__next").alias("d"), F.lit("removed").alias("kind")))
    return (
        seen.select("__k", F.explode(F.array_compact(F.array(added, changed, removed))).alias("c"))
        .select(F.col("c.d").alias(snapshot), F.col("__k").alias(key), F.col("c.kind").alias("change_kind"))
    )


def normalised_offer_snapshots(df: DataFrame) -> DataFrame:
    """offer_snapshots with ids, statuses and dates in one written form.

    offer_id in lower case without blanks (blank: null); a missing or filler status is UNKNOWN; a date
    that is a filler is null, one that cannot be read keeps its text, so that it differs from others.
    """
    status = F.when(is_filler(F.col("lifecycle_status")), F.lit("UNKNOWN")).otherwise(F.upper(squeeze(F.col("lifecycle_status"))))
    until = F.when(
        ~is_filler(F.col("valid_until")),
        F.coalesce(parse_date_cell(F.col("valid_until")).cast("string"), F.lower(squeeze(F.col("valid_until")))),
    )
    return df.select("snapshot_date", no_blanks(F.col("offer_id")).alias("offer_id"), status.alias("lifecycle_status"), until.alias("valid_until"), "loaded_at")


def offer_changes(df: DataFrame) -> DataFrame:
    """The cases of offer_snapshots as (snapshot_date STRING, offer_id, change_kind)."""
    values = ["lifecycle_status", "valid_until"]
    latest = latest_per_snapshot(normalised_offer_snapshots(df), "offer_id", "snapshot_date", "loaded_at", values)
    return snapshot_changes(latest, "offer_id", "snapshot_date", values).select(F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), "offer_id", "change_kind")
