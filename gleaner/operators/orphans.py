"""References to records that do not exist, are gone or come later.

Integer parent keys are sorted and compressed into contiguous runs; a reference is matched to the
nearest preceding run start (an as-of match) and is an orphan beyond that run's end. Text keys take
part by their rank among all keys, of parents and references: there parents stand side by side until
an orphan comes between, so that there are at most as many runs as orphans, and one more for each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import reference_key
from gleaner.session import own_exchange, small_side

#: Keys are cut into ranges of about this many parts, within which runs are matched; a run that crosses a range is cut too.
RANGES = 1 << 12


def _range_of(key: Column, bits: int) -> Column:
    """The range of an integer key: its leading bits, so that neighbouring keys share a range."""
    return F.shiftright(key, bits)


def parent_runs(parents: DataFrame, key: str, attributes: list[str], bits: int) -> DataFrame:
    """Runs (part, run_start, run_end, attributes) of consecutive integer keys with equal attributes.

    `parents` holds each (key, attributes) once. Key minus its rank is constant within a run. Ranks
    are taken within a key range, which spreads the work; a run that crosses ranges is cut in two.
    """
    rank = F.row_number().over(Window.partitionBy("part", *attributes).orderBy(key))
    return (
        parents.withColumn("part", _range_of(F.col(key), bits))
        .withColumn("island", F.col(key) - rank)
        .groupBy("part", "island", *attributes)
        .agg(F.min(key).alias("run_start"), F.max(key).alias("run_end"))
        .drop("island")
    )


def match_references(refs: DataFrame, runs: DataFrame, key: str, bits: int, payload: list[str]) -> DataFrame:
    """Each row of `refs` with `hit`, the payload of the run that contains its key, else null.

    `refs` holds distinct keys (aggregate before the call: a hot key then costs one row). Runs and
    references are merged by range and key; the last run start at or before a reference is carried
    forward by a window, and the reference lies in that run if it is not beyond its end. Runs must
    not overlap: give one row for each start.
    """
    run_rows = runs.select("part", F.col("run_start").alias("k"), F.lit(0).alias("is_ref"), F.struct("run_end", *payload).alias("run"), F.lit(None).cast(refs.schema[key].dataType).alias(key), *[F.lit(None).cast(f.dataType).alias(f.name) for f in refs.schema if f.name != key])
    ref_rows = refs.select(_range_of(F.col(key), bits).alias("part"), F.col(key).alias("k"), F.lit(1).alias("is_ref"), F.lit(None).cast(run_rows.schema["run"].dataType).alias("run"), *[F.col(f.name) for f in refs.select(key, *[c for c in refs.columns if c != key]).schema])
    w = Window.partitionBy("part").orderBy("k", "is_ref").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last("run", ignorenulls=True).over(w)
    return (
        run_rows.unionByName(ref_rows)
        .withColumn("last", last)
        .where("is_ref = 1")
        .withColumn("hit", F.when(F.col("k") <= F.col("last.run_end"), F.col("last")))
        .select(*refs.columns, "hit")
    )


def integer_orphans(refs: DataFrame, ref_key: str, parents: DataFrame, parent_key: str, bits: int = 20) -> DataFrame:
    """(reference, n) for each distinct integer reference that no parent has, with the rows that use it.

    Null references are no references; an empty parent table makes every reference an orphan. 2**bits
    keys form one range.
    """
    keys = parents.select(F.col(parent_key).cast("long").alias("key")).where("key is not null").distinct()
    runs = parent_runs(keys, "key", [], bits)
    used = refs.select(F.col(ref_key).cast("long").alias("key")).where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    return match_references(used, runs, "key", bits, []).where("hit is null").select(F.col("key").alias("reference"), "n")


def url_slug(url: Column) -> Column:
    """The last segment of a URL without query, fragment, trailing slash and extension."""
    path = F.regexp_replace(F.trim(url), r"[?#].*$", "")
    last = F.regexp_extract(path, r"([^/]+)/*$", 1)
    return F.nullif(F.regexp_replace(last, r"\.[A-Za-z0-9]+$", ""), F.lit(""))


def card_lifetimes(cards: DataFrame) -> DataFrame:
    """(kind, key, lives) of the card master: each normalised card_id and slug with its lifetimes.

    lives holds (listed_at, retired_at) of each card with that key; a null listed_at means from the
    start, a null retired_at means to this day.
    """
    life = F.struct("listed_at", "retired_at")
    both = F.array(
        F.struct(F.lit("card_ids").alias("kind"), reference_key(F.col("identity.card_id")).alias("key")),
        F.struct(F.lit("unmatched_card_slugs").alias("kind"), reference_key(url_slug(F.col("identity.official_url"))).alias("key")),
    )
    return cards.select(F.inline(both), life.alias("life")).where("key is not null").groupBy("kind", "key").agg(F.array_sort(F.collect_set("life")).alias("lives"))


def card_references(offers: DataFrame, bank_offers: DataFrame) -> DataFrame:
    """(table_name, record_id, field_name, reference, extracted_at) of every card reference.

    Null and empty lists, null and blank entries give no row.
    """
    lists = F.array(
        F.struct(F.lit("card_ids").alias("f"), F.col("eligibility.card_ids").alias("v")),
        F.struct(F.lit("unmatched_card_slugs").alias("f"), F.col("eligibility.unmatched_card_slugs").alias("v")),
    )
    a = (
        offers.select(F.lit("offers").alias("table_name"), F.col("identity.offer_id").alias("record_id"), "extracted_at", F.inline(lists))
        .select("table_name", "record_id", "extracted_at", F.col("f").alias("field_name"), F.explode("v").alias("raw"))
    )
    b = bank_offers.select(F.lit("bank_offers").alias("table_name"), F.col("bank_offer_id").alias("record_id"), "extracted_at", F.lit("card_ids").alias("field_name"), F.explode("card_ids").alias("raw"))
    return a.unionByName(b).select("table_name", "record_id", "field_name", reference_key(F.col("raw")).alias("reference"), "extracted_at").where("reference is not null")


#: Bits below the part of a ranked text key; a part holds far fewer keys than 2 ** RANK_BITS.
RANK_BITS = 40


def ranked_keys(refs: DataFrame, parents: DataFrame, names: list[str]) -> DataFrame:
    """(names, is_ref, is_parent, key) of each distinct text key of both sides, `key` being dense integers.

    Keys are spread over parts by hash and ranked in order within a part, so no task sorts them all;
    the part is the leading bits of `key`. A hot key is one row here.
    """
    n_parts = int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = refs.select(*names, F.lit(1).alias("r"), F.lit(0).alias("p")).unionByName(parents.select(*names, F.lit(0).alias("r"), F.lit(1).alias("p")))
    distinct = both.groupBy(*names).agg(F.max("r").alias("is_ref"), F.max("p").alias("is_parent")).withColumn("in_part", F.pmod(F.xxhash64(*names), F.lit(n_parts)))
    rank = F.row_number().over(Window.partitionBy("in_part").orderBy(*names))
    return distinct.withColumn("key", F.shiftleft("in_part", RANK_BITS) + rank).drop("in_part")


def known_references(refs: DataFrame, parents: DataFrame, names: list[str]) -> DataFrame:
    """The distinct text keys `names` of `refs` that lie in a run of parent keys; those beyond a run's end are orphans."""
    keys = ranked_keys(refs, parents, names)
    runs = parent_runs(keys.where("is_parent = 1").select("key"), "key", [], RANK_BITS)
    asked = keys.where("is_ref = 1").select("key", *names)
    return match_references(asked, runs, "key", RANK_BITS, []).where("hit is not null").select(*names)


def card_orphans(offers: DataFrame, bank_offers: DataFrame, cards: DataFrame) -> DataFrame:
    """(table_name, period, record_id, field_name, reference, reason), each orphan reference once.

    missing: no such card; deleted: the card was retired at extracted_at; arrives_later: it was not
    listed yet. Where several cards share a key the reference is good if any of them was live, and of
    the reasons `deleted` goes first. A null extracted_at gives the period 'unknown' and only
    `missing`. Whether a card exists is found by the as-of match of distinct references to runs, and
    those that do exist get its lifetimes; the references' rows then meet them in a join that AQE splits.
    """
    refs = card_references(offers, bank_offers)
    parents = card_lifetimes(cards).withColumnsRenamed({"kind": "field_name", "key": "reference"})
    names = ["field_name", "reference"]
    known = own_exchange(known_references(refs, parents, names).join(small_side(parents), names))
    at = F.col("extracted_at")
    live = F.exists("lives", lambda x: (x["listed_at"].isNull() | (x["listed_at"] <= at)) & (x["retired_at"].isNull() | (x["retired_at"] > at)))
    gone = F.exists("lives", lambda x: F.coalesce(x["retired_at"] <= at, F.lit(False)))
    reason = (
        F.when(F.col("lives").isNull(), "missing").when(at.isNull() | F.coalesce(live, F.lit(False)), None).when(gone, "deleted").otherwise("arrives_later")
    )
    return (
        refs.join(known, names, "left")
        .select("table_name", F.coalesce(F.date_format("extracted_at", "yyyy-MM"), F.lit("unknown")).alias("period"), "record_id", "field_name", "reference", reason.alias("reason"))
        .where("reason is not null")
        .distinct()
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, period, field and reason: references, records and distinct keys."""
    return orphans.groupBy("table_name", "period", "field_name", "reason").agg(
        F.count("*").alias("n_references"), F.countDistinct("record_id").alias("n_records"), F.countDistinct("reference").alias("n_keys")
    )
