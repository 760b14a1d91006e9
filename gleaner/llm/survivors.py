"""Best representative of each group of duplicate records, by skyline layers.

A record is judged by completeness (the set of its usable fields), trust (source tier) and recency
(last verification, ties by record id). One record dominates another if it is at least as good in
all three and better in one. The records that none dominates form the first layer, those dominated
only by them the second, and so on. Each field takes its value from the first layer that has a usable
one, there by the policy: best tier, then latest, then smallest id. As completeness is compared as a
set, a field's best record can only be dominated by one that is better by the policy and usable too,
so the layers give exactly the policy's record. With completeness as a count (`by_count`) it need not
stand in the first layer, and `layer_conflicts` reports where the layers then give another record.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import is_filler, squeeze

# Tiers from the most trusted on, and dates that fill a gap.
TIERS = "SABCD"
FILLER_DATES = ("0001-01-01", "1900-01-01", "1970-01-01", "1999-12-31", "2099-12-31", "2999-12-31", "9999-12-31")

# The fields of an offer that are chosen one by one, by name and place.
FIELDS = {
    "title": "identity.title",
    "description": "identity.description",
    "coupon_code": "redemption.coupon_code",
    "valid_until": "validity.valid_until",
    "evidence_data": "evidence_data",
    "contributing_sources": "contributing_sources",
}


def tier_rank(tier: Column) -> Column:
    """0 for S to 4 for D, also where written as "Tier S" or "tier-s"; 5 for none and unreadable ones."""
    letter = F.regexp_extract(F.upper(squeeze(tier)), r"^(?:TIER[\s_-]*)?([SABCD])$", 1)
    rank = F.lit(len(TIERS))
    for i, t in enumerate(TIERS):
        rank = F.when(letter == t, i).otherwise(rank)
    return rank


def local_micros(ts: Column) -> Column:
    """Microseconds of a naive timestamp since 1970, whatever the session's time zone."""
    seconds = (F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(ts)) * 3600 + F.minute(ts) * 60
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), ts) * 1000000).cast("long")


def usable_offer_fields() -> dict[str, Column]:
    """For each field, whether an offer's value can survive: no blank, filler or filler date, a list with a usable element."""
    text = lambda c: ~is_filler(F.col(c))
    until = F.col(FIELDS["valid_until"])
    return {
        "title": text(FIELDS["title"]),
        "description": text(FIELDS["description"]),
        "coupon_code": text(FIELDS["coupon_code"]),
        "valid_until": until.isNotNull() & ~until.cast("string").isin(*FILLER_DATES),
        "evidence_data": F.exists("evidence_data", lambda e: ~is_filler(e["evidence"])),
        "contributing_sources": F.exists("contributing_sources", lambda s: ~is_filler(s)),
    }


def judged(df: DataFrame, group: Column, record: Column, trust: Column, recency: Column, usable: dict[str, Column]) -> DataFrame:
    """(grp, id, trust, age, mask) of each row by which a record is judged; rows without a group or an id are left out.

    A null recency is the oldest.
    """
    mask = F.lit(0)
    for i, u in enumerate(usable.values()):
        mask = mask + F.when(u, 1 << i).otherwise(0)
    age = F.coalesce(-recency, F.lit((1 << 63) - 1))
    return df.select(group.alias("grp"), record.alias("id"), trust.alias("trust"), age.alias("age"), mask.alias("mask")).where("grp is not null and id is not null")


def candidates(rows: DataFrame) -> DataFrame:
    """(group, records): the records of each group of `judged` rows that can matter, best first.

    Of the records with the same usable fields and tier only the latest (then smallest id) can
    survive anywhere, and that one is found by a minimum that combines before the shuffle; so a group
    comes down to at most 2 ** fields * tiers records however many it holds. A record is
    struct(trust, age, id, mask); groups with fewer than two different ids are left out.
    """
    best = rows.groupBy("grp", "mask", "trust").agg(F.min(F.struct("age", "id")).alias("best"), F.min("id").alias("low"), F.max("id").alias("high"))
    return (
        best.groupBy("grp")
        .agg(F.array_sort(F.collect_list(F.struct("trust", F.col("best.age").alias("age"), F.col("best.id").alias("id"), "mask"))).alias("records"), F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low < high")
        .select("grp", "records")
    )


def with_layers(records: Column, by_count: bool = False) -> Column:
    """The records, which stand best first, with the dominance layer of each, from 1 on.

    A record that dominates another stands before it, so one pass in order gives each layer: one more
    than the highest among its dominators. Completeness is the set of usable fields, or how many they are.
    """
    empty = F.array().cast("array<struct<trust:int,age:bigint,id:string,mask:int,layer:int>>")

    def as_complete(a: Column, x: Column) -> Column:
        return F.bit_count(a) >= F.bit_count(x) if by_count else a.bitwiseAND(x) == x

    def add(seen: Column, x: Column) -> Column:
        over = F.filter(seen, lambda a: as_complete(a["mask"], x["mask"]) & ((a["age"] < x["age"]) | ((a["age"] == x["age"]) & (a["id"] <= x["id"]))))
        layer = 1 + F.coalesce(F.array_max(F.transform(over, lambda a: a["layer"])), F.lit(0))
        return F.concat(seen, F.array(F.struct(x["trust"].alias("trust"), x["age"].alias("age"), x["id"].alias("id"), x["mask"].alias("mask"), layer.alias("layer"))))

    return F.aggregate(records, empty, add)


def _count_layers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last, group, top = None, None, {}
    for b in batches:
        counts = Counter()
        for row in b.itertuples(index=False, name=None):
            if row == last:
                continue  # a copy
            last = row
            grp, _, _, trust, mask = row
            if grp != group:
                group, top = grp, {}
            layer = 1 + max((n for (m, t), n in top.items() if t <= trust and m & mask == mask), default=0)
            top[mask, trust] = layer  # the later of a class is dominated by the earlier, so it stands deeper
            counts[layer] += 1
        yield pd.DataFrame({"layer": list(counts), "n_records": list(counts.values())}, columns=["layer", "n_records"]).astype("int64")


def layer_sizes(rows: DataFrame) -> DataFrame:
    """(layer, n_records) of all `judged` records of all groups, those of a single id included; equal rows count once.

    Within a group the records are read from the latest on, so each stands behind all that dominate
    it; what is kept of them is the deepest layer of each (usable fields, tier), however many they are.
    A group is read by one task.
    """
    order = [F.col("grp"), F.col("age"), F.col("id"), F.col("trust"), F.desc("mask")]
    found = rows.select("grp", "age", "id", "trust", "mask").repartition("grp").sortWithinPartitions(*order).mapInPandas(_count_layers, "layer bigint, n_records bigint")
    return found.groupBy(F.col("layer").cast("int").alias("layer")).agg(F.sum("n_records").alias("n_records"))


def surviving_fields(groups: DataFrame, fields: list[str], by_count: bool = False) -> DataFrame:
    """(grp, field_name, id, layer) of the record whose value survives; no row if no record has one.

    A field's value is that of the first layer that has a usable one, and there of the best record by
    the policy. So a record in a later layer fills what no record of the layers before it has.
    """

    def pick(i: int, name: str) -> Column:
        have = F.filter("layered", lambda r: r["mask"].bitwiseAND(1 << i) != 0)
        best = F.array_min(F.transform(have, lambda r: F.struct(r["layer"].alias("layer"), r["trust"].alias("trust"), r["age"].alias("age"), r["id"].alias("id"))))
        return F.struct(F.lit(name).alias("field_name"), best.alias("best"))

    layered = groups.select("grp", with_layers(F.col("records"), by_count).alias("layered"))
    picks = F.array(*[pick(i, n) for i, n in enumerate(fields)])
    return layered.select("grp", F.inline(picks)).where("best is not null").select("grp", "field_name", F.col("best.id").alias("id"), F.col("best.layer").alias("layer"))


def layer_conflicts(groups: DataFrame, fields: list[str]) -> DataFrame:
    """(grp, field_name, by_policy, by_count, layer): where completeness as a count gives another record than the policy.

    There a less trusted record stands in an earlier layer because it holds more fields, not because
    it is better in this one. `layer` is the layer by count of the record taken.
    """
    count = surviving_fields(groups, fields, by_count=True).select("grp", "field_name", F.col("id").alias("by_count"), "layer")
    policy = surviving_fields(groups, fields).select("grp", "field_name", F.col("id").alias("by_policy"))
    return policy.join(count, ["grp", "field_name"]).where("by_policy <> by_count").select("grp", "field_name", "by_policy", "by_count", "layer")


def judged_offers(offers: DataFrame) -> DataFrame:
    return judged(
        offers, F.col("identity.canonical_offer_id"), F.col("identity.offer_id"), tier_rank(F.col("source_tier")).cast("int"), local_micros(F.col("last_verified_at")), usable_offer_fields()
    )


def offer_candidates(offers: DataFrame) -> DataFrame:
    return candidates(judged_offers(offers))


def offer_survivors(offers: DataFrame) -> DataFrame:
    """(canonical_offer_id, field_name, offer_id) of offers: the record whose value survives, by field."""
    found = surviving_fields(offer_candidates(offers), list(FIELDS))
    return found.select(F.col("grp").alias("canonical_offer_id"), "field_name", F.col("id").alias("offer_id"))


def surviving_offers(offers: DataFrame) -> DataFrame:
    """One record for each canonical_offer_id, built of the values that survive, null where none is usable."""
    usable = usable_offer_fields()
    values = [F.when(usable[f], F.col(p)).alias(f) for f, p in FIELDS.items()]
    rows = offers.select(F.col("identity.canonical_offer_id").alias("canonical_offer_id"), F.col("identity.offer_id").alias("offer_id"), tier_rank(F.col("source_tier")).alias("trust"), F.col("last_verified_at").alias("at"), *values)
    joined = offer_survivors(offers).join(rows, ["canonical_offer_id", "offer_id"])
    order = F.struct(-F.col("trust"), F.col("at"))  # an id may come in several versions
    picks = [F.max_by(F.when(F.col("field_name") == f, F.col(f)), F.when((F.col("field_name") == f) & F.col(f).isNotNull(), order)).alias(f) for f in FIELDS]
    return joined.groupBy("canonical_offer_id").agg(*picks)
