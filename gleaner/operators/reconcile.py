"""Records of several sources reconciled into one: exact duplicates dropped, the rest merged by source precedence.

Groups are formed by a match key; the best record of each source represents it, the others are
passed on. Representatives are merged from the most trusted down: a field takes the first value that
is not null, evidence is united, and differing values are kept as conflicts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.duplicates import first_wins

# Ranks of the source tiers.
TIER_RANK = {"S": 5, "A": 4, "B": 3, "C": 2, "D": 1}

#: The fields on which sources may disagree.
MATERIAL = ("benefit_type", "discount_percentage", "flat_discount", "cashback", "reward_multiplier", "maximum_benefit", "minimum_spend", "valid_until", "coupon_code")
EXACT = ("source_url", "title", "discount_percentage", "flat_discount", "cashback", "maximum_benefit", "coupon_code")


def flat_offers(offers: DataFrame) -> DataFrame:
    """The columns of an offer that reconciliation reads, equal rows once."""
    return offers.select(
        "ingest_seq", "identity.offer_id", "identity.title", "identity.issuer", "identity.network", "merchant.merchant_id",
        "benefit.benefit_type", "benefit.discount_percentage", "benefit.flat_discount", "benefit.cashback", "benefit.reward_multiplier", "benefit.maximum_benefit",
        "eligibility.minimum_spend", "eligibility.card_ids", "eligibility.unmatched_card_slugs", "validity.valid_until", "redemption.coupon_code",
        "source_name", "source_url", "source_tier", "last_verified_at", "evidence_data", "contributing_sources",
    ).distinct()


def tier_rank(tier: Column) -> Column:
    out = F.lit(0)
    for t, r in TIER_RANK.items():
        out = F.when(tier == t, r).otherwise(out)
    return out


def match_parts() -> list[Column]:
    """The parts of the match key: merchant, issuer or network, benefit type, last day, coupon and the sorted cards."""
    given = lambda c: F.when(F.size(c) > 0, F.col(c))
    cards = F.coalesce(given("card_ids"), given("unmatched_card_slugs"), F.array().cast("array<string>"))
    issuer = F.coalesce(F.nullif("issuer", F.lit("")), F.col("network"))
    return [F.col("merchant_id").alias("m_merchant"), issuer.alias("m_issuer"), F.col("benefit_type").alias("m_type"), F.col("valid_until").alias("m_until"), F.col("coupon_code").alias("m_coupon"), F.array_join(F.array_sort(F.filter(cards, lambda c: c.isNotNull())), ",").alias("m_cards")]


KEY = ("m_merchant", "m_issuer", "m_type", "m_until", "m_coupon", "m_cards")


def drop_exact(rows: DataFrame) -> DataFrame:
    """Pass 1: of rows of one source with the same title and figures, the first by ingest_seq."""
    key = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"x_{c}") for c in EXACT]
    marked = rows.select("*", *key)
    return first_wins(marked, [f"x_{c}" for c in EXACT], "ingest_seq").select(*rows.columns)


def _merge(reps: Column, fields: Sequence[str]) -> Column:
    """The fold of representatives, which stand in order of rank; each later one fills nulls and may conflict."""
    none = F.array().cast("array<string>")
    sources = lambda r: F.coalesce(r["contributing_sources"], F.array(r["source_name"]))
    first = reps[0]
    start = F.struct(
        *[first[f].alias(f) for f in fields], sources(first).alias("sources"), F.coalesce(first["evidence_data"], F.filter(first["evidence_data"], lambda e: F.lit(False))).alias("evidence"),
        F.lit(None).cast("string").alias("conflict_status"), none.alias("conflict_fields"), first["source_tier"].alias("tier"),
    )

    def step(acc: Column, r: Column) -> Column:
        differ = F.array_compact(F.array(*[F.when(acc[f].isNotNull() & r[f].isNotNull() & (acc[f] != r[f]), F.lit(f)) for f in fields]))
        status = F.when(acc["tier"].eqNullSafe(r["source_tier"]), "CONFLICTED").otherwise("RESOLVED_BY_TIER")
        fresh = F.filter(F.coalesce(r["evidence_data"], F.array().cast(r_type)), lambda e: ~F.exists(F.coalesce(acc["evidence"], F.array().cast(r_type)), lambda w: w["field"].eqNullSafe(e["field"]) & w["source_url"].eqNullSafe(e["source_url"])))
        return F.struct(
            *[F.coalesce(acc[f], r[f]).alias(f) for f in fields],
            F.array_distinct(F.concat(acc["sources"], sources(r))).alias("sources"),
            F.concat(F.coalesce(acc["evidence"], F.array().cast(r_type)), fresh).alias("evidence"),
            F.when(F.size(differ) > 0, status).otherwise(acc["conflict_status"]).alias("conflict_status"),
            F.when(F.size(differ) > 0, differ).otherwise(acc["conflict_fields"]).alias("conflict_fields"),
            acc["tier"].alias("tier"),
        )

    r_type = "array<struct<field:string,value:string,evidence:string,source_url:string,needs_review:boolean,review_reason:string>>"
    return F.aggregate(F.slice(reps, F.lit(2), F.size(reps)), start, step)


def reconcile(offers: DataFrame) -> DataFrame:
    """Pass 2 over the rows that pass 1 leaves: one row for each offer that comes out.

    kind: 'single' (its group has one source), 'merged' (the representatives of several sources) or
    'leftover' (a further row of a source in a merged group). Nulls are equal in a match key. The
    best row of each source and the number of sources are found by aggregates that combine before the
    shuffle, so a group with very many rows of a source stays cheap; a fold sees one row for each
    source of its group, and sources are few.
    """
    rows = drop_exact(flat_offers(offers)).select("*", *match_parts(), tier_rank(F.col("source_tier")).alias("rank"))
    own = [c for c in rows.columns if c not in KEY]
    order = F.struct(F.col("rank"), F.coalesce(F.col("last_verified_at").cast("string"), F.lit("")), -F.col("ingest_seq"))
    best = rows.groupBy(*KEY, "source_url").agg(F.max_by(F.struct(*own), order).alias("rep"), F.max(order).alias("order"))
    groups = best.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("order", "rep")), lambda a, b: F.when(a["order"] > b["order"], -1).when(a["order"] < b["order"], 1).otherwise(0)).alias("reps"), F.count("*").alias("n_sources"))
    merged = groups.where("n_sources > 1").withColumn("reps", F.transform("reps", lambda r: r["rep"]))
    top = F.col("reps")[0]
    fold = _merge(F.col("reps"), MATERIAL)
    out = merged.select(F.lit("merged").alias("kind"), top["offer_id"].alias("offer_id"), top["source_name"].alias("source_name"), "n_sources", fold.alias("f")).select(
        "kind", "offer_id", "source_name", "n_sources", *[F.col(f"f.{c}").alias(c) for c in MATERIAL], F.filter("f.sources", lambda s: s.isNotNull()).alias("contributing_sources"), F.size(F.coalesce("f.evidence", F.array().cast("array<struct<field:string,value:string,evidence:string,source_url:string,needs_review:boolean,review_reason:string>>"))).alias("n_evidence"), "f.conflict_status", "f.conflict_fields",
    )
    sized = groups.select(*[F.col(k).alias(f"g_{k}") for k in KEY], "n_sources", F.transform("reps", lambda r: r["rep"]["ingest_seq"]).alias("rep_seqs"))
    same = [F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in KEY]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    others = rows.join(sized, cond).where((F.col("n_sources") == 1) | ~F.array_contains("rep_seqs", F.col("ingest_seq")))
    single = others.select(
        F.when(F.col("n_sources") == 1, "single").otherwise("leftover").alias("kind"), "offer_id", "source_name", "n_sources", *MATERIAL,
        F.coalesce("contributing_sources", F.array().cast("array<string>")).alias("contributing_sources"), F.coalesce(F.size("evidence_data"), F.lit(0)).alias("n_evidence"), F.lit(None).cast("string").alias("conflict_status"), F.array().cast("array<string>").alias("conflict_fields"),
    )
    return out.unionByName(single)


def reconcile_report(reconciled: DataFrame) -> DataFrame:
    """(kind, conflict_status, n) of a reconciled table."""
    return reconciled.groupBy("kind", F.coalesce("conflict_status", F.lit("NONE")).alias("conflict_status")).agg(F.count("*").alias("n"))
