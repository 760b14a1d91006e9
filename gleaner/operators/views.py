"""Views of offers for people: flat rows for review, rows for a page, source rows, and one sentence for each offer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import short_number, whole_number

# The columns of the reviewer's table and where they stand in an offer.
REVIEW = {
    "offer_id": "identity.offer_id", "title": "identity.title", "issuer": "identity.issuer", "network": "identity.network", "merchant": "merchant.merchant_name", "category": "merchant.merchant_category",
    "benefit_type": "benefit.benefit_type", "benefit_nature": "benefit.benefit_nature", "discount_pct": "benefit.discount_percentage", "cashback_pct": "benefit.cashback", "reward_multiplier": "benefit.reward_multiplier",
    "flat_discount": "benefit.flat_discount", "max_benefit": "benefit.maximum_benefit", "min_spend": "eligibility.minimum_spend", "valid_from": "validity.valid_from", "valid_until": "validity.valid_until",
    "lifecycle": "lifecycle_status", "verification": "quality.verification_status", "confidence": "quality.confidence", "completeness": "quality.completeness", "needs_review": "quality.human_review_required",
    "source": "source_name", "tier": "source_tier", "source_url": "source_url",
}
REVIEW_COUNTS = {"card_ids_count": "eligibility.card_ids", "unmatched_slugs": "eligibility.unmatched_card_slugs"}

# The columns of a page's rows, and the lengths to which lists and texts are cut there.
PAGE = {
    "id": "identity.offer_id", "title": "identity.title", "desc": "identity.description", "issuer": "identity.issuer", "network": "identity.network", "grantor": "identity.grantor_scope", "merchant": "merchant.merchant_name",
    "cat": "merchant.merchant_category", "btype": "benefit.benefit_type", "bnature": "benefit.benefit_nature", "pct": "benefit.discount_percentage", "cb": "benefit.cashback", "mult": "benefit.reward_multiplier",
    "flat": "benefit.flat_discount", "cap": "benefit.maximum_benefit", "rate_type": "benefit.rate_type", "btext": "benefit.benefit_text", "min": "eligibility.minimum_spend", "txn": "eligibility.transaction_type",
    "from": "validity.valid_from", "until": "validity.valid_until", "life": "lifecycle_status", "vs": "quality.verification_status", "conf": "quality.confidence", "compl": "quality.completeness",
    "code": "redemption.coupon_code", "rtype": "redemption.redemption_type", "src": "source_name", "tier": "source_tier", "stype": "source_type", "url": "source_url", "durl": "detail_url", "method": "extraction_method",
}
PAGE_LISTS = {"cards": "eligibility.card_ids", "unmatched": "eligibility.unmatched_card_slugs", "review": "quality.review_reasons"}
PLACES, RULE_CHARS = 6, 400
SOURCE = ("key", "name", "url", "tier", "role", "source_type", "vendor", "issuer", "network")


def _given(path: str) -> Column:
    return F.coalesce(F.col(path), F.array().cast("array<string>"))


def review_rows(offers: DataFrame) -> DataFrame:
    """One flat row for each offer, lists as their lengths; null and empty lists count 0."""
    return offers.select(*[F.col(p).alias(n) for n, p in REVIEW.items()], *[F.coalesce(F.size(_given(p)), F.lit(0)).alias(n) for n, p in REVIEW_COUNTS.items()])


def page_rows(offers: DataFrame) -> DataFrame:
    """One row for each offer with what a page shows: at most PLACES places and how many there are, rules cut at RULE_CHARS, documents in short."""
    docs = F.transform(
        "eligibility.linked_eligibility_documents",
        lambda d: F.struct(d["document_type"].alias("t"), d["url"].alias("u"), F.coalesce(d["parsed"], F.lit(False)).alias("p"), d["entry_count"].alias("n")),
    )
    return offers.select(
        *[F.col(p).alias(n) for n, p in PAGE.items()], *[_given(p).alias(n) for n, p in PAGE_LISTS.items()],
        F.slice(_given("eligibility.location"), 1, PLACES).alias("loc"), F.size(_given("eligibility.location")).alias("loc_n"),
        F.transform(_given("eligibility.other_eligibility_rules"), lambda r: F.substring(r, 1, RULE_CHARS)).alias("rules"), docs.alias("docs"),
        F.coalesce(F.date_format("last_verified_at", "yyyy-MM-dd"), F.lit("")).alias("verified_at"), F.coalesce(F.size("evidence_data"), F.lit(0)).alias("ev_n"),
    )


def source_rows(sources: DataFrame) -> DataFrame:
    return sources.select(*SOURCE)


def description() -> Column:
    """A sentence from the structured fields of an offer: its benefit, merchant, grantor, least spend, cap and last day; no source text is repeated."""
    b = lambda f: F.col(f"benefit.{f}")
    rupees = lambda c: F.concat(F.lit("Rs "), whole_number(c))
    nature = F.lower(F.coalesce(F.nullif(b("benefit_nature"), F.lit("")), F.lit("offer")))
    measured = F.coalesce(
        F.concat(short_number(b("discount_percentage")), F.lit("% discount")), F.concat(short_number(b("cashback")), F.lit("% cashback")), F.concat(short_number(b("reward_multiplier")), F.lit("X reward points")),
        F.concat(rupees(b("flat_discount")), F.lit(" off")),
    )
    head = F.coalesce(measured, F.concat(F.lit("Up to "), rupees(b("maximum_benefit")), F.lit(" benefit")), F.concat(F.upper(F.substring(nature, 1, 1)), F.substring(nature, 2, 1000), F.lit(" offer")))
    named = lambda before, c, after="": F.when(c != "", F.concat(F.lit(before), c, F.lit(after)))
    parts = [
        head, named("at ", F.col("merchant.merchant_name")), named("for ", F.col("identity.grantor_name"), " cardholders"), F.concat(F.lit("on a minimum spend of "), rupees(F.col("eligibility.minimum_spend"))),
        F.when(measured.isNotNull(), F.concat(F.lit("capped at "), rupees(b("maximum_benefit")))), F.concat(F.lit("valid until "), F.col("validity.valid_until").cast("string")),
    ]
    return F.concat(F.concat_ws(" ", *parts), F.lit("."))
