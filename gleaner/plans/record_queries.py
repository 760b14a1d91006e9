"""Queries of the record operators over the offer tables and the star schema, with their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import classify, text, values
from gleaner.operators import cards, duplicates, merchants, quality, reconcile
from gleaner.operators.duplicates import first_wins
from gleaner.sources.tables import table

S = SparkSession


# --- text to values --------------------------------------------------------------------------------


def benefit_texts(spark: S, d: str) -> DataFrame:
    return table(spark, d, "offers").select("ingest_seq", "identity.offer_id", F.col("benefit.benefit_text").alias("t")).distinct()


def parsed_benefits(spark: S, d: str) -> DataFrame:
    """Money, percentage, kind of rate, multiplier, cap and floor of each benefit text."""
    t = F.col("t")
    return benefit_texts(spark, d).select(
        "ingest_seq", values.money(t).alias("amount"), F.size(F.coalesce(values.all_money(t), F.array().cast("array<double>"))).alias("n_amounts"), values.percentage(t).alias("percentage"), values.rate_type(t).alias("rate_type"),
        values.reward_multiplier(t).alias("multiplier"), values.maximum_benefit(t).alias("cap"), values.minimum_spend(t).alias("floor"),
    )


def parsed_dates(spark: S, d: str) -> DataFrame:
    """Dates of orders in five written forms, read back."""
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    forms = F.array(*[F.date_format("day", f) for f in ("yyyy-MM-dd", "dd MMM yyyy", "MMMM d, yyyy", "dd/MM/yyyy")], F.concat(F.lit("Offer valid till "), F.date_format("day", "d"), F.lit("th "), F.date_format("day", "MMMM yyyy")))
    return o.select("o_orderkey", F.posexplode(forms).alias("form", "written")).select("o_orderkey", F.col("form").cast("long").alias("form"), values.date(F.col("written")).alias("read"))


def parsed_ranges(spark: S, d: str) -> DataFrame:
    """Ranges "d Mon - d Mon yyyy" of ten days from each order's date, read back."""
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a"), F.date_add(F.to_date("o_orderdate"), 9).alias("b"))
    r = values.date_range(F.concat(F.lit("Validity: "), F.date_format("a", "d MMM"), F.lit(" - "), F.date_format("b", "dd MMM yyyy")))
    return o.select("o_orderkey", r.alias("r")).select("o_orderkey", F.col("r.start").alias("first_day"), F.col("r.end").alias("last_day"))


def slugs_of_parts(spark: S, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.slugify(F.col("p_name")).alias("slug"), text.titleise(text.slugify(F.col("p_name"), "-")).alias("shown"))


def stable_hashes(spark: S, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select("c_custkey", text.stable_hash(F.col("c_name"), F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")), length=16).alias("h"))


def alias_keys(spark: S, d: str) -> DataFrame:
    m = table(spark, d, "merchants")
    return m.select("merchant_id", classify.alias_key(F.concat("merchant_name", F.lit(" Pvt Ltd"))).alias("key"), classify.category(F.col("merchant_category")).alias("category")).distinct()


def transaction_types(spark: S, d: str) -> DataFrame:
    f = table(spark, d, "feed_rows")
    return f.select("ingest_seq", classify.transaction_type(F.col("text"), F.col("isOnline")).alias("kind")).distinct()


def split_cities(spark: S, d: str) -> DataFrame:
    f = table(spark, d, "feed_rows").select("ingest_seq", "city").distinct()
    return f.select("ingest_seq", F.explode(text.split_list(F.col("city"))).alias("city"))


def json_paths(spark: S, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", text.json_path(F.col("props"), "k").try_cast("long").alias("k"), text.json_path(F.col("props"), "a.b[0]", "none").alias("miss"))


# --- quality, duplicates ---------------------------------------------------------------------------


def coverage_documents(spark: S, d: str) -> DataFrame:
    return quality.coverage(table(spark, d, "documents"))


def completeness_documents(spark: S, d: str) -> DataFrame:
    return quality.completeness_stats(table(spark, d, "documents"), ["text", "lang", "source", "merchant_id"])


def groups_by_lang(spark: S, d: str) -> DataFrame:
    return quality.group_counts(table(spark, d, "documents"), "lang")


DISTRIBUTIONS = {
    "issuer": "identity.issuer", "network": "identity.network", "tier": "source_tier", "verification": "quality.verification_status", "lifecycle": "lifecycle_status", "type": "benefit.benefit_type",
    "nature": "benefit.benefit_nature", "conflict": "quality.conflict_status", "status": "validity.status",
}


def offer_distributions(spark: S, d: str) -> DataFrame:
    return quality.distributions(table(spark, d, "offers"), DISTRIBUTIONS)


OFFER_RULES = quality.Rules(
    required=("identity.offer_id", "merchant.merchant_id"), non_empty=("identity.title",), enums={"source_tier": ("S", "A", "B", "C", "D")}, recommended=("benefit.benefit_text", "eligibility.card_ids")
)


def validation_offers(spark: S, d: str) -> DataFrame:
    return quality.validation_report(quality.validate(table(spark, d, "offers"), OFFER_RULES))


def duplicates_documents(spark: S, d: str) -> DataFrame:
    return duplicates.duplicate_report(table(spark, d, "documents").select("text"), ["text"])


def first_documents(spark: S, d: str) -> DataFrame:
    return first_wins(table(spark, d, "documents").select("doc_id", "text", "lang"), ["text"], "doc_id").select("doc_id", "lang")


def folded_orders(spark: S, d: str) -> DataFrame:
    """Orders of a customer merged: cents summed, the rest of the first by key."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", cents, "o_orderpriority")
    return duplicates.merge_rows(o, ["o_custkey"], "o_orderkey", {"cents": F.sum})


def union_of_sources(spark: S, d: str) -> DataFrame:
    """Offers of both feeds under one schema, columns missing on a side null."""
    b = table(spark, d, "bank_offers").select(F.lit("bank").alias("side"), F.col("bank_offer_id").alias("id"), "title", "minimum_spend")
    p = table(spark, d, "partner_listings").select(F.lit("partner").alias("side"), F.col("listing_id").alias("id"), "title", "city")
    return b.unionByName(p, allowMissingColumns=True).distinct()


# --- dimensions, joins, reconciliation --------------------------------------------------------------


def linked_cards(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "offers").select("ingest_seq", F.col("identity.offer_id").alias("record_id"), "eligibility.issuer", F.col("eligibility.unmatched_card_slugs").alias("slugs"))
    o = first_wins(o, ["record_id"], "ingest_seq").where("record_id is not null")
    return cards.link_cards(o.select("record_id", "issuer", "slugs"), table(spark, d, "cards"))


def card_families(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "offers").select(F.col("identity.offer_id").alias("record_id"), F.col("eligibility.card_ids").alias("card_ids"))
    return cards.families(o, table(spark, d, "cards"))


def offer_mentions(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "offers")
    return o.select(F.col("ingest_seq").alias("seq"), F.col("merchant.merchant_name").alias("name"), F.col("merchant.merchant_category").alias("category"), F.col("identity.issuer").alias("issuer")).distinct()


def merchant_dimension(spark: S, d: str) -> DataFrame:
    return merchants.merchant_dimension(offer_mentions(spark, d)).drop("key")


def merchant_mentions(spark: S, d: str) -> DataFrame:
    m = offer_mentions(spark, d)
    return merchants.resolve_mentions(m, merchants.merchant_dimension(m))


def partnership_gaps(spark: S, d: str) -> DataFrame:
    m = offer_mentions(spark, d)
    return merchants.partnership_gaps(merchants.merchant_dimension(m), m.select("issuer").distinct())


def exact_duplicates(spark: S, d: str) -> DataFrame:
    rows = reconcile.flat_offers(table(spark, d, "offers"))
    return reconcile.drop_exact(rows).groupBy("source_url").agg(F.count("*").alias("n_kept"))


def reconciled_offers(spark: S, d: str) -> DataFrame:
    return reconcile.reconcile(table(spark, d, "offers"))


def reconcile_report(spark: S, d: str) -> DataFrame:
    return reconcile.reconcile_report(reconciled_offers(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        parsed_benefits, parsed_dates, parsed_ranges, slugs_of_parts, stable_hashes, alias_keys, transaction_types, split_cities, json_paths,
        coverage_documents, completeness_documents, groups_by_lang, offer_distributions, validation_offers, duplicates_documents, first_documents, folded_orders, union_of_sources,
        linked_cards, card_families, merchant_dimension, merchant_mentions, partnership_gaps, exact_duplicates, reconciled_offers, reconcile_report,
    )
}

_PREFIX = r"(?i)(?:₹|Rs\.?|INR)\s*(\d[\d,]*(?:\.\d+)?)\s*(lakh|lakhs|lac|cr|crore|k)?\b"
_SUFFIX = r"(?i)(\d[\d,]*(?:\.\d+)?)\s*(?:(?:₹|Rs\.?|INR)|/-)"
_AMT = r"((?:₹|Rs\.?|INR)\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:lakh|lakhs|lac|k))?)"


def _money(t: str) -> str:
    n = f"try_cast(replace(nullif(regexp_extract({t}, '{_PREFIX}', 1), ''), ',', '') AS DOUBLE)"
    w = f"CASE lower(regexp_extract({t}, '{_PREFIX}', 2)) WHEN 'k' THEN 1e3 WHEN 'lakh' THEN 1e5 WHEN 'lakhs' THEN 1e5 WHEN 'lac' THEN 1e5 WHEN 'cr' THEN 1e7 WHEN 'crore' THEN 1e7 ELSE 1 END"
    return f"round(coalesce({n} * {w}, try_cast(replace(nullif(regexp_extract({t}, '{_SUFFIX}', 1), ''), ',', '') AS DOUBLE)), 2)"


def _first(t: str, *patterns: str) -> str:
    found = [_money(f"nullif(regexp_extract({t}, '{p}', 1), '')") for p in patterns]
    return f"coalesce({', '.join(found)})"


_FILLED = {"doc_id": "doc_id IS NOT NULL", "text": "trim(text) <> ''", "lang": "trim(lang) <> ''", "source": "trim(source) <> ''", "n_chars": "n_chars IS NOT NULL", "doc_type": "trim(doc_type) <> ''", "merchant_id": "trim(merchant_id) <> ''", "fetched_at": "fetched_at IS NOT NULL"}
_PCT = r"(\d[\d,]*(?:\.\d+)?)\s*%"
_DOCS4 = " + ".join(f"CASE WHEN {_FILLED[c]} THEN 1 ELSE 0 END" for c in ("text", "lang", "source", "merchant_id"))
_DAY = "CAST(o_orderdate AS DATE)"

ORACLE = {
    "parsed_benefits": f"""
SELECT ingest_seq, {_money("t")} AS amount, coalesce(len(regexp_extract_all(t, '{_PREFIX}')), 0) AS n_amounts,
  CASE WHEN try_cast(replace(nullif(regexp_extract(t, '{_PCT}', 1), ''), ',', '') AS DOUBLE) BETWEEN 0 AND 100 THEN try_cast(replace(nullif(regexp_extract(t, '{_PCT}', 1), ''), ',', '') AS DOUBLE) END AS percentage,
  CASE WHEN regexp_matches(t, '\\d\\s*%') THEN CASE WHEN regexp_matches(split_part(t, regexp_extract(t, '{_PCT}'), 1), '(?i)(up\\s*to|as\\s*much\\s*as|max(imum)?(\\s*of)?)\\s*$') THEN 'UP_TO' ELSE 'EXACT' END END AS rate_type,
  CASE WHEN try_cast(nullif(regexp_extract(t, '(?i)\\b(\\d+(?:\\.\\d+)?)\\s*x\\b', 1), '') AS DOUBLE) BETWEEN 1 AND 200 THEN try_cast(nullif(regexp_extract(t, '(?i)\\b(\\d+(?:\\.\\d+)?)\\s*x\\b', 1), '') AS DOUBLE) END AS multiplier,
  {_first("t", r"(?i)max(?:imum)?\.?\s*(?:discount|cashback|benefit|savings?)?\s*[:\-]?\s*(?:of\s*)?" + _AMT, r"(?i)up\s*to\s*" + _AMT, r"(?i)capped?\s*at\s*" + _AMT)} AS cap,
  {_first("t", r"(?i)min(?:imum)?\.?\s*(?:tra?n?s?a?c?t?i?o?n?|trxn|txn|spend|purchase|booking|order|cart|bill)?\s*(?:value|amount|size)?\s*[:\-]?\s*(?:of\s*)?" + _AMT)} AS floor
FROM (SELECT DISTINCT ingest_seq, identity.offer_id, benefit.benefit_text AS t FROM offers)""",
    "parsed_dates": f"SELECT o_orderkey, form, {_DAY} AS read FROM orders, range(5) r(form)",
    "parsed_ranges": f"SELECT o_orderkey, {_DAY} AS first_day, CAST({_DAY} + INTERVAL 9 DAY AS DATE) AS last_day FROM orders",
    "stable_hashes": "SELECT c_custkey, left(sha256(c_name || '␟' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE coalesce(c_mktsegment, '') END), 16) AS h FROM customer",
    "slugs_of_parts": """
SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug,
  array_to_string(list_transform(string_split(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-'), '-'), lambda w: upper(w[1]) || w[2:]), ' ') AS shown FROM part""",
    "alias_keys": """
SELECT DISTINCT merchant_id, trim(regexp_replace(regexp_replace(lower(merchant_name || ' Pvt Ltd'), '\\b(?:pvt|private|ltd|limited|india|indian|online|store|stores|shop|shopping|gift|vouchers?|e-?voucher|gift\\s*cards?|offers?|deals?|com|in)\\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS key,
  CASE lower(merchant_category) WHEN 'electronics' THEN 'ELECTRONICS' WHEN 'fashion' THEN 'FASHION' WHEN 'jewellery' THEN 'JEWELLERY' WHEN 'grocery' THEN 'GROCERY' WHEN 'travel' THEN 'TRAVEL' WHEN 'dining' THEN 'DINING' WHEN 'health' THEN 'HEALTH' WHEN 'entertainment' THEN 'ENTERTAINMENT' WHEN NULL THEN NULL ELSE 'OTHER' END AS category FROM merchants""",
    "transaction_types": """
SELECT DISTINCT ingest_seq, CASE WHEN regexp_matches(text, '(?i)\\bemi\\b') THEN 'EMI_ONLY' WHEN regexp_matches(text, '(?i)\\bupi\\b') THEN 'UPI_ONLY' WHEN upper(isOnline) IN ('Y', 'YES', 'TRUE', 'ONLINE') THEN 'ONLINE' WHEN upper(isOnline) IN ('N', 'NO', 'FALSE', 'OFFLINE') THEN 'OFFLINE'
  WHEN regexp_matches(text, '(?i)\\bin[- ]*store\\b|\\boffline\\b|\\bat\\s*(?:the\\s*)?outlet') THEN 'OFFLINE' WHEN regexp_matches(text, '(?i)\\bonline\\b|\\bwebsite\\b|\\bapp\\b') THEN 'ONLINE' END AS kind FROM feed_rows""",
    "json_paths": "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, 'none' AS miss FROM events",
    "split_cities": "SELECT ingest_seq, trim(unnest(string_split_regex(city, '[,;|]'))) AS city FROM (SELECT DISTINCT ingest_seq, city FROM feed_rows WHERE city IS NOT NULL)",
    "coverage_documents": " UNION ALL ".join(f"SELECT '{c}' AS field, count_if({ok}) AS n, count(*) AS total, count_if({ok}) || '/' || count(*) AS coverage FROM documents" for c, ok in _FILLED.items()),
    "completeness_documents": f"SELECT count(*) AS n_rows, round(avg(s), 4) AS mean, min(s) AS lowest, max(s) AS highest, count_if(s < 0.5) AS below_half FROM (SELECT ({_DOCS4}) / 4.0 AS s FROM documents)",
    "groups_by_lang": "SELECT coalesce(lang, 'None') AS value, count(*) AS n FROM documents GROUP BY 1",
    "offer_distributions": " UNION ALL ".join(
        f"SELECT '{n}' AS field, coalesce({p}, 'None') AS value, count(*) AS n FROM offers GROUP BY 2" for n, p in DISTRIBUTIONS.items()
    ),
    "validation_offers": """
SELECT count(*) AS n_rows, count_if(ok) AS n_valid, count_if(NOT ok) AS n_invalid, count_if(warned) AS n_warned FROM (
  SELECT identity.offer_id IS NOT NULL AND merchant.merchant_id IS NOT NULL AND (identity.title IS NULL OR trim(identity.title) <> '') AND (source_tier IS NULL OR source_tier IN ('S', 'A', 'B', 'C', 'D')) AS ok,
         trim(coalesce(benefit.benefit_text, '')) = '' OR coalesce(len(eligibility.card_ids), 0) = 0 AS warned FROM offers)""",
    "duplicates_documents": "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count_if(text IS NOT NULL AND n > 1) AS n_groups, CAST(coalesce(sum(n - 1) FILTER (text IS NOT NULL), 0) AS BIGINT) AS n_redundant, CAST(coalesce(sum(n) FILTER (text IS NULL), 0) AS BIGINT) AS n_unkeyed FROM (SELECT text, count(*) AS n FROM documents GROUP BY 1)",
    "first_documents": "SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1 OR text IS NULL",
    "folded_orders": "SELECT o_custkey, min(o_orderkey) AS o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1",
    "union_of_sources": "SELECT DISTINCT 'bank' AS side, bank_offer_id AS id, title, minimum_spend, CAST(NULL AS VARCHAR) AS city FROM bank_offers UNION ALL SELECT DISTINCT 'partner', listing_id, title, NULL, city FROM partner_listings",
    "card_families": """
SELECT record_id, list_sort(list(DISTINCT c.product_family_id)) AS families
FROM (SELECT identity.offer_id AS record_id, unnest(eligibility.card_ids) AS card_id FROM offers) o JOIN cards c ON c.identity.card_id = o.card_id WHERE c.product_family_id IS NOT NULL GROUP BY 1""",
    "exact_duplicates": """
SELECT source_url, count(*) AS n_kept FROM (SELECT DISTINCT source_url, coalesce(identity.title, '') AS a, benefit.discount_percentage, benefit.flat_discount, benefit.cashback, benefit.maximum_benefit, coalesce(redemption.coupon_code, '') AS b FROM offers) GROUP BY 1""",
}
