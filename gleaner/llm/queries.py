"""Queries of the problems for language models; each runs over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import bpe, canonical, mixing, pairs, spans, survivors
from gleaner.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_offer_values(table(spark, d, "offers"), table(spark, d, "feed_rows"), table(spark, d, "merchants"), table(spark, d, "cards"))


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The report of typed values without an entry, by field and value."""
    return p1_found(spark, d).where(F.col("canonical_id") == canonical.UNMATCHED).groupBy("field_name", "raw_value").agg(F.count("*").alias("n_records"))


def p2_matches(spark: SparkSession, d: str) -> DataFrame:
    return pairs.match_offers(table(spark, d, "bank_offers"), table(spark, d, "partner_listings"), table(spark, d, "merchants"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_matches(spark, d).select("bank_offer_id", "listing_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.offer_survivors(table(spark, d, "offers"))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    return survivors.surviving_offers(table(spark, d, "offers"))


def p4_layers(spark: SparkSession, d: str) -> DataFrame:
    """How many records stand in each dominance layer, over all groups."""
    return survivors.layer_sizes(survivors.judged_offers(table(spark, d, "offers")))


def p4_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """By field and layer: how often the skyline by number of fields would give another record than the result asked for."""
    found = survivors.layer_conflicts(survivors.offer_candidates(table(spark, d, "offers")), list(survivors.FIELDS))
    return found.groupBy("field_name", "layer").agg(F.count("*").alias("n_fields"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(table(spark, d, "documents"), "doc_id", "text")


def p8_summary(spark: SparkSession, d: str) -> DataFrame:
    """Documents, characters and tokens by language and type."""
    docs = table(spark, d, "documents").select("lang", "doc_type", F.coalesce("n_chars", F.lit(0)).cast("long").alias("n_chars"), "text")
    return bpe.count_tokens(docs, "text", "n_tokens").groupBy("lang", "doc_type").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.sum("n_tokens").alias("n_tokens"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The largest mixture in which every target source that has text reaches its share."""
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), exact_shares=True)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares of that mixture, with the sources that no text can be found for."""
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), exact_shares=True)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_spans(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p1_found, p1_unmatched, p2_found, p2_matches, p4_found, p4_records, p4_layers, p4_conflicts, p8_ids, p8_summary, p9_mix, p9_shares, p10_found)}

# Written from the statement of the problem, not from the operator: what says that nothing is known, filler dates, tiers.
_NOTHING = "'-', '--', '---', '?', '??', '???', '.', 'n.a.', 'n.a', 'n/a', 'na', 'nil', 'none', 'not applicable', 'not available', 'not known', 'not specified', 'null', 'nan', 'tba', 'tbc', 'tbd', 'to be announced', 'to be confirmed', 'to be decided', 'to be updated', 'unknown', 'undefined', 'unspecified', 'xx', 'xxx'"
_NO_DATES = "'0001-01-01', '1900-01-01', '1970-01-01', '1999-12-31', '2099-12-31', '2999-12-31', '9999-12-31'"
_TIER = "list_position(['S', 'A', 'B', 'C', 'D'], regexp_replace(upper(source_tier), 'TIER|[^A-Z]', '', 'g'))"


def _good(path: str) -> str:
    return f"({path} IS NOT NULL AND lower(trim({path}, E' \\n\\t')) NOT IN ('', {_NOTHING}))"


_P4 = " UNION ALL ".join(
    f"SELECT identity.canonical_offer_id AS g, identity.offer_id AS i, source_tier, last_verified_at AS v, '{f}' AS f, {ok} AS ok FROM offers"
    for f, ok in {
        "title": _good("identity.title"),
        "description": _good("identity.description"),
        "coupon_code": _good("redemption.coupon_code"),
        "valid_until": f"(validity.valid_until IS NOT NULL AND CAST(validity.valid_until AS VARCHAR) NOT IN ({_NO_DATES}))",
        "evidence_data": f"len(list_filter(evidence_data, lambda e: {_good('e.evidence')})) > 0",
        "contributing_sources": f"len(list_filter(contributing_sources, lambda e: {_good('e')})) > 0",
    }.items()
)

ORACLE: dict[str, str] = {
    "p4_found": f"""
WITH r AS ({_P4}),
t AS (SELECT *, coalesce({_TIER}, 9) AS tier FROM r WHERE g IS NOT NULL AND i IS NOT NULL AND g IN (
  SELECT identity.canonical_offer_id FROM offers GROUP BY 1 HAVING count(DISTINCT identity.offer_id) > 1))
SELECT g AS canonical_offer_id, f AS field_name, i AS offer_id
FROM (SELECT *, row_number() OVER (PARTITION BY g, f ORDER BY tier, v DESC NULLS LAST, i) AS n FROM t WHERE ok) WHERE n = 1
""",
    # Every window of 160 characters of every text, compared as text.
    "p10_found": """
WITH w AS (SELECT doc_id, i, substr(text, i, 160) AS s FROM documents, unnest(range(1, length(text) - 158)) t(i) WHERE length(text) >= 160),
m AS (SELECT doc_id, i FROM w SEMI JOIN (SELECT s FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)) c ON w.s = c.s)
SELECT doc_id, CAST(sum(n) AS BIGINT) AS shared_chars FROM (SELECT doc_id, least(160, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 160)) AS n FROM m) GROUP BY doc_id""",
}
