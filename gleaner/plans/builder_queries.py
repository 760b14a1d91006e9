"""Queries that build, link and report records, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.functions import classify, text
from gleaner.operators import cards, duplicates, merchants, quality, reconcile, records, views
from gleaner.plans import build
from gleaner.sources.tables import table

S = SparkSession


def duplicate_groups(spark: S, d: str) -> DataFrame:
    """Each row of a duplicate group: its size, its first row, whether it is redundant."""
    return duplicates.duplicate_rows(table(spark, d, "documents").select("doc_id", "text"), ["text"], "doc_id")


def duplicate_pairs(spark: S, d: str) -> DataFrame:
    """The same by a composite key and by an expression."""
    o = table(spark, d, "orders")
    a = duplicates.duplicate_rows(o, ["o_custkey", "o_orderstatus"], "o_orderkey").select(F.lit("columns").alias("by"), "*")
    b = duplicates.duplicate_rows(o, F.concat_ws("|", F.col("o_custkey") % 7, F.date_format("o_orderdate", "yyyy-MM-dd")), "o_orderkey").select(F.lit("expression").alias("by"), "*")
    return a.unionByName(b)


def typed_events(spark: S, d: str) -> DataFrame:
    """Types checked for each value of a VARIANT column and by the schema for the others."""
    v = F.try_variant_get(F.try_parse_json("props"), "$.k", "variant")
    e = table(spark, d, "events").select("event_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.parse_json(F.lit('"text"'))).otherwise(v).alias("v"))
    checked = quality.validate(e, quality.Rules(types={"v": "number", "event_type": "string", "event_id": "number"}, enums={"event_type": ("click", "view")}))
    return checked.select("event_id", "valid", F.array_join("errors", "; ").alias("errors"))


def offer_conditions(spark: S, d: str) -> DataFrame:
    """How many offers need review, are in conflict, have cards and have documents."""
    return quality.conditional_counts(
        table(spark, d, "offers"),
        {
            "needs_review": F.col("quality.human_review_required"), "conflicted": F.col("quality.conflict_status") == "CONFLICTED",
            "linked": F.size("eligibility.card_ids") > 0, "with_documents": F.size("eligibility.linked_eligibility_documents") > 0,
        },
    )


def document_outcomes(spark: S, d: str) -> DataFrame:
    """Linked documents by what came of them."""
    docs = table(spark, d, "offers").select(F.explode("eligibility.linked_eligibility_documents").alias("doc")).where("doc is not null")
    outcome = F.when(F.col("doc.parsed"), "parsed").when(F.col("doc.parse_error").isNotNull(), F.concat(F.lit("failed: "), F.col("doc.parse_error"))).otherwise("not parsed")
    return docs.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n_documents"), F.sum(F.coalesce("doc.entry_count", F.lit(0))).alias("n_entries"))


def issuer_cards(spark: S, d: str) -> DataFrame:
    """The card ids of each issuer."""
    c = table(spark, d, "cards").select(F.col("identity.issuer").alias("issuer"), F.col("identity.card_id").alias("card_id")).where("issuer is not null")
    return c.groupBy("issuer").agg(F.array_sort(F.collect_set("card_id")).alias("card_ids"))


def clean_mentions(spark: S, d: str) -> DataFrame:
    """Mentions of merchants in offers by their listed names, with a suffix that says nothing and the listed category where ingest_seq is odd."""
    m = table(spark, d, "merchants").select("merchant_id", F.col("merchant_name").alias("name"), "merchant_category")
    o = table(spark, d, "offers").select("ingest_seq", F.col("merchant.merchant_id").alias("merchant_id"), F.col("identity.issuer").alias("issuer")).distinct()
    suffix = F.when(F.col("ingest_seq") % 2 == 0, " Pvt Ltd").otherwise("")
    return o.join(m, "merchant_id").select(F.col("ingest_seq").alias("seq"), F.concat("name", suffix).alias("name"), F.when(F.col("ingest_seq") % 2 == 1, F.col("merchant_category")).alias("category"), "issuer")


def merchant_records(spark: S, d: str) -> DataFrame:
    """The merchant dimension: first name, first category given, number of names, partners."""
    return merchants.merchant_dimension(clean_mentions(spark, d)).drop("key")


def merchant_alias_rows(spark: S, d: str) -> DataFrame:
    return merchants.merchant_aliases(clean_mentions(spark, d)).select("key", "name")


def mentions_resolved(spark: S, d: str) -> DataFrame:
    """Each mention with its merchant and the category known by then."""
    m = clean_mentions(spark, d)
    return merchants.resolve_mentions(m, merchants.merchant_dimension(m)).distinct()


def partner_ranks(spark: S, d: str) -> DataFrame:
    """Merchants by number of partners, then by id."""
    m = merchants.merchant_dimension(clean_mentions(spark, d)).select("merchant_id", F.size("partners").alias("n_partners"))
    return m.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n_partners"), "merchant_id")))  # one row a merchant


def missing_partners(spark: S, d: str) -> DataFrame:
    m = clean_mentions(spark, d)
    return merchants.partnership_gaps(merchants.merchant_dimension(m), m.select("issuer").distinct())


def catalogue(spark: S, d: str) -> DataFrame:
    """A union in which the first table that has an id decides."""
    a = table(spark, d, "merchants").select(F.col("merchant_id").alias("id"), F.col("merchant_name").alias("name"), F.lit("list").alias("origin")).where(F.col("id") < "m_m")
    b = table(spark, d, "bank_offers").select(F.col("merchant_id").alias("id"), F.col("title").alias("name"), F.lit("bank").alias("origin"))
    c = table(spark, d, "partner_listings").select(F.col("merchant_id").alias("id"), F.col("title").alias("name"), F.lit("partner").alias("origin"))
    return records.priority_union([a, b, c], "id", "name").select("id", "origin")


def number_texts(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    share = F.col("o_orderkey") % 100 / F.lit(100.0)
    return o.select("o_orderkey", text.whole_number(F.col("o_totalprice")).alias("whole"), text.short_number(F.round(F.col("o_totalprice"), 1)).alias("short"), text.percent_text(share).alias("share"), F.bround(share, 1).alias("even"))


def parsed_orders(spark: S, d: str) -> DataFrame:
    """Fields through transforms; a failing value becomes null, a missing field is null, text that is not mapped is cleaned."""
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("  "), "o_orderpriority", F.lit("  ")).alias("o_orderpriority"), F.when(F.col("o_orderkey") % 2 == 0, "7").otherwise("x").alias("n"), "o_orderstatus")
    return records.parse_records(o, {"n": lambda c: c.try_cast("int"), "status": lambda c: c, "o_orderstatus": records.guarded(lambda s: {"F": "done", "O": "open"}[s])})


def record_ids(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    ref = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string"))
    return o.select("o_orderkey", records.record_id(F.lit("src"), ref, F.col("o_orderpriority")).alias("record_id"))


def evidence_rows(spark: S, d: str) -> DataFrame:
    """Evidence of a value: JSON text, source text cut at its limit."""
    o = table(spark, d, "orders")
    e = records.evidence("o_custkey", F.col("o_custkey"), F.repeat("o_orderpriority", 300), F.lit("https://x.example"), F.col("o_orderstatus") == "P")
    return o.select("o_orderkey", e.alias("e")).select("o_orderkey", "e.field", "e.value", F.char_length("e.evidence").alias("n_chars"), "e.source_url", "e.needs_review")


def validity_rows(spark: S, d: str) -> DataFrame:
    """Bounds with one evidence entry where either is known."""
    day = F.to_date("o_orderdate")
    k = F.col("o_orderkey") % 3
    o = records.with_validity(table(spark, d, "orders"), F.when(k == 0, day), F.when(k <= 1, F.date_add(day, 9)), F.lit("t"), F.lit("u"))
    return o.select("o_orderkey", "valid_from", "valid_until", F.size("evidence").alias("n_evidence"), F.get("evidence", F.lit(0))["value"].alias("value"))


def card_words(spark: S, d: str) -> DataFrame:
    return table(spark, d, "cards").select("identity.card_id", classify.card_tokens(F.col("identity.card_name")).alias("words")).distinct()


def offer_card_sets(spark: S, d: str) -> DataFrame:
    """Cards of offers that the master has, and those that it has not."""
    ids = table(spark, d, "cards").where("product_family_id is not null").select("identity.card_id").distinct().collect()  # the card master is fixed and small
    o = table(spark, d, "offers").select("ingest_seq", "eligibility.card_ids").distinct().where("card_ids is not null")
    listed = F.array(*[F.lit(r[0]) for r in ids if r[0] is not None]).cast("array<string>")
    return o.select("ingest_seq", F.size(F.array_intersect("card_ids", listed)).alias("n_known"), F.size(F.array_except("card_ids", listed)).alias("n_unknown"))


def card_links(spark: S, d: str) -> DataFrame:
    """How the slugs of cards and invented ones resolve: by slug, by words, by containment."""
    c = table(spark, d, "cards").select(F.col("identity.issuer").alias("issuer"), F.col("identity.card_name").alias("name"), F.col("identity.official_url").alias("url")).distinct()
    slug = F.regexp_extract("url", r"([^/]+?)(?:\.[A-Za-z0-9]+)?/*$", 1)
    words = F.array_sort(F.split(F.lower("name"), "[^A-Za-z0-9]+"))
    forms = F.array(F.struct(F.upper(slug).alias("slug")), F.struct(F.array_join(words, "-").alias("slug")), F.struct(F.array_join(F.slice(F.array_except(words, F.array(F.lit("credit"), F.lit("card"))), 1, 2), "-").alias("slug")), F.struct(F.concat(F.lit("none-"), "name").alias("slug")))
    asked = c.select("issuer", F.inline(forms)).where("slug <> ''").distinct()
    return cards.resolve_slugs(asked, table(spark, d, "cards")).select("slug", "issuer", F.array_join(F.array_sort("card_ids"), ",").alias("card_ids"), "step")


def merged_offers(spark: S, d: str) -> DataFrame:
    """Reconciliation: what kind of row comes out, the merged values and the conflicts."""
    r = reconcile.reconcile(table(spark, d, "offers"))
    return r.select("kind", "offer_id", "n_sources", *reconcile.MATERIAL, "conflict_status", F.array_join("conflict_fields", ",").alias("conflict_fields"))


def merged_coarse_offers(spark: S, d: str) -> DataFrame:
    """The same where many offers meet: without cards, last day and coupon, by the first letters of the merchant."""
    o = table(spark, d, "offers")
    none = {"eligibility.card_ids": F.lit(None).cast("array<string>"), "eligibility.unmatched_card_slugs": F.lit(None).cast("array<string>"), "validity.valid_until": F.lit(None).cast("date"), "redemption.coupon_code": F.lit(None).cast("string")}
    for path, value in {**none, "merchant.merchant_id": F.substring("merchant.merchant_id", 1, 4)}.items():
        o = records.set_path(o, path, value)
    r = reconcile.reconcile(o)
    return r.select("kind", "offer_id", "n_sources", *reconcile.MATERIAL, "conflict_status", F.array_join("conflict_fields", ",").alias("conflict_fields"))


def document_urls(spark: S, d: str) -> DataFrame:
    """Documents linked by offers, each distinct URL read once and joined back."""
    links = records.document_links(table(spark, d, "offers").distinct())
    return records.enrich(links, lambda urls: urls.select("url", F.sha2("url", 256).alias("content")))


def nested_updates(spark: S, d: str) -> DataFrame:
    o = records.set_path(table(spark, d, "offers").select("ingest_seq", "validity").distinct(), "validity.status", F.lower("validity.status"))
    return o.select("ingest_seq", "validity.status", "validity.timezone")


def sanitized_names(spark: S, d: str) -> DataFrame:
    p = table(spark, d, "part")
    dirty = F.concat(F.lit("  "), F.regexp_replace("p_name", " ", "\t \n"), F.lit("​ | "))
    return p.select("p_partkey", text.sanitize(dirty).alias("sane"), text.clean(dirty).alias("clean"), text.first_given(F.lit(" "), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")), F.col("p_type")).alias("given"))


def review_rows(spark: S, d: str) -> DataFrame:
    """The reviewer's flat rows."""
    return views.review_rows(table(spark, d, "offers")).distinct()


def page_rows(spark: S, d: str) -> DataFrame:
    """What a page shows of each offer; documents and lists as text."""
    r = views.page_rows(table(spark, d, "offers"))
    return r.select("id", "btype", "cap", "until", "loc_n", "verified_at", "ev_n", F.array_join("loc", "|").alias("loc"), F.array_join("rules", "|").alias("rules"), F.array_join(F.transform("docs", lambda x: F.concat_ws(",", x["t"], x["p"].cast("string"))), "|").alias("docs")).distinct()


def source_rows(spark: S, d: str) -> DataFrame:
    return views.source_rows(table(spark, d, "sources"))


def described_offers(spark: S, d: str) -> DataFrame:
    """A sentence for each offer from its structured fields."""
    return table(spark, d, "offers").select("ingest_seq", "identity.offer_id", views.description().alias("sentence")).distinct()


def build_report(spark: S, d: str) -> DataFrame:
    """The stages of a build and the rows that each leaves."""
    return build.report(spark, build.build(spark, d)).select("stage", "ok", "n_rows")


QUERIES = {
    f.__name__: f
    for f in (
        duplicate_groups, duplicate_pairs, typed_events, offer_conditions, document_outcomes, issuer_cards, merchant_records, merchant_alias_rows, mentions_resolved, partner_ranks, missing_partners, catalogue,
        number_texts, parsed_orders, record_ids, evidence_rows, validity_rows, card_words, offer_card_sets, card_links, merged_offers, merged_coarse_offers, document_urls, nested_updates, sanitized_names,
        review_rows, page_rows, source_rows, described_offers, build_report,
    )
}

_NOISE = r"\b(?:pvt|private|ltd|limited|india|indian|online|store|stores|shop|shopping|gift|vouchers?|e-?voucher|gift\s*cards?|offers?|deals?|com|in)\b"
_MENTIONS = f"""
WITH m AS (
  SELECT o.seq, mm.merchant_name || CASE WHEN seq % 2 = 0 THEN ' Pvt Ltd' ELSE '' END AS name, CASE WHEN seq % 2 = 1 THEN upper(mm.merchant_category) END AS c, o.issuer,
         trim(regexp_replace(regexp_replace(lower(mm.merchant_name), '{_NOISE}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS key
  FROM (SELECT DISTINCT ingest_seq AS seq, merchant.merchant_id AS mid, identity.issuer AS issuer FROM offers) o JOIN merchants mm ON mm.merchant_id = o.mid),
n AS (SELECT *, CASE WHEN c IN ('ELECTRONICS', 'FASHION', 'JEWELLERY', 'GROCERY', 'TRAVEL', 'DINING', 'HEALTH', 'ENTERTAINMENT', 'EDUCATION', 'FUEL', 'INSURANCE') THEN c WHEN c IS NOT NULL THEN 'OTHER' END AS category FROM m),
k AS (
  SELECT key, 'm_' || replace(key, ' ', '_') AS merchant_id, arg_min(name, seq) AS merchant_name, arg_min(category, seq) FILTER (category IS NOT NULL) AS merchant_category,
         min(seq) FILTER (category IS NOT NULL) AS category_seq, count(DISTINCT name) AS n_aliases, list_sort(list(DISTINCT issuer) FILTER (issuer IS NOT NULL)) AS partners FROM n GROUP BY key)
"""
_TOKENS = "list_sort(list_distinct(list_filter(string_split_regex(replace(lower({}), '+', ' plus '), '[^a-z0-9]+'), lambda w: w <> '' AND w NOT IN ('credit', 'card', 'cards', 'the', 'a', 'an', 'in', 'association', 'with', 'apply', 'for', 'online', 'bank', 'co', 'branded'))))"
_FIELDS = {
    "benefit_type": "benefit.benefit_type", "discount_percentage": "benefit.discount_percentage", "flat_discount": "benefit.flat_discount", "cashback": "benefit.cashback", "reward_multiplier": "benefit.reward_multiplier",
    "maximum_benefit": "benefit.maximum_benefit", "minimum_spend": "eligibility.minimum_spend", "valid_until": "validity.valid_until", "coupon_code": "redemption.coupon_code",
}
_EARLIER = "OVER (PARTITION BY g ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

ORACLE = {
    "duplicate_groups": "SELECT * FROM (SELECT doc_id, count(*) OVER w AS n_rows, min(doc_id) OVER w AS first_row, doc_id <> min(doc_id) OVER w AS redundant FROM documents WHERE text IS NOT NULL WINDOW w AS (PARTITION BY text)) WHERE n_rows > 1",
    "duplicate_pairs": """
SELECT * FROM (SELECT 'columns' AS by, o_orderkey, count(*) OVER w AS n_rows, min(o_orderkey) OVER w AS first_row, o_orderkey <> min(o_orderkey) OVER w AS redundant FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderstatus)
UNION ALL SELECT 'expression', o_orderkey, count(*) OVER w, min(o_orderkey) OVER w, o_orderkey <> min(o_orderkey) OVER w FROM orders WINDOW w AS (PARTITION BY o_custkey % 7, CAST(o_orderdate AS DATE))) WHERE n_rows > 1""",
    "typed_events": """
SELECT event_id, event_id % 3 <> 0 AND event_type IN ('click', 'view') AS valid,
  array_to_string(list_filter([CASE WHEN event_id % 3 = 0 THEN 'not number: v' END, CASE WHEN event_type NOT IN ('click', 'view') THEN 'not allowed: event_type=' || event_type END], lambda e: e IS NOT NULL), '; ') AS errors FROM events""",
    "offer_conditions": """
SELECT 'needs_review' AS name, count_if(quality.human_review_required) AS n FROM offers UNION ALL SELECT 'conflicted', count_if(quality.conflict_status = 'CONFLICTED') FROM offers
UNION ALL SELECT 'linked', count_if(len(eligibility.card_ids) > 0) FROM offers UNION ALL SELECT 'with_documents', count_if(len(eligibility.linked_eligibility_documents) > 0) FROM offers""",
    "document_outcomes": """
SELECT CASE WHEN doc.parsed THEN 'parsed' WHEN doc.parse_error IS NOT NULL THEN 'failed: ' || doc.parse_error ELSE 'not parsed' END AS outcome, count(*) AS n_documents, CAST(sum(coalesce(doc.entry_count, 0)) AS BIGINT) AS n_entries
FROM (SELECT unnest(eligibility.linked_eligibility_documents) AS doc FROM offers) WHERE doc IS NOT NULL GROUP BY 1""",
    "issuer_cards": "SELECT identity.issuer AS issuer, list_sort(list(DISTINCT identity.card_id)) AS card_ids FROM cards WHERE identity.issuer IS NOT NULL GROUP BY 1",
    "merchant_records": _MENTIONS + "SELECT merchant_id, merchant_name, merchant_category, category_seq, n_aliases, coalesce(partners, []) AS partners FROM k",
    "merchant_alias_rows": _MENTIONS + "SELECT DISTINCT key, name FROM n",
    "mentions_resolved": _MENTIONS + "SELECT DISTINCT n.seq, n.name, k.merchant_id, k.merchant_name, CASE WHEN k.category_seq <= n.seq THEN k.merchant_category END AS merchant_category FROM n JOIN k USING (key)",
    "partner_ranks": _MENTIONS + "SELECT merchant_id, coalesce(len(partners), 0) AS n_partners, row_number() OVER (ORDER BY coalesce(len(partners), 0) DESC, merchant_id) AS place FROM k",
    "missing_partners": _MENTIONS + """
SELECT merchant_id, merchant_name, partners AS known_partners, list_sort(list_filter(a.x, lambda i: NOT list_contains(partners, i))) AS missing_issuers
FROM k, (SELECT list(DISTINCT issuer) FILTER (issuer IS NOT NULL) AS x FROM n) a WHERE len(partners) >= 2 AND len(list_filter(a.x, lambda i: NOT list_contains(partners, i))) > 0""",
    "catalogue": """
SELECT id, arg_min(origin, p) AS origin FROM (
  SELECT merchant_id AS id, 'list' AS origin, 0 AS p FROM merchants WHERE merchant_id < 'm_m' UNION ALL SELECT merchant_id, 'bank', 1 FROM bank_offers UNION ALL SELECT merchant_id, 'partner', 2 FROM partner_listings) WHERE id IS NOT NULL GROUP BY id""",
    "number_texts": """
SELECT o_orderkey, format('{:,.0f}', o_totalprice) AS whole, regexp_replace(printf('%.4f', round(o_totalprice, 1)), '\\.?0+$', '') AS short, CAST(o_orderkey % 100 AS VARCHAR) || '%' AS share,
  CASE WHEN o_orderkey % 10 = 5 THEN CASE WHEN (o_orderkey % 100 // 10) % 2 = 0 THEN (o_orderkey % 100 // 10) / 10.0 ELSE (o_orderkey % 100 // 10 + 1) / 10.0 END ELSE round(o_orderkey % 100 / 100.0, 1) END AS even FROM orders""",
    "parsed_orders": "SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 7 END AS n, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' END AS o_orderstatus, CAST(NULL AS VARCHAR) AS status FROM orders",
    "record_ids": "SELECT o_orderkey, 'src__' || left(sha256('src' || '␟' || CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END || '␟' || o_orderpriority), 10) AS record_id FROM orders",
    "evidence_rows": "SELECT o_orderkey, 'o_custkey' AS field, CAST(o_custkey AS VARCHAR) AS value, least(2000, 300 * length(o_orderpriority)) AS n_chars, 'https://x.example' AS source_url, o_orderstatus = 'P' AS needs_review FROM orders",
    "validity_rows": """
SELECT o_orderkey, CASE WHEN k = 0 THEN a END AS valid_from, CASE WHEN k <= 1 THEN b END AS valid_until, CASE WHEN k <= 1 THEN 1 ELSE 0 END AS n_evidence,
  CASE WHEN k = 0 THEN '"' || a || ' to ' || b || '"' WHEN k = 1 THEN '"? to ' || b || '"' END AS value
FROM (SELECT o_orderkey, o_orderkey % 3 AS k, CAST(o_orderdate AS DATE) AS a, CAST(CAST(o_orderdate AS DATE) + INTERVAL 9 DAY AS DATE) AS b FROM orders)""",
    "card_words": f"SELECT DISTINCT identity.card_id AS card_id, {_TOKENS.format('identity.card_name')} AS words FROM cards",
    "offer_card_sets": """
WITH a AS (SELECT list(DISTINCT identity.card_id) AS x FROM cards WHERE product_family_id IS NOT NULL), o AS (SELECT DISTINCT ingest_seq, eligibility.card_ids AS c FROM offers WHERE eligibility.card_ids IS NOT NULL),
u AS (SELECT ingest_seq, unnest(list_distinct(c)) AS i FROM o), z AS (SELECT ingest_seq, max(CASE WHEN len(list_filter(c, lambda y: y IS NULL)) > 0 THEN 1 ELSE 0 END) AS nulls FROM o GROUP BY 1)
SELECT z.ingest_seq, count(*) FILTER (list_contains(a.x, u.i)) AS n_known, count(*) FILTER (u.i IS NOT NULL AND NOT list_contains(a.x, u.i)) + any_value(z.nulls) AS n_unknown FROM z LEFT JOIN u ON z.ingest_seq = u.ingest_seq, a GROUP BY 1""",
    "card_links": f"""
WITH c AS (SELECT DISTINCT identity.card_id AS id, identity.issuer AS issuer, identity.card_name AS name, lower(regexp_extract(identity.official_url, '([^/]+?)(?:\\.[A-Za-z0-9]+)?/*$', 1)) AS slug, {_TOKENS.format('identity.card_name')} AS t, list_sort(string_split_regex(lower(identity.card_name), '[^A-Za-z0-9]+')) AS w FROM cards),
a AS (SELECT DISTINCT issuer, slug, {_TOKENS.format('slug')} AS t FROM (
  SELECT issuer, upper(slug) AS slug FROM c UNION ALL SELECT issuer, array_to_string(w, '-') FROM c UNION ALL SELECT issuer, array_to_string(list_distinct_sorted[1:2], '-') FROM (SELECT issuer, list_sort(list_distinct(list_filter(w, lambda v: v NOT IN ('credit', 'card')))) AS list_distinct_sorted FROM c)
  UNION ALL SELECT issuer, 'none-' || name FROM c) WHERE slug <> ''),
s1 AS (SELECT a.slug, a.issuer, list_sort(list(DISTINCT c.id)) AS ids, 1 AS step FROM a JOIN c ON lower(a.slug) = c.slug GROUP BY 1, 2),
s2 AS (SELECT a.slug, a.issuer, list_sort(list(DISTINCT c.id)) AS ids, 2 AS step FROM a JOIN c ON len(a.t) > 0 AND a.t = c.t GROUP BY 1, 2),
s3 AS (SELECT a.slug, a.issuer, list_sort(list(DISTINCT c.id)) AS ids, 3 AS step FROM a JOIN c ON len(a.t) > 0 AND list_has_all(c.t, a.t) AND (c.issuer = a.issuer OR a.issuer IS NULL) GROUP BY 1, 2 HAVING count(DISTINCT c.id) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY slug, issuer ORDER BY step) AS n FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3))
SELECT slug, issuer, array_to_string(ids, ',') AS card_ids, step FROM r WHERE n = 1""",
    "merged_offers": f"""
WITH f AS (SELECT DISTINCT ingest_seq, identity.offer_id AS offer_id, identity.title AS title, coalesce(nullif(identity.issuer, ''), identity.network) AS mi, merchant.merchant_id AS mm, {', '.join(f'{p} AS {n}' for n, p in _FIELDS.items())},
  array_to_string(list_sort(list_filter(CASE WHEN len(eligibility.card_ids) > 0 THEN eligibility.card_ids WHEN len(eligibility.unmatched_card_slugs) > 0 THEN eligibility.unmatched_card_slugs ELSE [] END, lambda x: x IS NOT NULL)), ',') AS mc,
  source_url, source_tier, last_verified_at FROM offers),
e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(source_url, ''), coalesce(title, ''), discount_percentage, flat_discount, cashback, maximum_benefit, coalesce(coupon_code, '') ORDER BY ingest_seq) AS n1 FROM f) WHERE n1 = 1),
g AS (SELECT *, dense_rank() OVER (ORDER BY mm, mi, benefit_type, valid_until, coupon_code, mc) AS g, CASE source_tier WHEN 'S' THEN 5 WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'D' THEN 1 ELSE 0 END AS rk FROM e),
s AS (SELECT *, row_number() OVER (PARTITION BY g, source_url ORDER BY rk DESC, last_verified_at DESC NULLS LAST, ingest_seq) AS rep FROM g),
c AS (SELECT g, count(DISTINCT coalesce(source_url, '')) AS n_sources FROM s GROUP BY g),
r AS (SELECT s.*, n_sources, row_number() OVER (PARTITION BY s.g ORDER BY rk DESC, last_verified_at DESC NULLS LAST, ingest_seq) AS place FROM s JOIN c USING (g) WHERE n_sources > 1 AND rep = 1),
x AS (SELECT *, first_value(source_tier) OVER (PARTITION BY g ORDER BY place) AS top_tier, list_filter([{', '.join(f"CASE WHEN {n} <> first_value({n} IGNORE NULLS) {_EARLIER} THEN '{n}' END" for n in _FIELDS)}], lambda y: y IS NOT NULL) AS differ FROM r)
SELECT 'merged' AS kind, arg_min(offer_id, place) AS offer_id, any_value(n_sources) AS n_sources, {', '.join(f'arg_min({n}, place) FILTER ({n} IS NOT NULL) AS {n}' for n in _FIELDS)},
  arg_max(CASE WHEN source_tier IS NOT DISTINCT FROM top_tier THEN 'CONFLICTED' ELSE 'RESOLVED_BY_TIER' END, place) FILTER (len(differ) > 0) AS conflict_status,
  coalesce(array_to_string(arg_max(differ, place) FILTER (len(differ) > 0), ','), '') AS conflict_fields FROM x GROUP BY g
UNION ALL SELECT CASE WHEN n_sources = 1 THEN 'single' ELSE 'leftover' END, offer_id, n_sources, {', '.join(_FIELDS)}, NULL, '' FROM s JOIN c USING (g) WHERE n_sources = 1 OR rep > 1""",
    "document_urls": """
SELECT offer_id, pos, url, sha256(url) AS content FROM (
  SELECT identity.offer_id AS offer_id, generate_subscripts(eligibility.linked_eligibility_documents, 1) - 1 AS pos, trim(unnest(eligibility.linked_eligibility_documents).url) AS url FROM (SELECT DISTINCT * FROM offers)) WHERE url <> ''""",
    "nested_updates": "SELECT DISTINCT ingest_seq, lower(validity.status) AS status, validity.timezone AS timezone FROM offers",
    "sanitized_names": "SELECT p_partkey, p_name || ' |' AS sane, p_name AS clean, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_type END AS given FROM part",
    "review_rows": f"SELECT DISTINCT {', '.join(f'{p} AS {n}' for n, p in views.REVIEW.items())}, coalesce(len(eligibility.card_ids), 0) AS card_ids_count, coalesce(len(eligibility.unmatched_card_slugs), 0) AS unmatched_slugs FROM offers",
    "page_rows": """
SELECT DISTINCT identity.offer_id AS id, benefit.benefit_type AS btype, benefit.maximum_benefit AS cap, validity.valid_until AS until, coalesce(len(eligibility.location), 0) AS loc_n, coalesce(strftime(last_verified_at, '%Y-%m-%d'), '') AS verified_at,
  coalesce(len(evidence_data), 0) AS ev_n, coalesce(array_to_string(eligibility.location[1:6], '|'), '') AS loc, coalesce(array_to_string(list_transform(eligibility.other_eligibility_rules, lambda r: left(r, 400)), '|'), '') AS rules,
  array_to_string(list_transform(eligibility.linked_eligibility_documents, lambda x: concat_ws(',', x.document_type, CAST(coalesce(x.parsed, false) AS VARCHAR))), '|') AS docs FROM offers""",
    "source_rows": "SELECT key, name, url, tier, role, source_type, vendor, issuer, network FROM sources",
    "described_offers": """
WITH h AS (SELECT ingest_seq, identity.offer_id AS offer_id, merchant.merchant_name AS m, identity.grantor_name AS g, eligibility.minimum_spend AS s, benefit.maximum_benefit AS cap, validity.valid_until AS u,
  CASE WHEN benefit.discount_percentage IS NOT NULL THEN printf('%g', benefit.discount_percentage) || '% discount' WHEN benefit.cashback IS NOT NULL THEN printf('%g', benefit.cashback) || '% cashback'
    WHEN benefit.reward_multiplier IS NOT NULL THEN printf('%g', benefit.reward_multiplier) || 'X reward points' WHEN benefit.flat_discount IS NOT NULL THEN 'Rs ' || format('{:,.0f}', benefit.flat_discount) || ' off' END AS measured,
  lower(coalesce(nullif(benefit.benefit_nature, ''), 'offer')) AS nature FROM offers)
SELECT DISTINCT ingest_seq, offer_id, coalesce(measured, 'Up to Rs ' || format('{:,.0f}', cap) || ' benefit', upper(left(nature, 1)) || substr(nature, 2) || ' offer') || CASE WHEN m <> '' THEN ' at ' || m ELSE '' END || CASE WHEN g <> '' THEN ' for ' || g || ' cardholders' ELSE '' END
  || coalesce(' on a minimum spend of Rs ' || format('{:,.0f}', s), '') || CASE WHEN measured IS NOT NULL AND cap IS NOT NULL THEN ' capped at Rs ' || format('{:,.0f}', cap) ELSE '' END || coalesce(' valid until ' || u, '') || '.' AS sentence FROM h""",
}
ORACLE["build_report"] = f"""
SELECT 'extract' AS stage, true AS ok, count(*) AS n_rows FROM (SELECT DISTINCT * FROM offers) UNION ALL SELECT 'enrich', true, count(*) FROM (SELECT DISTINCT * FROM offers)
UNION ALL SELECT 'reconcile', true, count(*) FROM ({ORACLE["merged_offers"]}) UNION ALL SELECT 'validate', true, count(*) FROM ({ORACLE["merged_offers"]})"""
ORACLE["reconcile_report"] = f"SELECT kind, coalesce(conflict_status, 'NONE') AS conflict_status, count(*) AS n FROM ({ORACLE['merged_offers']}) GROUP BY 1, 2"
# Slugs as typed in offers: an issuer that no card has leaves the third step open to all cards.
ORACLE["linked_cards"] = f"""
WITH c AS (SELECT DISTINCT identity.card_id AS id, lower(identity.issuer) AS issuer, lower(regexp_extract(identity.official_url, '([^/?#]+?)(?:\\.[A-Za-z0-9]+)?/*(?:[?#].*)?$', 1)) AS slug, {_TOKENS.format('identity.card_name')} AS t FROM cards WHERE identity.card_id IS NOT NULL),
o AS (SELECT * FROM (SELECT identity.offer_id AS record_id, eligibility.issuer AS issuer, eligibility.unmatched_card_slugs AS slugs, row_number() OVER (PARTITION BY identity.offer_id ORDER BY ingest_seq) AS n FROM offers WHERE identity.offer_id IS NOT NULL) WHERE n = 1),
s AS (SELECT record_id, issuer, slug, min(pos) AS pos FROM (SELECT record_id, issuer, trim(unnest(slugs)) AS slug, generate_subscripts(slugs, 1) AS pos FROM o) WHERE slug <> '' GROUP BY 1, 2, 3),
a AS (SELECT *, {_TOKENS.format('slug')} AS t, issuer IS NULL OR lower(issuer) NOT IN (SELECT issuer FROM c WHERE issuer IS NOT NULL) AS anyone FROM (SELECT DISTINCT issuer, slug FROM s)),
m AS (
  SELECT a.issuer, a.slug, list(DISTINCT c.id) AS ids, 1 AS step FROM a JOIN c ON c.slug <> '' AND lower(a.slug) = c.slug GROUP BY 1, 2
  UNION ALL SELECT a.issuer, a.slug, list(DISTINCT c.id), 2 FROM a JOIN c ON len(a.t) > 0 AND a.t = c.t GROUP BY 1, 2
  UNION ALL SELECT a.issuer, a.slug, list(DISTINCT c.id), 3 FROM a JOIN c ON len(a.t) > 0 AND list_has_all(c.t, a.t) AND (a.anyone OR c.issuer = lower(a.issuer)) GROUP BY 1, 2 HAVING count(DISTINCT c.id) = 1),
r AS (SELECT issuer, slug, arg_min(ids, step) AS ids FROM m GROUP BY 1, 2),
j AS (SELECT s.record_id, s.slug, s.pos, r.ids FROM s LEFT JOIN r ON r.slug = s.slug AND r.issuer IS NOT DISTINCT FROM s.issuer),
l AS (SELECT record_id, list_sort(list_distinct(flatten(list(ids) FILTER (ids IS NOT NULL)))) AS card_ids, list(slug ORDER BY pos) FILTER (ids IS NULL) AS unmatched, round_even(count(ids) / count(*), 4) AS match_rate FROM j GROUP BY 1)
SELECT o.record_id, coalesce(l.card_ids, []) AS card_ids, coalesce(l.unmatched, []) AS unmatched, l.match_rate FROM o LEFT JOIN l USING (record_id)"""
_CARDS = ORACLE["merged_offers"].split("array_to_string(list_sort(")[1].split(" AS mc")[0]
ORACLE["merged_coarse_offers"] = (
    ORACLE["merged_offers"].replace("array_to_string(list_sort(" + _CARDS, "''").replace("merchant.merchant_id AS mm", "left(merchant.merchant_id, 4) AS mm")
    .replace("validity.valid_until AS valid_until", "CAST(NULL AS DATE) AS valid_until").replace("redemption.coupon_code AS coupon_code", "CAST(NULL AS VARCHAR) AS coupon_code")
)
