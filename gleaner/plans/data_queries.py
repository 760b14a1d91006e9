"""Queries of the general data problems; each runs over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import nested, orphans, snapshots, units
from gleaner.sources.tables import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return units.offer_quantities(table(spark, d, "offers"), table(spark, d, "sources"))


def p3_beyond(spark: SparkSession, d: str) -> DataFrame:
    """The report of stated amounts that no BIGINT can hold."""
    return units.quantities_beyond(table(spark, d, "offers"), table(spark, d, "sources"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.raw_children(table(spark, d, "raw_records"))


def p5_keys(spark: SparkSession, d: str) -> DataFrame:
    """Every child table of raw_records with surrogate keys: rows, parents and distinct keys of each."""
    raw = table(spark, d, "raw_records").select("record_id", "payload").distinct()
    wrappers, levels = nested.raw_layout(raw)
    rows = nested.child_rows(nested.parse_objects(raw, "payload", wrappers, nested.MARKS), ["record_id"], levels, nested.TABLES)
    return rows.groupBy("child_table").agg(F.count("*").alias("n_rows"), F.countDistinct("parent_key").alias("n_parents"), F.countDistinct("child_key").alias("n_keys"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.offer_changes(table(spark, d, "offer_snapshots"))


def p6_summary(spark: SparkSession, d: str) -> DataFrame:
    return p6_found(spark, d).groupBy("snapshot_date", "change_kind").agg(F.count("*").alias("n_offers"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.card_orphans(table(spark, d, "offers"), table(spark, d, "bank_offers"), table(spark, d, "cards"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(p7_found(spark, d))


def p7_integer_runs(spark: SparkSession, d: str) -> DataFrame:
    """Order keys of lineitem that no order of status 'F' has, with their lines: the operator on integer keys."""
    parents = table(spark, d, "orders").where("o_orderstatus = 'F'")
    return orphans.integer_orphans(table(spark, d, "lineitem"), "l_orderkey", parents, "o_orderkey")


QUERIES = {f.__name__: f for f in (p3_found, p3_beyond, p5_found, p5_keys, p6_found, p6_summary, p7_found, p7_report, p7_integer_runs)}

_DAY = """coalesce(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%Y-%m-%dT%H:%M:%S'), try_strptime(v, '%d/%m/%Y'), try_strptime(v, '%Y%m%d'), try_strptime(v, '%d-%b-%Y'), try_strptime(v, '%d %B %Y'))"""

_P6 = f"""
WITH n AS (
  SELECT snapshot_date AS d, lower(regexp_replace(offer_id, '\\s', '', 'g')) AS k, loaded_at,
         CASE WHEN trim(coalesce(lifecycle_status, '')) = '' THEN 'UNKNOWN' ELSE upper(trim(lifecycle_status)) END AS s,
         CASE WHEN lower(trim(valid_until)) IN ('', '-', 'n/a') THEN NULL ELSE trim(valid_until) END AS v
  FROM offer_snapshots WHERE offer_id IS NOT NULL),
l AS (
  SELECT d, k, s, CAST({_DAY} AS DATE) AS u, dense_rank() OVER (ORDER BY d) AS i
  FROM (SELECT *, row_number() OVER (PARTITION BY k, d ORDER BY loaded_at DESC NULLS LAST, s DESC, v DESC NULLS LAST) AS r FROM n) WHERE r = 1),
dates AS (SELECT DISTINCT d, i FROM l),
cases AS (
  SELECT b.d, b.k, 'added' AS kind FROM l b LEFT JOIN l a ON a.k = b.k AND a.i = b.i - 1 WHERE b.i > 1 AND a.k IS NULL
  UNION ALL
  SELECT t.d, a.k, 'removed' FROM l a JOIN dates t ON t.i = a.i + 1 LEFT JOIN l b ON b.k = a.k AND b.i = t.i WHERE b.k IS NULL
  UNION ALL
  SELECT b.d, b.k, 'changed' FROM l b JOIN l a ON a.k = b.k AND a.i = b.i - 1 WHERE a.s <> b.s OR a.u IS DISTINCT FROM b.u)
"""

_KEY = "nullif(regexp_replace(lower(trim(regexp_replace({}, '\\s+', ' ', 'g'))), '[\\s_-]+', '_', 'g'), '')"

_P7 = f"""
WITH refs AS (
  SELECT 'offers' AS t, identity.offer_id AS id, extracted_at AS ts, 'card_ids' AS f, unnest(eligibility.card_ids) AS raw FROM offers
  UNION ALL SELECT 'offers', identity.offer_id, extracted_at, 'unmatched_card_slugs', unnest(eligibility.unmatched_card_slugs) FROM offers
  UNION ALL SELECT 'bank_offers', bank_offer_id, extracted_at, 'card_ids', unnest(card_ids) FROM bank_offers),
r AS (SELECT t, id, ts, f, {_KEY.format("raw")} AS k FROM refs),
c AS (
  SELECT 'card_ids' AS f, {_KEY.format("identity.card_id")} AS k, listed_at, retired_at FROM cards
  UNION ALL
  SELECT 'unmatched_card_slugs', {_KEY.format("regexp_replace(regexp_extract(identity.official_url, '([^/]+)/*$', 1), '\\.[A-Za-z0-9]+$', '')")}, listed_at, retired_at FROM cards),
j AS (
  SELECT r.t, r.id, r.ts, r.f, r.k, count(c.k) AS n,
         count_if(c.k IS NOT NULL AND (c.listed_at IS NULL OR c.listed_at <= r.ts) AND (c.retired_at IS NULL OR c.retired_at > r.ts)) AS live,
         count_if(c.retired_at <= r.ts) AS gone
  FROM r LEFT JOIN c ON c.f = r.f AND c.k = r.k WHERE r.k IS NOT NULL GROUP BY ALL),
o AS (
  SELECT DISTINCT t AS table_name, coalesce(strftime(ts, '%Y-%m'), 'unknown') AS period, id AS record_id, f AS field_name, k AS reference,
         CASE WHEN n = 0 THEN 'missing' WHEN gone > 0 THEN 'deleted' ELSE 'arrives_later' END AS reason
  FROM j WHERE n = 0 OR (ts IS NOT NULL AND live = 0))
"""



def _list(v: str) -> str:
    """A JSON value as a JSON list: a list as it is, JSON text as what it holds, anything else as the only entry, null as no entry."""
    text = f"({v} ->> '$')"
    inside = f"(json_type({v}) = 'VARCHAR' AND regexp_matches({text}, '^\\s*[\\[{{]') AND json_valid({text}))"
    return f"CASE WHEN {v} IS NULL OR json_type({v}) = 'NULL' THEN '[]'::JSON WHEN json_type({v}) = 'ARRAY' THEN {v} WHEN {inside} THEN CASE json_type({text}::JSON) WHEN 'ARRAY' THEN {text}::JSON ELSE ('[' || {text} || ']')::JSON END ELSE ('[' || {v} || ']')::JSON END"


def _is_record(v: str) -> str:
    return f"(json_type({v}) = 'OBJECT' AND (({v} -> 'evidence_data') IS NOT NULL OR ({v} -> 'eligibility') IS NOT NULL OR ({v} -> 'identity') IS NOT NULL))"


def _entries(source: str, keep: str, v: str) -> str:
    """(record_id, keep, pos, v) of the entries of a list."""
    return f"SELECT record_id, {keep} parent_pos, CAST(i AS BIGINT) AS pos, json_extract(a, '$[' || i || ']') AS v FROM (SELECT record_id, {keep} parent_pos, {_list(v)} AS a FROM {source}), unnest(range(CAST(json_array_length(a) AS BIGINT))) t(i)"


_ITEM = "CASE WHEN json_type(v) = 'VARCHAR' THEN v ->> '$' ELSE CAST(v AS VARCHAR) END"
_P5 = f"""
WITH o AS (SELECT DISTINCT record_id, CASE WHEN json_valid(payload) AND json_type(payload) = 'OBJECT' THEN payload::JSON END AS j FROM raw_records),
u AS (SELECT record_id, -1 AS parent_pos, CASE WHEN {_is_record("j")} THEN j WHEN {_is_record("(j -> 'offer')")} THEN j -> 'offer' WHEN {_is_record("(j -> 'data')")} THEN j -> 'data' WHEN {_is_record("(j -> 'data' -> 'offer')")} THEN j -> 'data' -> 'offer' ELSE j END AS r FROM o),
e AS ({_entries("u WHERE r IS NOT NULL", "", "(r -> 'evidence_data')")}),
d AS ({_entries("u WHERE r IS NOT NULL", "", "(r -> 'eligibility' -> 'linked_eligibility_documents')")}),
c AS (
  SELECT record_id, 'evidence_data' AS child_table, parent_pos, pos, v, coalesce(v ->> 'field', '') AS item FROM e
  UNION ALL SELECT record_id, 'linked_eligibility_documents', parent_pos, pos, v, coalesce(v ->> 'url', '') FROM d
  UNION ALL SELECT record_id, 'other_eligibility_rules', parent_pos, pos, v, {_ITEM} FROM ({_entries("u WHERE r IS NOT NULL", "", "(r -> 'eligibility' -> 'other_eligibility_rules')")})
  UNION ALL SELECT record_id, 'entries_sample', parent_pos, pos, v, {_ITEM} FROM ({_entries("(SELECT record_id, pos AS parent_pos, v AS w FROM d WHERE json_type(v) = 'OBJECT')", "", "(w -> 'entries_sample')")})
  UNION ALL SELECT record_id, 'evidence_value', parent_pos, pos, v, {_ITEM} FROM ({_entries("(SELECT record_id, pos AS parent_pos, v AS w FROM e WHERE json_type(v -> 'value') = 'ARRAY')", "", "(w -> 'value')")}))
SELECT DISTINCT record_id, child_table, CAST(parent_pos AS BIGINT) AS parent_pos, pos, item FROM c WHERE json_type(v) <> 'NULL'
UNION ALL SELECT DISTINCT record_id, 'rejected', -1, -1, '' FROM u WHERE r IS NULL
"""

ORACLE = {
    "p5_found": _P5,
    "p6_found": _P6 + "SELECT DISTINCT strftime(d, '%Y-%m-%d') AS snapshot_date, k AS offer_id, kind AS change_kind FROM cases",
    "p6_summary": _P6 + "SELECT strftime(d, '%Y-%m-%d') AS snapshot_date, kind AS change_kind, count(*) AS n_offers FROM cases GROUP BY 1, 2",
    "p7_found": _P7 + "SELECT * FROM o",
    "p7_report": _P7
    + "SELECT table_name, period, field_name, reason, count(*) AS n_references, count(DISTINCT record_id) AS n_records, count(DISTINCT reference) AS n_keys FROM o GROUP BY 1, 2, 3, 4",
    "p7_integer_runs": "SELECT l_orderkey AS reference, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1",
}
