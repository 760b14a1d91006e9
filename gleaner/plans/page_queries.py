"""Queries of the page operators, over pages made of the star schema: what is put into a page must be read out of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import text
from gleaner.html import extract as x
from gleaner.operators import records
from gleaner.sources.files import api_items, flattened
from gleaner.sources.tables import table

S = SparkSession


def _put(template: str, **values: Column) -> Column:
    """The template with each <<name>> replaced by a column."""
    out, rest = [], template
    while "<<" in rest:
        before, _, rest = rest.partition("<<")
        name, _, rest = rest.partition(">>")
        out += [F.lit(before), values[name].cast("string")]
    return F.concat(*out, F.lit(rest))


PAGE = """<html><head><title><<name>></title>
<script type="application/ld+json">[{"@type": ["Product", "Thing"], "sku": "<<key>>", "name": "<<name>>"}, {"@type": "Offer", "sku": "x"}]</script>
<script type="application/ld+json">{broken</script></head>
<body><article class="tile <<kind>>" id="p<<key>>"><h2>  <<name>>
</h2><p class="price">Rs <<price>> only</p><a href="/parts/<<key>> a?b=1">more</a><ul><li><<brand>><li>size <<size>></ul></article>
<article class="tile spare"><h2>spare of <<name>></h2><p class="price">Rs <<size>> only</p></article>
<table><caption> Facts </caption><tr><th>Field</th><th></th></tr><tr><td>brand</td><td><<brand>></td><td>extra</td></tr><tr><td></td></tr><tr><td>size</td><td><<size>></td></tr></table>
<table><tr><td>lonely</td></tr></table>
<script>var other = 5; const stock = {"n": <<size>>, "tags": ["a;}{", "<<brand>>"]}; let more = [1];</script>
<script id="__NEXT_DATA__" type="application/json">{"props": {"items": [{"k": <<key>>}]}}</script></body></html>"""


def part_pages(spark: S, d: str) -> DataFrame:
    """(p_partkey, html, base): a page for each part; every fifth is empty and every seventh has no tiles."""
    p = table(spark, d, "part")
    page = _put(PAGE, key=F.col("p_partkey"), name=F.col("p_name"), kind=F.lower("p_type"), price=F.col("p_retailprice"), brand=F.col("p_brand"), size=F.col("p_size"))
    bare = _put("<p>no <b><<name>></b></p>", name=F.col("p_name"))
    return p.select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, "").when(F.col("p_partkey") % 7 == 0, bare).otherwise(page).alias("html"), F.lit("https://shop.example/list/index.html").alias("base"))


RECORD = {
    "title": {"selector": "article.tile h2"}, "price": {"selector": "p.price", "regex": r"Rs ([\d.]+)"}, "href": {"selector": "article a[href]", "type": "attribute"}, "points": {"selector": "li", "type": "list"},
    "has_table": {"selector": "table", "type": "exists"}, "shown": {"selector": "b", "default": "none"}, "classes": {"selector": "article", "type": "class_list"},
}


def page_records(spark: S, d: str) -> DataFrame:
    """One record for each page by a mapping of rules."""
    r = x.extract(part_pages(spark, d), "html", ["p_partkey"], RECORD)
    return r.select("p_partkey", "title", "price", "href", F.array_join("points", "|").alias("points"), "has_table", "shown", F.array_join("classes", " ").alias("classes"))


def page_blocks(spark: S, d: str) -> DataFrame:
    """One record for each tile of a page."""
    return x.extract_all(part_pages(spark, d), "html", ["p_partkey"], "article.tile", {"title": {"selector": "h2"}, "price": {"selector": ".price", "regex": r"[\d.]+"}}).drop("_root_classes")


def page_roots(spark: S, d: str) -> DataFrame:
    """Records below the first root selector that matches."""
    return x.extract_first_root(part_pages(spark, d), "html", ["p_partkey"], ("section.tile", "article.nothing", "article.spare", "p b"), {"text": {"selector": "h2", "default": "-"}})


def page_tables(spark: S, d: str) -> DataFrame:
    """The cells of the tables of a page, by name."""
    t = x.tables(part_pages(spark, d), "html", ["p_partkey"])
    rows = t.select("p_partkey", "pos", "caption", F.posexplode("records").alias("row", "cells"))
    return rows.select("p_partkey", "pos", "caption", "row", F.inline("cells")).withColumnsRenamed({"name": "field"})


def page_jsonld(spark: S, d: str) -> DataFrame:
    """JSON-LD objects of one type."""
    j = x.jsonld(part_pages(spark, d), "html", ["p_partkey"], ["product"])
    return j.select("p_partkey", "pos", F.array_join("types", ",").alias("types"), text.json_path(F.col("body"), "sku").alias("sku"), text.json_path(F.col("body"), "name").alias("name"))


def page_embedded(spark: S, d: str) -> DataFrame:
    """Data embedded in scripts: an assigned literal, whole and by path, and a script by id."""
    spec = {"stock": {"variable": "stock"}, "tag": {"variable": "stock", "path": "tags[1]"}, "k": {"script_id": "__NEXT_DATA__", "path": "props.items[0].k"}, "gone": {"variable": "nothing"}}
    e = x.embedded(part_pages(spark, d), "html", ["p_partkey"], spec)
    return e.select("p_partkey", text.json_path(F.col("stock"), "n").alias("n"), text.json_path(F.col("stock"), "tags[0]").alias("first_tag"), F.get_json_object(F.concat(F.lit('{"v":'), F.col("tag"), F.lit("}")), "$.v").alias("tag"), F.col("k").cast("long").alias("k"), "gone")


def page_links(spark: S, d: str) -> DataFrame:
    """Links as absolute URLs."""
    r = x.extract(part_pages(spark, d), "html", ["p_partkey", "base"], {"href": {"selector": "a", "type": "attribute"}})
    return r.select("p_partkey", text.absolutise(F.col("href"), F.col("base")).alias("url"))


def page_fields(spark: S, d: str) -> DataFrame:
    """A column picked by its header, from cells in order."""
    t = x.tables(part_pages(spark, d), "html", ["p_partkey"]).select("p_partkey", F.posexplode("records").alias("row", "cells"))
    return t.select("p_partkey", "row", records.pick_column(F.col("cells"), r"(?i)^value|col_").alias("picked"))


def api_rows(spark: S, d: str) -> DataFrame:
    """The items of a list at a path of API bodies, one body for each nation and region."""
    n = table(spark, d, "nation")
    body = F.when(F.col("n_nationkey") % 6 == 0, "{no json").otherwise(F.to_json(F.struct(F.struct(F.array(F.struct(F.col("n_name").alias("name")), F.struct(F.lower("n_name").alias("name"))).alias("rows")).alias("result"))))
    items = api_items(n.select("n_nationkey", body.alias("body")), "body", "result.rows", ["n_nationkey"])
    return items.select("n_nationkey", "pos", F.try_variant_get("item", "$.name", "string").alias("name"))


def card_payload(spark: S, d: str) -> DataFrame:
    """A card master delivered as {metadata, data} in one document for each issuer, read back."""
    c = table(spark, d, "cards").distinct()
    one = F.struct(F.col("identity.card_id").alias("card_id"), F.col("product_family_id").alias("family"))
    bodies = c.groupBy(F.col("identity.issuer").alias("issuer")).agg(F.to_json(F.struct(F.struct(F.lit(1).alias("version")).alias("metadata"), F.collect_list(one).alias("data"))).alias("body"))
    items = api_items(bodies, "body", "data", ["issuer"])
    return items.select("issuer", F.try_variant_get("item", "$.card_id", "string").alias("card_id"), F.try_variant_get("item", "$.family", "string").alias("family"))


def flat_offers(spark: S, d: str) -> DataFrame:
    """Nested offers as flat columns with dotted names, lists as JSON."""
    o = table(spark, d, "offers").select("ingest_seq", F.struct("identity.offer_id", F.struct("validity.status", "validity.timezone").alias("v")).alias("a"), F.struct("eligibility.card_ids").alias("e")).distinct()
    return flattened(o).withColumnsRenamed({"a.offer_id": "a_offer_id", "a.v.status": "a_v_status", "a.v.timezone": "a_v_timezone", "e.card_ids": "e_card_ids"})


def entry_lines(spark: S, d: str) -> DataFrame:
    """The entry lines of a document: tidied, without noise and repetitions."""
    p = table(spark, d, "part")
    doc = _put("Page 1\n<<name>>,  Pune\r\n<<NAME>>, PUNE\nab\n---\n<<brand>> outlet\n\n", name=F.col("p_name"), NAME=F.upper("p_name"), brand=F.col("p_brand"))
    return p.select("p_partkey", F.posexplode(records.entry_lines(doc)).alias("pos", "entry"))


QUERIES = {f.__name__: f for f in (page_records, page_blocks, page_roots, page_tables, page_jsonld, page_embedded, page_links, page_fields, api_rows, card_payload, flat_offers, entry_lines)}

# The SQL says what was put into the pages: F holds the pages with tiles, B those without.
_FULL = "(SELECT *, CAST(p_retailprice AS VARCHAR) AS price FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0) f"
_BARE = "(SELECT * FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 = 0) b"

ORACLE = {
    "page_records": f"""
SELECT p_partkey, p_name AS title, price, '/parts/' || p_partkey || ' a?b=1' AS href, p_brand || ' size ' || p_size || '|size ' || p_size AS points, true AS has_table, 'none' AS shown, 'tile ' || lower(p_type) AS classes FROM {_FULL}
UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL, false, p_name, NULL FROM {_BARE}
UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL, false, 'none', NULL FROM part WHERE p_partkey % 5 = 0""",
    "page_blocks": f"SELECT p_partkey, 0 AS pos, p_name AS title, price FROM {_FULL} UNION ALL SELECT p_partkey, 1, 'spare of ' || p_name, CAST(p_size AS VARCHAR) FROM {_FULL}",
    "page_roots": f"SELECT p_partkey, 'article.spare' AS root, 0 AS pos, 'spare of ' || p_name AS text FROM {_FULL} UNION ALL SELECT p_partkey, 'p b', 0, '-' FROM {_BARE}",
    "page_tables": f"""
SELECT p_partkey, 0 AS pos, 'Facts' AS caption, r.row AS row, r.field AS field, r.value AS value FROM {_FULL}, LATERAL (
  SELECT * FROM (VALUES (0, 'Field', 'brand'), (0, 'col_1', p_brand), (0, 'col_2', 'extra'), (1, 'Field', 'size'), (1, 'col_1', CAST(p_size AS VARCHAR))) v(row, field, value)) r""",
    "page_jsonld": f"SELECT p_partkey, 0 AS pos, 'Product,Thing' AS types, CAST(p_partkey AS VARCHAR) AS sku, p_name AS name FROM {_FULL}",
    "page_embedded": f"""
SELECT p_partkey, CAST(p_size AS VARCHAR) AS n, 'a;}}{{' AS first_tag, p_brand AS tag, p_partkey AS k, CAST(NULL AS VARCHAR) AS gone FROM {_FULL}
UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 7 = 0""",
    "page_links": f"SELECT p_partkey, 'https://shop.example/parts/' || p_partkey || '%20a?b=1' AS url FROM {_FULL} UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 7 = 0",
    "page_fields": f"SELECT p_partkey, 0 AS row, p_brand AS picked FROM {_FULL} UNION ALL SELECT p_partkey, 1, CAST(p_size AS VARCHAR) FROM {_FULL}",
    "api_rows": "SELECT n_nationkey, 0 AS pos, n_name AS name FROM nation WHERE n_nationkey % 6 <> 0 UNION ALL SELECT n_nationkey, 1, lower(n_name) FROM nation WHERE n_nationkey % 6 <> 0",
    "card_payload": "SELECT DISTINCT identity.issuer AS issuer, identity.card_id AS card_id, product_family_id AS family FROM cards",
    "flat_offers": """
SELECT DISTINCT ingest_seq, identity.offer_id AS a_offer_id, validity.status AS a_v_status, validity.timezone AS a_v_timezone,
  CASE WHEN eligibility.card_ids IS NULL THEN NULL ELSE CAST(to_json(eligibility.card_ids) AS VARCHAR) END AS e_card_ids FROM offers""",
    "entry_lines": "SELECT p_partkey, 0 AS pos, p_name || ', Pune' AS entry FROM part UNION ALL SELECT p_partkey, 1, p_brand || ' outlet' FROM part",
}
