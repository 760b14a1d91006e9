"""The operators of the general data problems on small fixtures, edge cases and the given tables."""

import datetime as dt
import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from gleaner.operators import nested, orphans, snapshots, units
from gleaner.plans import data_queries

SNAP = "snapshot_date date, offer_id string, lifecycle_status string, valid_until string, loaded_at timestamp_ntz, offer_id_2 string"
D = [dt.date(2025, 1, 1), dt.date(2025, 2, 1), dt.date(2025, 3, 1)]


def snap(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SNAP)


def cases(df):
    return {tuple(r) for r in df.collect()}


def test_snapshot_cases(spark):
    t = dt.datetime(2025, 1, 1)
    later = dt.datetime(2025, 6, 1)
    rows = [
        (D[0], "a", "ACTIVE", "2025-12-31", t),
        (D[1], " A ", "active ", "31/12/2025", t),  # the same in other writing
        (D[2], "a", "EXPIRED", "20251231", t),
        (D[0], "b", None, None, t),
        (D[1], "b", "UNKNOWN", "N/A", t),  # a missing status is UNKNOWN, a filler date none
        (D[0], "c", "ACTIVE", "01-Jan-2026", t),
        (D[2], "c", "ACTIVE", "01-Jan-2026", t),
        (D[1], "d", "ACTIVE", "2025-05-05", t),
        (D[1], "d", "ACTIVE", "2025-05-06", later),  # delivered again
        (D[2], "d", "ACTIVE", "6 May 2025", None),
        (D[2], "d", "ACTIVE", "6 May 2025", None),
        (None, "e", "ACTIVE", None, t),
        (D[1], None, "ACTIVE", None, t),
        (D[1], "  ", "ACTIVE", None, t),
    ]
    assert cases(snapshots.offer_changes(snap(spark, rows))) == {
        ("2025-03-01", "a", "changed"), ("2025-03-01", "b", "removed"), ("2025-02-01", "c", "removed"), ("2025-03-01", "c", "added"), ("2025-02-01", "d", "added"),
    }


def test_snapshots_empty(spark):
    assert snapshots.offer_changes(snap(spark, [])).count() == 0


@pytest.mark.parametrize("written", ["2025-03-04", "2025-03-04T00:00:00", "04/03/2025", "20250304", "04-Mar-2025", "4 March 2025", "4th Mar 2025", "March 4, 2025"])
def test_date_cells(spark, written):
    from pyspark.sql import functions as F

    from gleaner.functions.dates import parse_date_cell

    assert spark.range(1).select(parse_date_cell(F.lit(written))).first()[0] == dt.date(2025, 3, 4)


def test_integer_runs_against_brute_force(spark):
    rnd = random.Random(3)
    for bits in (2, 20):
        parents = [rnd.randrange(-200, 400) for _ in range(300)] + [None]
        refs = [rnd.randrange(-250, 450) for _ in range(500)] + [None]
        p, r = spark.createDataFrame([(x,) for x in parents], "id long"), spark.createDataFrame([(x,) for x in refs], "id long")
        want = {x: refs.count(x) for x in refs if x is not None and x not in parents}
        assert {x["reference"]: x["n"] for x in orphans.integer_orphans(r, "id", p, "id", bits).collect()} == want
    none = spark.createDataFrame([], "id long")
    assert orphans.integer_orphans(none, "id", none, "id").count() == 0
    assert orphans.integer_orphans(spark.createDataFrame([(1,)], "id long"), "id", none, "id").count() == 1


def test_runs_compress(spark):
    keys = spark.createDataFrame([(x,) for x in [*range(10, 20), 25, 26, 40]], "key long")
    runs = {(r["run_start"], r["run_end"]) for r in orphans.parent_runs(keys, "key", [], 20).collect()}
    assert runs == {(10, 19), (25, 26), (40, 40)}


def test_runs_of_text_keys_compress(spark, data):
    """On the given cards and offers: far fewer runs than cards; with runs of one key each the same, without runs all are orphans."""
    table = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    refs, parents = orphans.card_references(table("offers"), table("bank_offers")), orphans.card_lifetimes(table("cards")).withColumnsRenamed({"kind": "field_name", "key": "reference"})
    names = ["field_name", "reference"]
    keys = orphans.ranked_keys(refs, parents, names)
    runs = orphans.parent_runs(keys.where("is_parent = 1").select("key"), "key", [], orphans.RANK_BITS)
    n_orphans, n_parents = keys.where("is_parent = 0").count(), keys.where("is_parent = 1").count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert runs.count() <= n_orphans + parts and runs.count() < n_parents / 2
    want = {tuple(r) for r in refs.select(*names).distinct().join(parents.select(*names), names).collect()}
    assert {tuple(r) for r in orphans.known_references(refs, parents, names).collect()} == want
    assert orphans.match_references(keys.where("is_ref = 1").select("key", *names), runs.limit(0), "key", orphans.RANK_BITS, []).where("hit is not null").count() == 0


def test_card_orphans(spark):
    ident = "identity struct<card_id:string,issuer:string,official_url:string,card_name:string,product_family:string,personal_business:string>, product_family_id string, listed_at timestamp_ntz, retired_at timestamp_ntz"
    y = lambda n: dt.datetime(n, 1, 1)
    card = lambda i, url=None, a=None, b=None: ((i, "x", url, i, None, None), "f", a, b)
    cards = spark.createDataFrame([card("a_b", "https://x/y/a-slug.page", y(2020), y(2024)), card("new", None, y(2026)), card("free")], ident)
    offers = spark.createDataFrame(
        [(("o1",), (["A-B ", "free", None, " ", "zz"], ["a slug", "gone"]), y(2024)), (("o2",), (["new", "a_b"], None), y(2023)), (("o3",), (["new", "nope"], []), None)],
        "identity struct<offer_id:string>, eligibility struct<card_ids:array<string>,unmatched_card_slugs:array<string>>, extracted_at timestamp_ntz",
    )
    bank = spark.createDataFrame([("b1", ["A  B", "zz"], y(2025))], "bank_offer_id string, card_ids array<string>, extracted_at timestamp_ntz")
    assert cases(orphans.card_orphans(offers, bank, cards)) == {
        ("offers", "2024-01", "o1", "card_ids", "a_b", "deleted"), ("offers", "2024-01", "o1", "card_ids", "zz", "missing"),
        ("offers", "2024-01", "o1", "unmatched_card_slugs", "a_slug", "deleted"), ("offers", "2024-01", "o1", "unmatched_card_slugs", "gone", "missing"),
        ("offers", "2023-01", "o2", "card_ids", "new", "arrives_later"), ("offers", "unknown", "o3", "card_ids", "nope", "missing"),
        ("bank_offers", "2025-01", "b1", "card_ids", "a_b", "deleted"), ("bank_offers", "2025-01", "b1", "card_ids", "zz", "missing"),
    }


def raw(spark, payloads):
    return spark.createDataFrame([(f"r{i}", p, "clash") for i, p in enumerate(payloads)], "record_id string, payload string, pos string")


def test_nested_forms(spark):
    ev = [{"field": "f0", "value": ["x", None, 3]}, None, {"field": "f2", "value": "plain"}]
    docs = {"url": "u", "entries_sample": json.dumps(["p", None, "q"])}
    good = {"evidence_data": ev, "eligibility": {"linked_eligibility_documents": docs, "other_eligibility_rules": "one"}}
    payloads = [json.dumps(good), json.dumps({"offer": good}), json.dumps({"data": {"offer": good, "version": 2}}), "{", None, "[1]", "{'offer': 1}", "", "{}", json.dumps({"evidence_data": json.dumps(ev)})]
    got = cases(nested.raw_children(raw(spark, payloads)))
    one = {("evidence_data", -1, 0, "f0"), ("evidence_data", -1, 2, "f2"), ("evidence_value", 0, 0, "x"), ("evidence_value", 0, 2, "3")}
    rest = {("linked_eligibility_documents", -1, 0, "u"), ("entries_sample", 0, 0, "p"), ("entries_sample", 0, 2, "q"), ("other_eligibility_rules", -1, 0, "one")}
    want = {(f"r{i}", *x) for i in range(3) for x in one | rest} | {("r9", *x) for x in one} | {(f"r{i}", "rejected", -1, -1, "") for i in (3, 4, 5, 6, 7)}
    assert got == want


def test_nested_infers_unknown_lists(spark):
    df = nested.parse_objects(raw(spark, ['{"a": [{"b": [1, 2], "c`d": [3]}]}', '{"a": {"b": 5}}']), "payload")
    levels = nested.levels_of(nested.merged_schema(df, "record"))
    rows = nested.child_rows(df, ["record_id"], levels).selectExpr("record_id", "child_table", "parent_pos", "pos", "parent_key", "child_key").collect()
    assert {tuple(r)[:4] for r in rows} == {("r0", "a", -1, 0), ("r0", "b", 0, 0), ("r0", "b", 0, 1), ("r0", "c`d", 0, 0), ("r1", "a", -1, 0), ("r1", "b", 0, 0)}
    parents = {r["child_key"] for r in rows if r["child_table"] == "a"}
    assert {r["parent_key"] for r in rows if r["child_table"] != "a"} <= parents


def test_nested_schema_decides(spark, monkeypatch):
    """Where records and lists stand comes from the inferred schema: wrappers of any name and depth, lists in any place; without the schema there are no rows."""
    ev = [{"field": "f0", "value": ["x"]}]
    deep = {"a": {"envelope": {"what ever": {"evidence_data": json.dumps(ev), "more": {"other_eligibility_rules": "r"}}}}}
    df = raw(spark, [json.dumps({"evidence_data": ev}), json.dumps(deep), json.dumps({"x": {"y": 1}})])
    one = {("evidence_data", -1, 0, "f0"), ("evidence_value", 0, 0, "x")}
    assert cases(nested.raw_children(df)) == {("r0", *x) for x in one} | {("r1", *x) for x in one | {("other_eligibility_rules", -1, 0, "r")}}
    # A list inside JSON text only.
    text = raw(spark, [json.dumps({"evidence_data": json.dumps(ev)})])
    assert cases(nested.raw_children(text)) == {("r0", *x) for x in one}
    monkeypatch.setattr(nested, "merged_schema", lambda df, value: {})
    assert nested.raw_children(df).count() == 0


def test_nested_empty(spark):
    assert nested.raw_children(raw(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("text", "number", "currency", "source", "cap", "rate"),
    [
        ("20% off, up to Rs 1,500", 9.0, "paise", "INR", 150000, None),
        ("Up to 10% off", 0.0015, "lakh", "INR", 15000, None),
        ("Up to 10X reward points", 75.0, "INR thousand", "INR", 7500000, None),
        ("Save 5 percent, limit of 5 lac rupees per month", None, None, None, 50000000, None),
        ("ceiling ₹१,५०,००० a quarter", None, None, None, 15000000, None),
        ("not exceeding 12500000 paise", None, None, None, 12500000, None),
        ("(cap two hundred rupees) for orders of Rs 2,500 and above", None, None, None, 20000, None),
        ("maximum benefit fifteen hundred rupees per card", None, None, None, 150000, None),
        ("max 500 points", 500.0, None, "INR", None, None),
        ("capped at 75/-", None, None, None, 7500, None),
        ("capped at 75", None, None, "paise", 75, None),
        ("cap as per card variant", None, "INR", "INR", None, None),
        ("Min. Trxn: Rs 2,000", 3.0, None, "Rs '000", 300000, None),
        ("33 reward points / Rs 150", None, None, None, None, 22000),
        ("0.05 reward points on each Re 1", None, None, None, None, 5000),
        ("0.01 points per rupee", None, None, None, None, 1000),
        ("for each 1000 rupees you get 70 points", None, None, None, None, 7000),
        ("10X reward points (base 110 per Rs 1000)", None, None, None, None, 110000),
        ("10x points over the usual 36 points per ₹150", None, None, None, None, 240000),
        ("80 pts for every Rs 1k spent", None, None, None, None, 8000),
        (None, None, None, None, None, None),
        ("", float("nan"), "", "", None, None),
        ("x" * 100000, 5.0, "p", None, 5, None),
    ],
)
def test_quantities(text, number, currency, source, cap, rate):
    assert units.quantities_of(text, number, currency, source) == (cap, rate)


@pytest.mark.parametrize(
    ("text", "cap"),
    [
        ("max discount Rs 500", 50000), ("maximum discount INR 500", 50000), ("max cashback Rs 200", 20000), ("max discount Rs. 1,50,000", 15000000), ("Max. savings - of Rs 75", 7500), ("maximum instant discount is Rs 1.5 lakh", 15000000),
        ("max discount 10%", None), ("max 2 transactions", None), ("as much as ₹60", 6000), ("get cashback capped at Rs 1,200 a month", 120000), ("subject to a maximum of Rs 90", 9000), ("min. spend Rs 900, up to Rs 80 back", 8000),
    ],
)
def test_caps(text, cap):
    assert units.quantities_of(text, None, None, None)[0] == cap


@given(st.text(alphabet="max upto cap of 019.,₹Rs/-% pointsperxkl lakh crore\n٣९²½", max_size=60), st.one_of(st.none(), st.floats()), st.sampled_from([None, "", "INR", "Rs '000", "crore", "paise", "?"]))
def test_quantities_never_fail(text, number, unit):
    for n in units.quantities_of(text, number, unit, unit):
        assert n is None or isinstance(n, int)


def test_quantities_beyond(spark):
    """Amounts that no BIGINT holds are reported, the others come out; infinite numbers and endless digits are no amounts."""
    big = "9" * 32
    rows = [
        ("a", f"max discount Rs {big}", None, None), ("b", None, 1e300, "INR"), ("c", None, float("inf"), "INR"), ("d", "up to Rs " + "1" * 5000, None, None), ("e", "up to Rs 5", None, None),
        ("f", "up to Rs 92233720368547758", None, None), ("g", "up to Rs 92233720368547759", None, None), (None, None, None, None),
    ]
    offers = spark.createDataFrame([((i,), (t, n, c), "u", "clash") for i, t, n, c in rows], "identity struct<offer_id:string>, benefit struct<benefit_text:string,maximum_benefit:double,currency:string>, source_url string, amount string")
    sources = spark.createDataFrame([("u", "INR")], "url string, amount_unit string")
    assert cases(units.offer_quantities(offers, sources)) == {("e", "cap_paise", 500), ("f", "cap_paise", 9223372036854775800)}
    assert {tuple(r)[:2] for r in units.quantities_beyond(offers, sources).collect()} == {(i, "cap_paise") for i in "abg"}


def test_unit_vectors():
    rate = units.UNITS["points"] / units.UNITS["rs"]
    assert rate.dims[:2] == (-1, 1) and (rate * units.UNITS["rs"]).dims == units.UNITS["points"].dims
    k = units.UNITS["fahrenheit"]
    assert abs(212 * k.scale + k.offset - 373.15) < 1e-9 if isinstance(k.scale, float) else abs(float(212 * k.scale + k.offset) - 373.15) < 1e-9


def test_queries_run_on_given_tables(spark, data):
    columns = {"p3_found": ["offer_id", "quantity", "amount"], "p5_found": ["record_id", "child_table", "parent_pos", "pos", "item"], "p6_found": ["snapshot_date", "offer_id", "change_kind"], "p7_found": ["table_name", "period", "record_id", "field_name", "reference", "reason"]}
    for name, want in columns.items():
        df = data_queries.QUERIES[name](spark, data)
        assert df.columns == want and df.count() == df.distinct().count() > 0
