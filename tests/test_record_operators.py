"""The record operators: value parsers, quality, duplicates, cards, merchants and reconciliation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner.functions import classify, text, values
from gleaner.operators import cards, duplicates, merchants, quality, reconcile, records
from gleaner.plans import build
from gleaner.session import ensure_checkpoint_dir, own_exchange


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


def of(spark, fn, value):
    return one(spark, fn(F.lit(value).cast("string")))


@pytest.mark.parametrize(
    ("fn", "value", "want"),
    [
        (values.money, "Rs 1,000 per card", 1000.0), (values.money, "INR 15,000 Instant Discount", 15000.0), (values.money, "Rs.150", 150.0), (values.money, "Rs 2 Lakh", 200000.0),
        (values.money, "no amount here", None), (values.money, None, None), (values.money, "orders 2,000", 2000.0), (values.money, "500/-", 500.0),
        (values.percentage, "150% weird", None), (values.percentage, "Up to 5% Extra Cashback", 5.0),
        (values.maximum_benefit, "10% up to Rs.150 Instant Discount", 150.0), (values.maximum_benefit, "5% Instant Discount", None),
        (values.minimum_spend, "Min. Trxn: Rs 2,000", 2000.0), (values.minimum_spend, "Minimum Booking Value: Rs.500", 500.0),
        (values.rate_type, "5% Instant Discount", "EXACT"), (values.rate_type, "Up to 20% Instant Discount", "UP_TO"), (values.rate_type, "10% up to Rs.150 Instant Discount", "EXACT"), (values.rate_type, "none", None),
        (values.reward_multiplier, "Up to 5X reward points", 5.0), (values.reward_multiplier, "500x", None),
        (values.date, "31 st October 2026", dt.date(2026, 10, 31)), (values.date, "25/12/2024", dt.date(2024, 12, 25)), (values.date, "05/25/2024", None), (values.date, "Oct 5, 2025", dt.date(2025, 10, 5)), (values.date, "2025-13-01", None),
        (values.all_money, "Rs 10 and Rs 2k", [10.0, 2000.0]), (values.all_money, "none", []),
        (text.slugify, "Big C Mobiles!", "big_c_mobiles"), (text.clean, "  a  b | ", "a b"), (text.clean, " ", None), (text.titleise, "big-c-SBI_mcDon", "Big C SBI mcDon"), (text.titleise, "Some Name", "Some Name"),
        (text.split_list, "a, B;A|c\\nd", ["a", "B", "c", "d"]),
        (classify.category, "electronics-n-mobiles", "ELECTRONICS"), (classify.category, "dept-stores-n-groceries", "GROCERY"), (classify.category, None, None), (classify.category, "Fashion Items", "FASHION"), (classify.category, "zzz", "OTHER"),
        (classify.alias_key, "BigBasket Pvt Ltd", "bigbasket"), (classify.alias_key, "Amazon Fresh", "amazon fresh"), (classify.alias_key, "Gift Vouchers", "gift vouchers"), (classify.alias_key, "!!", None),
        (classify.card_tokens, "SBI Card PRIME+ Credit", ["plus", "prime", "sbi"]), (classify.card_tokens, None, []),
    ],
)
def test_functions(spark, fn, value, want):
    assert of(spark, fn, value) == want


@pytest.mark.parametrize(
    ("fn", "value", "want"),
    [
        (text.sanitize, " ﬁne\u3000dining\u200b ＡＢ½ ", "fine dining AB1⁄2"), (text.sanitize, "e\u0301t\u00e9\u00a0\u2003x", "\u00e9t\u00e9 x"), (text.sanitize, "a\x1fb", "a b"),
        (text.clean, "Stilwek Travels™", "Stilwek TravelsTM"), (text.clean, "Café •", "Café"), (text.clean, "\u00a0\u2003", None),
        (text.slugify, "Crème Brûlée № 5™", "creme_brulee_no_5tm"), (text.slugify, "ｆｕｌｌ", "full"), (text.slugify, "चाय", ""), (text.slugify, None, None),
        (text.split_list, "Ａ™, a，b ;aTM|é", ["ATM", "a,b", "é"]), (text.titleise, "café-no™", "Café noTM"),
        (classify.alias_key, "Stilwek Travels™ Pvt Ltd", "stilwek travelstm"), (classify.alias_key, "Ａmazon Ｆresh", "amazon fresh"), (classify.alias_key, "éshop x", "shop x"),
    ],
)
def test_text_beyond_ascii(spark, fn, value, want):
    """NFKC and NFKD, as Python's unicodedata has them."""
    assert of(spark, fn, value) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("Validity: 1 Oct - 10 Oct 2025", (dt.date(2025, 10, 1), dt.date(2025, 10, 10))),
        ("Validity: 22 Sep - 03 Oct 2025", (dt.date(2025, 9, 22), dt.date(2025, 10, 3))),
        ("15 Dec - 10 Jan 2026", (dt.date(2025, 12, 15), dt.date(2026, 1, 10))),
        ("Offer valid till 31 st October 2026", (None, dt.date(2026, 10, 31))),
        ("2026-10-01 to 2026-10-31", (None, dt.date(2026, 10, 31))),
        ("nothing", (None, None)),
    ],
)
def test_date_ranges(spark, value, want):
    assert tuple(of(spark, values.date_range, value)) == want


def test_helpers(spark):
    h = lambda *p: one(spark, text.stable_hash(*[F.lit(x).cast("string") for x in p]))
    assert h("a", "b") != h("b", "a") and h("a", None) == h("a", "") and len(h("a")) == 12
    assert one(spark, text.first_given(F.lit(None).cast("string"), F.lit("  "), F.lit("value"))) == "value"
    assert one(spark, text.first_given(F.lit(None).cast("int"), F.lit(0))) == 0
    assert one(spark, text.json_path(F.lit('{"a": {"b": [{"c": 7}]}}'), "a.b[0].c")) == "7"
    assert one(spark, text.json_path(F.lit("not json"), "a.b[5].c", "fallback")) == "fallback"
    kind = lambda t, f: one(spark, classify.transaction_type(F.lit(t), F.lit(f)))
    assert [kind("No cost EMI online", "Y"), kind("pay by UPI", "N"), kind("x", "n"), kind("in-store only", None), kind("on our app", None), kind("x", None)] == ["EMI_ONLY", "UPI_ONLY", "OFFLINE", "OFFLINE", "ONLINE", None]


def test_quality(spark):
    df = spark.createDataFrame([(1, 0, "x", [1]), (None, None, " ", [])], "a int, b int, c string, d array<int>")
    assert [r["coverage"] for r in quality.coverage(df).collect()] == ["1/2"] * 4
    assert [r[0] for r in df.select(quality.completeness(df, ["b", "a"])).collect()] == [1.0, 0.0]
    assert df.select(quality.completeness(df, [])).first()[0] == 0.0
    assert quality.completeness_stats(df.limit(0), ["a"]).first()["n_rows"] == 0
    v = quality.validate(df.withColumn("valid", F.lit("clash")), quality.Rules(required=["a"], non_empty=["c"], enums={"b": ["1"]}, recommended=["d"])).orderBy(F.col("a").desc()).collect()
    assert v[0]["errors"] == ["not allowed: b=0"] and v[1]["errors"] == ["missing: a", "empty: c"] and v[1]["warnings"] == ["recommended: d"] and not v[0]["valid"]
    assert {tuple(r) for r in quality.group_counts(df, "a").collect()} == {("1", 1), ("None", 1)}


def test_duplicates(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), (None, 3), (None, 4)], "k string, n int")
    assert tuple(duplicates.duplicate_report(df, ["k"]).first()) == (4, 1, 1, 2)
    assert tuple(duplicates.duplicate_report(df.limit(0), ["k"]).first()) == (0, 0, 0, 0)
    assert sorted(r["n"] for r in duplicates.first_wins(df, ["k"], "n").collect()) == [1, 3, 4]
    folded = duplicates.fold(spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "k string, seq int, n int"), ["k"], "seq", {"n": lambda a, b: a + b})
    assert [tuple(r) for r in folded.collect()] == [("a", 1, 3)]


CARD = "identity struct<card_id:string,issuer:string,official_url:string,card_name:string,product_family:string,personal_business:string>, product_family_id string"


def card_master(spark):
    c = lambda i, slug, name, issuer="SBI Card", fam="f": ((i, issuer, f"https://x/{slug}.page", name, None, None), fam)
    return spark.createDataFrame([c("prime", "sbi-prime-card", "SBI Card PRIME"), c("elite", "elite-page", "SBI Card Elite Advantage", fam="g"), c("gold", "gold", "HDFC Gold Advantage", "HDFC Bank")], CARD)


def test_card_cascade(spark):
    slugs = spark.createDataFrame([("SBI-Prime-Card", "x"), ("prime sbi", None), ("elite", "SBI Card"), ("advantage", "sbi card"), ("advantage", "other"), ("advantage", None), ("zz", None), ("", None), (None, None)], "slug string, issuer string")
    got = {(r["slug"], r["issuer"]): (r["card_ids"], r["step"]) for r in cards.resolve_slugs(slugs, card_master(spark)).collect()}
    assert got == {("SBI-Prime-Card", "x"): (["prime"], 1), ("prime sbi", None): (["prime"], 2), ("elite", "SBI Card"): (["elite"], 3), ("advantage", "sbi card"): (["elite"], 3)}


def test_card_links(spark):
    records = spark.createDataFrame([("a", "SBI Card", ["zz", "elite", "zz", " ", None, "sbi-prime-card", "yy"]), ("b", None, []), ("c", None, None)], "record_id string, issuer string, slugs array<string>")
    got = {r["record_id"]: tuple(r)[1:] for r in cards.link_cards(records, card_master(spark)).collect()}
    assert got == {"a": (["elite", "prime"], ["zz", "yy"], 0.5), "b": ([], [], None), "c": ([], [], None)}
    fam = cards.families(cards.link_cards(records, card_master(spark)), card_master(spark)).collect()
    assert [tuple(r) for r in fam] == [("a", ["f", "g"])]


def test_merchants(spark):
    m = spark.createDataFrame(
        [(1, "BigBasket Pvt Ltd", None, "SBI Card"), (2, "BigBasket", "grocery", "HDFC Bank"), (3, "bigbasket", "fashion", "SBI Card"), (4, None, None, "Axis Bank"), (5, "Myntra", None, "Axis Bank")],
        "seq int, name string, category string, issuer string",
    )
    dim = merchants.merchant_dimension(m, alias_lists=True)
    r = {x["merchant_id"]: x for x in dim.collect()}
    assert set(r) == {"m_bigbasket", "m_myntra"} and r["m_bigbasket"]["aliases"] == ["BigBasket Pvt Ltd", "BigBasket", "bigbasket"] and r["m_bigbasket"]["merchant_category"] == "GROCERY"
    seen = {x["seq"]: x["merchant_category"] for x in merchants.resolve_mentions(m, dim).collect()}
    assert seen == {1: None, 2: "GROCERY", 3: "GROCERY", 4: None, 5: None}
    gaps = merchants.partnership_gaps(dim, m.select("issuer").distinct()).collect()
    assert [(g["merchant_id"], g["missing_issuers"]) for g in gaps] == [("m_bigbasket", ["Axis Bank"])]


OFFER = """ingest_seq bigint, identity struct<offer_id:string,title:string,issuer:string,network:string>, merchant struct<merchant_id:string>,
benefit struct<benefit_type:string,discount_percentage:double,flat_discount:double,cashback:double,reward_multiplier:double,maximum_benefit:double>,
eligibility struct<minimum_spend:double,card_ids:array<string>,unmatched_card_slugs:array<string>>, validity struct<valid_until:date>, redemption struct<coupon_code:string>,
source_name string, source_url string, source_tier string, last_verified_at timestamp_ntz,
evidence_data array<struct<field:string,value:string,evidence:string,source_url:string,needs_review:boolean,review_reason:string>>, contributing_sources array<string>"""


def offer(seq, pct, source, tier, cap=None, cards=("c1",), title="t", day=1, evidence=()):
    return (
        seq, (f"o{seq}", f"{title}{pct}", "I", None), ("m",), ("PCT", pct, None, None, None, cap), (None, list(cards), None), (dt.date(2026, 1, 1),), (None,),
        source, f"u_{source}", tier, dt.datetime(2025, 1, day), [(f, None, None, source, False, None) for f in evidence], None,
    )


def run(spark, *offers):
    return reconcile.reconcile(spark.createDataFrame(list(offers), OFFER)).collect()


def test_reconcile(spark):
    assert len(run(spark, offer(1, 10.0, "a", "S", cards=("x",)), offer(2, 10.0, "b", "S", cards=("y",)))) == 2  # other cards
    r = run(spark, offer(1, 10.0, "a", "S"), offer(2, 20.0, "a", "S"))
    assert [x["kind"] for x in r] == ["single", "single"]  # one source
    r = run(spark, offer(1, 10.0, "a", "S"), offer(2, 15.0, "b", "S"))
    assert [(x["conflict_status"], x["conflict_fields"]) for x in r] == [("CONFLICTED", ["discount_percentage"])] and r[0]["discount_percentage"] == 10.0
    r = run(spark, offer(1, 15.0, "b", "C", day=9), offer(2, 10.0, "a", "S"))
    assert (r[0]["discount_percentage"], r[0]["conflict_status"], r[0]["contributing_sources"]) == (10.0, "RESOLVED_BY_TIER", ["a", "b"])
    r = run(spark, offer(1, 10.0, "a", "S", evidence=["f", "g"]), offer(2, 10.0, "b", "A", cap=1000.0, evidence=["f"]))
    assert (r[0]["maximum_benefit"], r[0]["conflict_status"], r[0]["n_evidence"]) == (1000.0, None, 3)
    r = run(spark, offer(1, 10.0, "a", "S"), offer(2, 10.0, "a", "S"), offer(3, 10.0, "b", "A"), offer(4, 12.0, "a", "S"))
    assert sorted(x["kind"] for x in r) == ["leftover", "merged"]  # the second is an exact duplicate
    r = run(spark, offer(1, 10.0, "a", "S"), offer(2, 11.0, "b", "S"), offer(3, 12.0, "c", "C"))
    assert r[0]["conflict_status"] == "RESOLVED_BY_TIER"  # the last fold overwrites
    assert run(spark) == []


def test_builders(spark):
    df = spark.createDataFrame([(1, " a\u00a0b ", "9", "x"), (2, None, "n", None)], "id int, t string, n string, clash string")
    got = records.parse_records(df, {"n": records.guarded(lambda v: str(int(v) + 1)), "gone": lambda c: c}, keep=["clash"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a b", "10", "x", None), (2, None, None, None, None)]
    assert records.parse_records(df, {"n": lambda c: c}, drop_unmapped=True).columns == ["n"]
    cells = F.array(*[F.struct(F.lit(a).alias("name"), F.lit(b).alias("value")) for a, b in (("Offer one", " "), ("Offer two", "7"), ("Offer three", "8"))])
    assert one(spark, records.pick_column(cells, "^Offer")) == "7" and one(spark, records.pick_column(cells, "none")) is None
    assert one(spark, records.entry_lines(F.lit("Page 3\nAbc\n abc \n\nx\n" + "y" * 200 + "\nDef"))) == ["Abc", "Def"]
    assert one(spark, records.entry_lines(F.lit(None).cast("string"))) is None
    assert one(spark, text.absolutise(F.lit("../b c?d"), F.lit("https://h/x/y/z"))) == "https://h/x/b%20c?d" and one(spark, text.absolutise(F.lit(" "), F.lit("https://h"))) is None
    assert [one(spark, f(F.lit(v))) for f, v in ((text.whole_number, 1234567.5), (text.short_number, 5.0), (text.short_number, 2.25), (text.percent_text, 0.07))] == ["1,234,568", "5", "2.25", "7%"]


def test_union_and_enrichment(spark):
    a, b = spark.createDataFrame([("k", 2, "a2"), ("k", 1, "a1"), (None, 1, "no")], "id string, o int, v string"), spark.createDataFrame([("k", 0, "b"), ("m", 0, "b")], "id string, o int, v string")
    assert {tuple(r) for r in records.priority_union([a, b], "id", "o").collect()} == {("k", 1, "a1"), ("m", 0, "b")}
    links = spark.createDataFrame([("o1", "u"), ("o2", "u"), ("o3", None)], "offer_id string, url string")
    read = []
    got = records.enrich(links, lambda urls: (read.append(urls.count()), urls.where("url is not null").withColumn("n", F.lit(1)))[1]).orderBy("offer_id").collect()
    assert read == [2] and [r["n"] for r in got] == [1, 1, None]


def test_duplicate_rows_and_merges(spark):
    df = spark.createDataFrame([(1, "a", None, 5), (2, "a", None, 6), (3, "b", "x", 7), (4, None, None, 1), (5, None, None, 1)], "n int, k string, l string, v int")
    got = {tuple(r) for r in duplicates.duplicate_rows(df, ["k", "l"], "n").collect()}
    assert got == {(1, 2, 1, False), (2, 2, 1, True)} and duplicates.duplicate_rows(df.limit(0), ["k"], "n").count() == 0
    merged = {tuple(r) for r in duplicates.merge_rows(df, ["k"], "n", {"v": F.sum}).collect()}
    assert merged == {(1, "a", None, 11), (3, "b", "x", 7), (4, None, None, 2)}


def test_hot_merchant_is_split(spark):
    """A merchant that a third of all mentions name is split where they meet the dimension."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in zip(names, ("-1", "4k", "4k", "false", "16"), strict=True):
            spark.conf.set(n, v)
        rows = spark.range(40000).repartition(8).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("key"))
        joined = rows.join(own_exchange(rows.groupBy("key").agg(F.min("seq").alias("first")), 0), "key", "left")
        assert len(joined.collect()) == 40000 and "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    class Java:
        def sc(self):
            return self

        def getCheckpointDir(self):
            return self

        def isDefined(self):
            return False

    class Context:
        master, _jsc = "spark://host:7077", Java()

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="checkpoint"):
        ensure_checkpoint_dir(Session())


def test_short_numbers_of_null(spark):
    assert one(spark, text.short_number(F.lit(None).cast("double"))) is None and one(spark, text.percent_text(F.lit(None).cast("double"))) is None


def test_build(spark, data):
    result = build.build(spark, data)
    assert result.ok and [s.name for s in result.stages] == ["extract", "enrich", "reconcile", "validate"] and all(s.rows for s in result.stages)
    assert "valid" in result.data.columns and build.report(spark, result).where("ok").count() == 4
