"""Canonical values, matching across sources and survivors, on fixtures with known answers."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gleaner.llm import canonical, pairs, queries, survivors

NAMES = "kind string, entry string, name string, optional string"
REF = [
    ("m", "m1", "Fandkeindbe", None), ("m", "m2", "Graxler", None), ("m", "m3", "Graxler Jewels", None), ("m", "m4", "Graxler Luxury", None), ("m", "m5", "Geimflax Home & Living", None),
    ("m", "m6", "Stalklipe Fitness", None), ("m", "m7", "Stalklipe Luxury", None), ("m", "m1", "Nouxchetho Hub", None), ("m", "m8", "Twin Cabs", None), ("m", "m9", "Twin Cabs", None),
    ("c", "c1", "Talwick Card Klesplen Travel Credit Card", "talwick credit card"), ("c", "c2", "Talwick Card Klesplen Classic Credit Card", "talwick credit card"),
]


def test_canonical(spark):
    want = {
        ("m", "Fandkeindbe"): "m1", ("m", " FANDKEINDBE Pvt. Ltd. "): "m1", ("m", "Fánkdeindbe™"): "m1", ("m", "Fandkeindbe, Ranchi"): "m1", ("m", "www.graxlerjewels.example"): "m3",
        ("m", "Graxler"): "m2", ("m", "graxler jewles india"): "m3", ("m", "GraxlerJewels"): "m3", ("m", "Geimflax"): "m5", ("m", "GeimflaxHome&Living"): "m5", ("m", "Nouxchetho"): "m1",
        ("c", "talwick-klesplen-travel-cc"): "c1", ("c", "classic-klesplen-card"): "c2", ("c", "klesplentravel"): "c1", ("c", "klespeln_clasic_credit_card.html"): "c2",
    }
    unmatched = [("m", x) for x in ("Graxler Fitness", "Stalklipe", "All merchants", "Travels", "Twin Cabs", "", "  ", None, "x" * 5000, "?!", "Graxler Fandkeindbe")] + [("c", "klesplen"), ("c", "korvan-klesplen-platinum"), ("c", "all-cards")]
    values = spark.createDataFrame([*want, *unmatched, ("m", "Graxler")], "kind string, raw string")
    got = {(r["kind"], r["raw"]): r["canonical"] for r in canonical.map_values(values, canonical.reference_names(spark.createDataFrame(REF, NAMES))).collect()}
    assert got == want


def test_canonical_empty(spark):
    names = canonical.reference_names(spark.createDataFrame(REF, NAMES))
    none = spark.createDataFrame([], "kind string, raw string")
    assert canonical.map_values(none, names).count() == 0
    one = spark.createDataFrame([("m", "Graxler")], "kind string, raw string")
    assert canonical.map_values(one, canonical.reference_names(spark.createDataFrame([], NAMES))).count() == 0


def test_repairs_of_planted_typos(spark):
    """One letter changed, dropped, doubled or swapped in the first word is repaired."""
    rnd = random.Random(2)
    heads = ["".join(rnd.choice("bcdfghklmnprstv") + rnd.choice("aeiou") for _ in range(5)) for _ in range(80)]
    names = canonical.reference_names(spark.createDataFrame([("m", h, f"{h} cabs", None) for h in heads], NAMES))
    typed = []
    for h in heads:
        i = rnd.randrange(1, len(h) - 1)
        for t in (h[:i] + "z" + h[i + 1 :], h[:i] + h[i + 1 :], h[:i] + h[i] + h[i:], h[:i] + h[i + 1] + h[i] + h[i + 2 :]):
            typed.append((h, f"{t.title()} Cabs"))
    got = {r["raw"]: r["canonical"] for r in canonical.map_values(spark.createDataFrame([("m", v) for _, v in typed], "kind string, raw string"), names).collect()}
    assert sum(got.get(v) == h for h, v in typed) >= 0.97 * len(typed)


def test_repairs_of_two_edits(spark):
    """All pairs within two edits of a long token are found, whichever edits they are; short ones have one."""
    vocab = spark.createDataFrame([("m", "fandkeindbe"), ("m", "nouxchet"), ("m", "graxler")], "k string, vt string")
    # Two other letters, two lost, two added, one other and one lost, exchange at a distance, down to six letters; three edits, two of a short one.
    near = {"fxndkeizdbe": "fandkeindbe", "andkeinde": "fandkeindbe", "fandqkeindbew": "fandkeindbe", "fanxkeinde": "fandkeindbe", "danfkeindbe": "fandkeindbe", "nouche": "nouxchet"}
    far = ["fxndkeizdbx", "grxxlez", "fxndkeindbexx"]
    tokens = spark.createDataFrame([("m", t) for t in [*near, *far]], "kind string, tok string")
    got = {r["tok"]: (r["vt"], round(r["sim"], 4)) for r in canonical.repair(tokens, vocab, 11).collect()}
    assert got == {t: (v, round(1 - 2 / max(len(t), len(v)), 4)) for t, v in near.items()}


def test_candidates_through_any_word(spark):
    """What is damaged or lost may be any word; an unlisted line of business is no addition."""
    ref = [("m", "r", "Riverstone Outfitters", None), ("m", "b", "Blueharbor Electronics", None), ("m", "t", "Tea Pot", None), ("m", "z", "Zandora", None)]
    want = {
        "Rivarstane Outfitters": "r", "Bluxhaxbor Electronics": "b", "Rivrstne Outfitters": "r", "Tae Pot": "t", "Outfitters": "r", "the Outfitters store": "r", "Blueharbor": "b", "Zandora Ltd": "z", "Zandora, Connaught Place": "z",
        "Zandora (Hill Road)": "z", "Zandora Porbandar": "z", "Riverstone Outfitters Hill Road": "r",
        "Blueharbor Plumbing": None, "Blueharbor Dental Clinic": None, "Zandora Plumbing": None, "Riverstone Electronics": None, "Qwxtz Outfitters": None, "Plumbing": None,
    }
    values, places = spark.createDataFrame([("m", v) for v in want], "kind string, raw string"), spark.createDataFrame([("Porbandar;Pune",), (None,)], "word string")
    got = {r["raw"]: r["canonical"] for r in canonical.map_values(values, canonical.reference_names(spark.createDataFrame(ref, NAMES)), places).collect()}
    assert got == {v: e for v, e in want.items() if e}


def edits(a, b):
    """Edit distance by the textbook table, a swap of neighbours as one."""
    rows = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]


def test_repair_recall_against_brute_force(spark):
    """All reference tokens at the least distance in reach are found: one edit or swap, from eight letters on two."""
    rnd = random.Random(7)
    word = lambda n: "".join(rnd.choice("abcdehikmnorstu") for _ in range(n))
    vocab = sorted({word(rnd.choice([2, 3, 4, 5, 6, 7, 8, 9, 11])) for _ in range(250)})
    typed = set()
    for v in vocab * 3:
        t = list(v)
        for _ in range(rnd.choice([1, 1, 2])):
            i = rnd.randrange(len(t))
            how = rnd.randrange(4)
            t[i : i + 1] = [[rnd.choice("xyz")], [], [t[i], rnd.choice("xyz")], [t[i]]][how] if len(t) > 2 else [t[i], "x"]
            if how == 3 and i + 1 < len(t):
                t[i], t[i + 1] = t[i + 1], t[i]
        typed.add("".join(t))
    typed = sorted(t for t in typed if len(t) > 1)
    want = set()
    for t in typed:
        near = [(0 if t == v else 1 if (d := edits(t, v)) <= 1 else 2, v) for v in vocab if t == v or (d := edits(t, v)) <= 1 or (d == 2 and max(len(t), len(v)) >= canonical.TWO_EDITS)]
        want |= {(t, v) for c, v in near if c == min(near)[0]}
    tokens = spark.createDataFrame([("m", t) for t in typed], "kind string, tok string")
    got = {(r["tok"], r["vt"]) for r in canonical.repair(tokens, spark.createDataFrame([("m", v) for v in vocab], "k string, vt string"), 11).collect()}
    assert len(want) > 300 and len(got & want) >= 0.99 * len(want) and len(got & want) >= 0.99 * len(got)


def test_hot_value_is_split(spark):
    """A raw value that holds a third of all rows is split by adaptive execution where the rows meet the map."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in zip(names, ("-1", "4k", "4k", "false", "16"), strict=True):
            spark.conf.set(n, v)
        rows = spark.range(60000).repartition(8).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("raw"), F.sha2(F.col("id").cast("string"), 256).alias("record"))
        mapped = rows.groupBy("raw").agg(F.max("record").alias("canonical"))
        joined = rows.join(mapped.transform(lambda d: canonical.own_exchange(d, 0)), "raw", "left")
        joined.write.format("noop").mode("overwrite").save()
        plan = joined._jdf.queryExecution().executedPlan()
        assert joined.count() == 60000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString(), plan
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_values():
    assert pairs.value_of("Flat Rs 1000 off at x") == ("F", 100000) and pairs.value_of("11 per cent cashback") == ("P", 11000) and pairs.value_of("Earn 9x points") == ("X", 9000)
    assert pairs.value_of("₹६० off") == ("F", 6000) and pairs.value_of("Extra savings") is None and pairs.value_of(None) is None
    assert pairs.paise_of("12750.0") == 1275000 and pairs.paise_of("1.5 thousand rupees") == 150000 and pairs.paise_of("99900 paise") == 99900 and pairs.paise_of("") is None
    assert pairs.split_title("x off on min. spend of ₹13K") == ("x off ", "₹13K")


BANK = "bank_offer_id string, issuer string, merchant_id string, title string, benefit_type string, discount_percentage double, minimum_spend double, valid_until date, l_id string"
LIST = "listing_id string, bank_name string, merchant_id string, title string, benefit_type string, benefit_value string, minimum_spend string, valid_until string, city string"
SHOPS = "merchant_id string, merchant_name string, merchant_aliases array<string>"


def world(n=900, seed=4):
    rnd = random.Random(seed)
    shops = ["".join(rnd.choice("bcdfghklmnprstv") + rnd.choice("aeiou") for _ in range(4)).title() for _ in range(60)]
    banks, listed, truth = [], [], set()
    for i in range(n):
        s = shops[0] if rnd.random() < 0.3 else rnd.choice(shops)  # one merchant holds a third
        bank, pct, least, day = rnd.choice("Alpha Beta Gamma Delta Omega".split()), rnd.randrange(1, 60), rnd.randrange(1, 100) * 250.0, dt.date(2025, 1, 1) + dt.timedelta(rnd.randrange(500))
        banks.append((f"b{i}", f"{bank} Bank", f"m_{s.lower()}" if rnd.random() < 0.9 else None, f"{pct}% cashback at {s}", "CASHBACK", float(pct) if rnd.random() < 0.9 else None, least, day, "clash"))
        if rnd.random() < 0.7:
            gone = rnd.choice([None, "bank", "value", "least", "day"])
            shown = day + dt.timedelta(rnd.choice([-1, 0, 0, 1, 2]))
            listed.append((f"l{len(listed)}", None if gone == "bank" else f"{bank.upper()} cards", s.lower(), f"{'Extra' if gone == 'value' else f'{pct} per cent'} money back @ {s}", None, None, None if gone == "least" else f"Rs {least:,.0f}", None if gone == "day" else shown.strftime("%d/%m/%Y"), "x"))
            truth.add((f"b{i}", listed[-1][0]))
        if rnd.random() < 0.2:  # the same terms, weeks later
            listed.append((f"l{len(listed)}", f"{bank} Bk", s.lower(), f"{pct}% cashback @ {s}", "CASHBACK", f"{pct}%", str(least), (day + dt.timedelta(rnd.randrange(21, 60))).isoformat(), None))
    return banks, listed, shops, truth


def test_pairs_on_planted_truth(spark):
    banks, listed, shops, truth = world()
    b, p = spark.createDataFrame([*banks, banks[0], (None,) * 9], BANK), spark.createDataFrame([*listed, listed[0], ("empty", *(None,) * 8)], LIST)
    m = spark.createDataFrame([(f"m_{s.lower()}", s, None) for s in shops], SHOPS)
    rows = pairs.match_offers(b, p, m).collect()
    got = {(r["bank_offer_id"], r["listing_id"]) for r in rows}
    hit = len(got & truth)
    assert len(got) == len(rows) and hit / len(got) >= 0.99 and hit / len(truth) >= 0.98
    assert all(0.5 < r["confidence"] <= 1 for r in rows)


def test_pairs_empty(spark):
    banks, listed, shops, _ = world(5)
    m = spark.createDataFrame([("m", "Shop", None)], SHOPS)
    none = spark.createDataFrame([], BANK)
    assert pairs.match_offers(none, spark.createDataFrame(listed or [("l", *(None,) * 8)], LIST), m).count() == 0
    assert pairs.match_offers(spark.createDataFrame(banks, BANK), spark.createDataFrame([], LIST), m).count() == 0


def signed(spark, n, typos=0.0):
    """Bank and listing rows of a world, a share of the listings' merchants with a changed letter."""
    banks, listed, shops, truth = world(n)
    rnd = random.Random(9)
    listed = [(*r[:2], *[t.replace(s := r[2], s[:3] + "q" + s[4:]).replace(s.title(), (s[:3] + "q" + s[4:]).title()) if rnd.random() < typos else t for t in r[2:4]], *r[4:]) for r in listed]
    m = spark.createDataFrame([(f"m_{s.lower()}", s, None) for s in shops], SHOPS)
    rows = pairs.with_tokens(pairs.with_merchants(pairs.attributes(spark.createDataFrame(banks, BANK), spark.createDataFrame(listed, LIST)), m)).checkpoint()
    return rows.where("side = 'b'").drop("side"), rows.where("side = 'l'").drop("side"), truth


def shared(x, y):
    """Which of the attributes other than the merchant two rows share, and the likeness of their merchants' shingles."""
    grams = lambda r: {("  " + t + "  ")[i : i + 3] for t in (r["m_name"], r["m_slug"]) if t for i in range(len(t) + 2)}
    a, b = grams(x), grams(y)
    plain = sum(x[c] is not None and x[c] == y[c] for c in ("issuer", "value", "spend")) + bool(set(x["buckets"] or ()) & set(y["buckets"] or ()))
    return plain, len(a & b) / len(a | b) if a | b else 0.0


def test_blocking_recall_against_brute_force(spark):
    """All pairs that share three attributes are candidates, and all that share two and whose merchants' signatures agree in a band."""
    b, p, _ = signed(spark, 200, typos=0.3)
    got = [tuple(r) for r in pairs.candidate_pairs(b, p).collect()]
    want = set()
    for x in b.collect():
        for y in p.collect():
            plain, like = shared(x, y)
            bands = [i == j for i, j in zip(x["m_tokens"] or (), y["m_tokens"] or (), strict=False)]
            if plain >= 3 or (plain == 2 and any(bands)):
                want.add((x["rid"], y["rid"]))
            assert like < 1 or all(bands)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_minhash_bands(spark):
    """Two texts agree in one of the bands about as often as the likeness of their trigrams says."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("bcdfghklmnprstvaeiou") for _ in range(rnd.randrange(6, 16)))
    texts = []
    for _ in range(600):
        w, i = word(), rnd.randrange(1, 5)
        texts.append((w, rnd.choice([w[:i] + "q" + w[i + 1 :], w + "sh", w[i:], word()])))
    bands = lambda c: pairs.minhash_bands(pairs.trigrams(F.col(c)))
    got = spark.createDataFrame(texts, "a string, b string").select(F.exists(F.arrays_zip(bands("a").alias("x"), bands("b").alias("y")), lambda z: z["x"] == z["y"]).alias("hit")).collect()
    grams = lambda t: {("  " + t + "  ")[i : i + 3] for i in range(len(t) + 2)}
    likes = [len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for a, b in texts]
    expected = sum(1 - (1 - j**pairs.ROWS) ** pairs.BANDS for j in likes)
    assert abs(sum(r["hit"] for r in got) - expected) < 40 and expected > 200


def test_minhash_decides(spark, monkeypatch):
    """Without the signature of the merchants, pairs that need it are no candidates."""
    b, p, truth = signed(spark, 300, typos=0.3)
    p = p.withColumn("issuer", F.lit(None).cast("string")).withColumn("until", F.lit(None).cast("date")).withColumn("buckets", F.lit(None).cast("array<bigint>"))
    p = p.where("value is not null and spend is not null")  # what is left beside the merchant are two attributes
    truth = {x for x in truth if x[1] in {r["id"] for r in p.select("id").collect()}}
    ids = {r["rid"]: r["id"] for r in b.unionByName(p).select("rid", "id").collect()}
    found = lambda: {(ids[r["b"]], ids[r["l"]]) for r in pairs.candidate_pairs(b, p).collect()} & truth
    assert len(found()) >= 0.7 * len(truth) > 50  # all with the merchant as written, the others by chance
    blind = lambda d: d.withColumn("m_tokens", F.array(*[F.xxhash64("rid", F.lit(i)) for i in range(pairs.BANDS)]))
    b, p = blind(b), blind(p)
    assert not found()


def test_hot_blocks_are_refined(spark, monkeypatch):
    """Where blocks count as hot, pairs that share a further attribute still meet, and blocks are smaller."""
    b, p, truth = signed(spark, 600)
    usual = {tuple(r) for r in pairs.candidate_pairs(b, p).collect()}
    monkeypatch.setattr(pairs, "HOT", 1)
    refined = {tuple(r) for r in pairs.candidate_pairs(b, p).collect()}
    assert refined < usual
    left, right = ({r["rid"]: r for r in d.collect()} for d in (b, p))
    equal = set()  # at least four attributes: five or more bank rows never share four here
    for x, y in usual:
        plain, like = shared(left[x], right[y])
        if plain + (like == 1.0) >= 4:
            equal.add((x, y))
    assert len(refined & equal) >= 0.97 * len(equal)


def test_hot_blocks_keep_records_that_lack_the_rest(spark):
    """In a hot block a bank's record that lacks what tells the others apart still meets the listings; so does one that lacks what the listing states, and the other way round."""
    day = dt.date(2025, 3, 1)
    row = lambda i, pct, least: (f"b{i}", "Alpha Bank", "m_zandora", f"{pct}% cashback at Zandora" if pct else "Cashback at Zandora", "CASHBACK", pct, least, day, None)
    banks = [row(i, float(i % 50 + 1), 1000.0 + 10 * i) for i in range(3 * pairs.HOT)] + [row("none", None, None), row("pct", 77.0, None), row("least", None, 77777.0)]
    item = lambda i, pct, least: (i, "Alpha", "zandora", f"{pct} cashback @ Zandora" if pct else "Cashback @ Zandora", "CASHBACK", None, least, "2025-03-01", None)
    listed = [item("both", "99%", "Rs 99999"), item("pct", "98%", None), item("least", None, "Rs 88888")]
    m = spark.createDataFrame([("m_zandora", "Zandora", None)], SHOPS)
    rows = pairs.with_tokens(pairs.with_merchants(pairs.attributes(spark.createDataFrame(banks, BANK), spark.createDataFrame(listed, LIST)), m)).checkpoint()
    ids = {r["rid"]: r["id"] for r in rows.collect()}
    got = {(ids[r["b"]], ids[r["l"]]) for r in pairs.candidate_pairs(rows.where("side = 'b'").drop("side"), rows.where("side = 'l'").drop("side")).collect()}
    assert got == {("bnone", "both"), ("bnone", "pct"), ("bnone", "least"), ("bleast", "pct"), ("bpct", "least")}


def test_fit_is_one_rule_for_every_size():
    """No label leaves the prior and the plain score, few labels move it little; a masked attribute does not change the label."""
    columns = ["l", *[f"a_{c}" for c in pairs.COMPARED], *[f"g_{c}" for c in pairs.COMPARED], "half", "unlike", "days", "log_n"]
    row = lambda l, agree, gain: (l, *agree, *([gain] * 6), 0.0, 0.0, 0.0, 6.0)  # noqa: E731, E741
    frame = lambda rows: pd.DataFrame(rows, columns=columns)
    none = pairs.fit(frame([]))
    assert np.allclose(none.weights, pairs.PRIOR) and (none.slope, none.shift) == (1.0, 0.0)
    few = pairs.fit(frame([row(1, (1,) * 6, 4.0), row(1, (1, 1, 1, 1, -1, 1), 4.0)]))
    assert (few.weights[:7] < 0).all() and few.weights[5] <= pairs.PRIOR[5]
    many = [row(i, (1,) * 6, 4.0) for i in range(200)] + [row(i, (1, 1, 1, 1, -1, 1), 4.0) for i in range(200)]
    assert list(pairs.weak_labels(frame(many))) == [1.0] * 200 + [0.0] * 200
    hidden = pairs.masked(frame(many), np.random.default_rng(0))
    assert len(hidden) == 4 * len(many) and (hidden["a_until"] == 0).any() and np.isfinite(pairs.fit(frame(many)).weights).all()


def test_features_are_the_same_on_both_sides(spark):
    rnd = random.Random(1)
    names = [*[f"a_{c}" for c in pairs.COMPARED], *[f"g_{c}" for c in pairs.COMPARED], "half", "unlike", "days", "log_n"]
    rows = pd.DataFrame([[*[rnd.choice([-1, 0, 1]) for _ in range(6)], *[rnd.random() * 5 for _ in range(6)], float(rnd.choice([0, 1])), rnd.random(), rnd.random(), 7.0] for _ in range(50)], columns=names)
    got = np.array(spark.createDataFrame(rows).select(*[c.alias(n) for n, c in pairs.feature_columns().items()]).collect(), float)
    assert np.allclose(got, pairs.feature_matrix(rows)) and got.shape[1] == len(pairs.FEATURES) == len(pairs.PRIOR) - 1


OFFER = """identity struct<canonical_offer_id:string,offer_id:string,title:string,description:string>, redemption struct<coupon_code:string>, validity struct<valid_until:date>,
evidence_data array<struct<evidence:string>>, contributing_sources array<string>, source_tier string, last_verified_at timestamp_ntz, grp string"""


def random_offers(rnd, n, groups):
    rows = []
    for i in range(n):
        text = lambda: rnd.choice([None, "", " ", "n/a", "TBD", "?", "a", "b"])
        rows.append((
            (rnd.choice([None, *[f"g{j}" for j in range(groups)]]), rnd.choice([None, f"o{i // 2}", f"o{i}"]), text(), text()), (text(),), (rnd.choice([None, dt.date(1970, 1, 1), dt.date(9999, 12, 31), dt.date(2025, 5, 5)]),),
            rnd.choice([None, [], [("",), (None,)], [(" ",), ("x",)], [None]]), rnd.choice([None, [], ["none", None], ["src"]]), rnd.choice([None, "S", " s ", "Tier A", "tier-b", "X", "", "B\n", "D"]),
            rnd.choice([None, dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 0, 0, 0, 5), dt.datetime(1969, 5, 1)]), "clash",
        ))
    return rows


def brute_survivors(rows):
    fillers = {"", "n/a", "tbd", "?", "none"}
    good = lambda x: x is not None and x.strip().lower() not in fillers
    rank = {"S": 0, "s": 0, "Tier A": 1, "tier-b": 2, "B": 2, "D": 4}
    best, ids = {}, {}
    for (g, o, title, desc), (code,), (until,), ev, src, tier, at, _ in rows:
        if g is None or o is None:
            continue
        ids.setdefault(g, set()).add(o)
        usable = {"title": good(title), "description": good(desc), "coupon_code": good(code), "valid_until": until == dt.date(2025, 5, 5), "evidence_data": any(e and good(e[0]) for e in ev or []), "contributing_sources": any(good(s) for s in src or [])}
        key = (rank.get((tier or "").strip(), 5), at is None, -(at - dt.datetime(1900, 1, 1)).total_seconds() if at else 0, o)
        for f, ok in usable.items():
            if ok and ((g, f) not in best or key < best[g, f]):
                best[g, f] = key
    return {(g, f, k[3]) for (g, f), k in best.items() if len(ids[g]) > 1}


def test_survivors_against_brute_force(spark):
    for seed, (n, groups) in enumerate([(400, 40), (600, 2), (0, 1)]):  # small groups, one with half of all rows, none
        rows = random_offers(random.Random(seed), n, groups)
        df = spark.createDataFrame(rows, OFFER)
        assert {tuple(r) for r in survivors.offer_survivors(df).collect()} == brute_survivors(rows)
        built = survivors.surviving_offers(df).collect()
        assert {r["canonical_offer_id"] for r in built} == {g for g, _, _ in brute_survivors(rows)}


def test_layers(spark):
    def layers(*records):
        rows = sorted(records)
        df = spark.createDataFrame([([*rows],)], "records array<struct<trust:int,age:bigint,id:string,mask:int>>")
        return {r["id"]: r["layer"] for r in df.select(F.explode(survivors.with_layers(F.col("records"))).alias("r")).select("r.*").collect()}

    # b is dominated by a, c by b; d has a field that no better record has.
    assert layers((0, 1, "a", 3), (1, 2, "b", 3), (2, 3, "c", 1), (4, 9, "d", 4)) == {"a": 1, "b": 2, "c": 3, "d": 1}


def test_later_layers_fill_fields(spark):
    """By count, a field that no record of the first layer has comes from the second, and conflicts with the policy are reported."""
    # a dominates b; only b has field 2. c holds more than d but is trusted less: by count it goes before d for field 0.
    groups = spark.createDataFrame([("g", [(0, 1, "a", 3), (1, 2, "b", 4)]), ("h", [(0, 1, "x", 6), (1, 3, "d", 1), (2, 2, "c", 7)])], "grp string, records array<struct<trust:int,age:bigint,id:string,mask:int>>")
    got = {(r["grp"], r["field_name"]): (r["id"], r["layer"]) for r in survivors.surviving_fields(groups, ["f0", "f1", "f2"], by_count=True).collect()}
    assert got == {("g", "f0"): ("a", 1), ("g", "f1"): ("a", 1), ("g", "f2"): ("b", 2), ("h", "f0"): ("c", 1), ("h", "f1"): ("x", 1), ("h", "f2"): ("x", 1)}
    assert [tuple(r) for r in survivors.layer_conflicts(groups, ["f0", "f1", "f2"]).collect()] == [("h", "f0", "d", "c", 1)]


def brute_layers(rows):
    """Layers of all distinct (grp, id, trust, age, mask), peeled off one after another."""
    over = lambda a, x: a != x and a[0] == x[0] and a[2] <= x[2] and (a[3], a[1]) <= (x[3], x[1]) and a[4] & x[4] == x[4]
    left, sizes = set(rows), []
    while left:
        first = {x for x in left if not any(over(a, x) for a in left)}
        sizes.append(len(first))
        left -= first
    return dict(enumerate(sizes, 1))


def test_layer_sizes_count_all_records(spark):
    """Dominated records of one class and groups of a single id count too, copies do not."""
    some = [("g", "a", 0, 1, 3), ("g", "b", 0, 2, 3), ("g", "c", 0, 3, 3), ("g", "c", 0, 3, 3), ("one", "d", 5, 1, 0)]
    rnd = random.Random(5)
    many = [(rnd.choice("gh"), f"o{rnd.randrange(120)}", rnd.randrange(6), rnd.randrange(9), rnd.randrange(16)) for _ in range(300)]
    for rows in (some, many, []):
        df = spark.createDataFrame(rows, "grp string, id string, trust int, age bigint, mask int")
        assert {r["layer"]: r["n_records"] for r in survivors.layer_sizes(df).collect()} == brute_layers(rows)
    offers = random_offers(random.Random(3), 200, 20)
    got = {r["layer"]: r["n_records"] for r in survivors.layer_sizes(survivors.judged_offers(spark.createDataFrame(offers, OFFER))).collect()}
    assert sum(got.values()) == spark.createDataFrame(offers, OFFER).where("identity.canonical_offer_id is not null and identity.offer_id is not null").transform(survivors.judged_offers).distinct().count()


def test_first_layer_holds_every_survivor(spark, data):
    groups = survivors.offer_candidates(spark.read.parquet(f"{data}/offers.parquet"))
    assert survivors.surviving_fields(groups, list(survivors.FIELDS)).where("layer > 1").count() == 0


def test_queries_run_on_given_tables(spark, data):
    columns = {"p1_found": ["field_name", "record_id", "raw_value", "canonical_id"], "p2_found": ["bank_offer_id", "listing_id"], "p4_found": ["canonical_offer_id", "field_name", "offer_id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "shared_chars"]}
    for name, want in columns.items():
        df = queries.QUERIES[name](spark, data)
        assert df.columns == want and df.count() == df.distinct().count() > 0
