"""Matching without keys over all pairs: nothing left out of hot blocks, nothing stored for each pair."""

import datetime as dt
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.llm import cells, pairs

BANK = "bank_offer_id string, issuer string, merchant_id string, title string, benefit_type string, discount_percentage double, minimum_spend double, valid_until date"
LIST = "listing_id string, bank_name string, merchant_id string, title string, benefit_type string, benefit_value string, minimum_spend string, valid_until string, city string"
SHOPS = "merchant_id string, merchant_name string, merchant_aliases array<string>"


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def offer(i, shop, day, least=1000.0, pct=5.0):
    return (f"b{i}", "Alpha Bank", f"m_{shop}" if shop else None, f"{pct:g}% cashback at {shop}" if shop else f"{pct:g}% cashback", "CASHBACK", pct, least, day)


def listing(i, shop, day, least=1000.0, pct=5.0):
    return (f"l{i}", "Alpha", shop, f"{pct:g}% cashback @ {shop}", "CASHBACK", f"{pct:g}%", f"Rs {least:,.0f}", day.isoformat() if day else None, None)


def frames(spark, banks, listed):
    return spark.createDataFrame(banks, BANK), spark.createDataFrame(listed, LIST), spark.createDataFrame([("m", "Zandora", None)], SHOPS)


def some(n, seed=5):
    """Offers and listings of few issuers, values and days, so that many pairs share three attributes; versions, copies and gaps among them."""
    rnd = random.Random(seed)
    shops = ["".join(rnd.choice("bcdfghklmnprstv") + rnd.choice("aeiou") for _ in range(4)) for _ in range(12)]
    banks, listed = [], []
    for i in range(n):
        pick = lambda: (rnd.choice(shops), dt.date(2025, 3, 1) + dt.timedelta(rnd.randrange(60)), rnd.choice([250.0, 500.0, 750.0]), float(rnd.randrange(1, 5)))
        banks.append(offer(i - (i % 9 == 8), *pick()))
        s, *rest = pick()
        listed.append(listing(i - (i % 7 == 6), rnd.choice([s, s[:3] + "q" + s[4:]]), *rest))
        if i % 5 == 0:
            listed[-1] = (*listed[-1][:6], None, *listed[-1][7:])
            banks[-1] = (*banks[-1][:7], None)
    return [*banks, banks[0], (None, *banks[0][1:])], [*listed, listed[0], ("empty", *(None,) * 8)]


def test_rivals_of_a_hot_block_count(spark, monkeypatch):
    """More than HOT offers that share three attributes with a listing and differ in the two others lower the confidence of its pair."""
    n, day, rnd = pairs.HOT + 10, dt.date(2025, 1, 1), random.Random(1)
    names = [a + "".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for a in ("abcdefghijklmnopqrstuvwxyz" * 4)[:n]]
    assert all(distance(x, y) > 0.5 * max(len(x), len(y)) for i, x in enumerate(names) for y in names[:i])
    banks = [offer(i, names[i], day + dt.timedelta(20 * i)) for i in range(n)]
    weights = np.array([-1.0, *[-1.0] * 6, *[0.0] * 9, 6.0])  # the log of the number that agree by accident, one for each conflict
    monkeypatch.setattr(pairs, "train", lambda *_: pairs.Model(weights, 1.0, 0.0))
    got = pairs.match_offers(*frames(spark, banks, [listing(0, names[3], day + dt.timedelta(60))])).collect()
    top = np.exp(np.log(n / (2 * pairs.DAYS_OFF + 1)) + 6)  # the merchant is one of n, the day one of n
    rivals = (n - 1) * np.exp(-np.log(n) - 2 + 6)
    assert [tuple(r) for r in got] == [("b3", "l0", pytest.approx(top / (1 + top + rivals), abs=2e-6))]


def test_stored_bytes_follow_records(spark, tmp_path):
    """What is stored does not grow with the pairs: 48 blocks of 40 offers and 40 listings hold 76 800."""
    day = dt.date(2025, 1, 1)
    banks = [offer(f"{k}_{i}", None, day + dt.timedelta(20 * i), 1000.0 + k) for k in range(48) for i in range(40)]
    listed = [listing(f"{k}_{i}", "zandora", day + dt.timedelta(20 * i + 10), 1000.0 + k) for k in range(48) for i in range(40)]
    b, p, m = frames(spark, banks, listed)
    sc = spark.sparkContext
    before = sc._jsc.sc().getCheckpointDir().get()
    try:
        sc.setCheckpointDir(str(tmp_path))
        pairs.match_offers(b, p, m)
        stored = sum(f.stat().st_size for f in Path(tmp_path).rglob("part-*"))
    finally:
        sc.setCheckpointDir(before)
    assert 0 < stored < 100 * (len(banks) + len(listed))


def rows_of(spark, n):
    b, p, m = frames(spark, *some(n))
    return pairs.with_merchants(pairs.attributes(b, p), m).checkpoint()


def test_cells_hold_all_pairs(spark, monkeypatch):
    """The pairs of the cells, each once, are those of the blocks when none counts as hot, however the records are cut into chunks."""
    rows = rows_of(spark, 300)
    blocks = pairs.with_tokens(rows)
    monkeypatch.setattr(pairs, "HOT", 10**9)
    want = {tuple(r) for r in pairs.candidate_pairs(blocks.where("side = 'b'").drop("side"), blocks.where("side = 'l'").drop("side")).collect()}
    for parts, limit in (((1, 1), 1 << 25), ((3, 4), 1 << 25), ((2, 3), 0)):
        monkeypatch.setattr(pairs, "BROADCAST_LIMIT", limit)
        got = [tuple(r) for r in pairs.compared(pairs.candidate_cells(pairs.packed(rows, *parts).checkpoint())).select("b", "l").collect()]
        assert len(got) == len(set(got)) > 5000 and set(got) == want


def test_what_hot_blocks_leave_out_is_found(spark, monkeypatch):
    """What the blocks give and what hot ones leave out are together the pairs of the cells, each once."""
    rows = rows_of(spark, 150)
    want = {tuple(r) for r in pairs.compared(pairs.candidate_cells(pairs.packed(rows, 1, 1).checkpoint())).select("b", "l").collect()}
    blocks = pairs.with_tokens(rows).checkpoint()
    b, p = (blocks.where(F.col("side") == s).drop("side") for s in "bl")
    for hot, left in ((1, True), (7, True), (10**9, False)):
        monkeypatch.setattr(pairs, "HOT", hot)
        usual, rest = ([tuple(r) for r in f(b, p).collect()] for f in (pairs.candidate_pairs, pairs.left_out_pairs))
        assert len(usual) + len(rest) == len({*usual, *rest}) and {*usual, *rest} == want and bool(rest) == left


def test_best_of_cells(spark, monkeypatch):
    """Of each listing the best pair and the sum of the odds, a pair of ids once with the best odds of its versions, however the records are cut."""
    rows, model = rows_of(spark, 300), pairs.Model(pairs.PRIOR / 8, 1.0, 0.0)
    for parts, limit in (((1, 1), 1 << 25), ((3, 4), 1 << 25), ((2, 3), 0)):
        monkeypatch.setattr(pairs, "BROADCAST_LIMIT", limit)
        found = pairs.candidate_cells(pairs.packed(rows, *parts).checkpoint())
        each = pairs.compared(found).toPandas()
        each["z"] = model.odds({c: each[c].to_numpy() for c in each.columns})
        best = each.groupby(["l_id", "b_id"])["z"].max().reset_index()
        assert len(best) < len(each)  # some ids have versions
        want = best.groupby("l_id")["z"].agg(["max", "sum"])
        got = found.cells.mapInArrow(cells.best_rows(pairs.RULES, found.log_n, found.every_day, model.odds), "l_id string, odds double, b_id string, all double")
        got = got.groupBy("l_id").agg(F.max(F.struct("odds", "b_id")).alias("top"), F.sum("all").alias("all")).collect()
        assert {r["l_id"] for r in got} == set(want.index)
        top = {(r["l_id"], r["b_id"]): r["z"] for _, r in best.iterrows()}
        for r in got:
            assert np.isclose(r["top"]["odds"], want["max"][r["l_id"]]) and np.isclose(r["all"], want["sum"][r["l_id"]]) and np.isclose(top[r["l_id"], r["top"]["b_id"]], r["top"]["odds"])


def test_distances_against_textbook():
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdé😀") for _ in range(rnd.choice([1, 2, 5, 9, 30, 63, 64, 65, 90])))
    left, right = [word() for _ in range(60)], [word() for _ in range(60)] + ["zzz"]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(left)), np.arange(len(right)), indexing="ij"))
    assert cells.Texts(left, right).distances(a, b).tolist() == [distance(left[i], right[j]) for i, j in zip(a, b, strict=True)]


def test_chunks_are_cut_between_ids(monkeypatch):
    """At most CHUNK rows unless one id has more, no id in two chunks, equal rows once, also across batches."""
    monkeypatch.setattr(cells, "CHUNK", 10)
    rnd = random.Random(3)
    ids = [(s, f"{s}{i:03}", v) for s in "bl" for i in range(60) for v in range(25 if i == 30 else rnd.randrange(1, 4))]
    rows = [(s, i, hash((s, i, v))) for s, i, v in ids for _ in range(rnd.randrange(1, 3))]
    t = pa.table({"side": [r[0] for r in rows], "id": [r[1] for r in rows], "rid": [r[2] for r in rows]})
    t = t.append_column("draw", pa.array(np.zeros(len(rows), np.int32)))
    for c in (*cells.NUMBERS, "band_0"):
        t = t.append_column(c, pa.nulls(len(rows), pa.int64()))
    for c in ("m_name", "m_slug"):
        t = t.append_column(c, pa.nulls(len(rows), pa.string()))
    for size in (7, 1000):
        out = [r for b in cells.pack(iter(t.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        chunks = [cells.unpack(r["data"]) for r in out]
        assert [x for c in chunks for x in c.rid] == list(dict.fromkeys(r[2] for r in rows)) and [c.n for c in chunks] == [r["n"] for r in out]
        assert sum(len(set(c.id)) for c in chunks) == 120 and all(c.n <= 10 or len(set(c.id)) == 1 for c in chunks) and len({r["chunk"] for r in out}) == len(out)
