"""Encoding, shared spans and mixing, against public encoders, brute force and arithmetic."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import bpe, mixing, spans

tokenizers = pytest.importorskip("tokenizers")
PATH = f"{bpe.TOKENIZERS}/{bpe.VOCABULARY}"
DOC = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def public():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_of_random_texts(public):
    rnd = random.Random(1)
    letters = list("aabbcde fgh'st\n\t  .,!?01é中ü\x1c\x85 अक् 🙂")
    texts = ["".join(rnd.choices(letters, k=rnd.randrange(60))) for _ in range(3000)]
    texts += ["", " ", "a" * 20000, "ab" * 5000, "<|endoftext|> text <|endoftext|>", "don't WE'LL", "\x00\x01", "  x  "]
    e = bpe.encoder(PATH)
    assert [[i for w in ws for i in w] for g in e.groups(texts) for ws in g] == public(texts)


def test_ids_round_trip(spark, data, public):
    df = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").withColumn("ids", F.lit("clash"))
    rows = bpe.encode(df, "doc_id", "text").join(df.select("doc_id", "text"), "doc_id").collect()
    assert [r["ids"] for r in rows] == public([r["text"] or "" for r in rows])
    n = {r["doc_id"]: r["n"] for r in bpe.count_tokens(df, "text", "n").collect()}
    assert n == {r["doc_id"]: len(r["ids"]) for r in rows}


def test_ids_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "a", "x"), (None, "a", "x")], DOC)
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in bpe.encode(df, "doc_id", "text").collect()) == [(0, [64]), (0, [64]), (1, []), (2, [])]
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0


def brute_spans(texts, span):
    where = {}
    for d, t in texts.items():
        for s in range(len(t) - span + 1):
            where.setdefault(t[s : s + span], set()).add(d)
    out = {}
    for d, t in texts.items():
        m = np.zeros(len(t) + 1, int)
        for s in range(len(t) - span + 1):
            if len(where[t[s : s + span]]) > 1:
                m[s : s + span] += 1
        if n := int((m > 0).sum()):
            out[d] = n
    return out


@pytest.mark.parametrize("span", [146, 160, 200])
def test_spans_against_brute_force(spark, span, monkeypatch):
    rnd = random.Random(span)
    word = lambda n: "".join(rnd.choice("abcdefgh é🙂") for _ in range(n))
    passages = [word(n) for n in (span - 1, span, span + 1, span + 40, 3 * span, 900)]
    texts = {}
    for d in range(60):
        parts = []
        for _ in range(rnd.randrange(1, 4)):
            p = rnd.choice(passages)
            cut = rnd.randrange(40)
            parts += [word(rnd.randrange(1, 90)), p[cut if rnd.random() < 0.3 else 0 :]]
        texts[d] = "".join(parts)
    texts[100] = texts[101] = texts[102] = word(500)  # copies
    texts[103] = "z" * 1000
    texts[104] = word(300) * 2  # repetition inside one text only
    monkeypatch.setattr(spans, "BLOCK", 256)  # long texts are cut into blocks
    df = spark.createDataFrame([*((k, v, "x") for k, v in texts.items()), (200, None, "x"), (201, "", "x"), (202, "short", "x"), (None, texts[100], "x")], DOC)
    got = {r["doc_id"]: r["shared_chars"] for r in spans.shared_spans(df, "doc_id", "text", span).collect()}
    assert got == brute_spans(texts, span)


def test_spans_edges(spark):
    empty = spark.createDataFrame([], DOC)
    assert spans.shared_spans(empty, "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        spans.shared_spans(empty, "doc_id", "text", 100)


TARGET = "source string, target_share double, max_repeats int"


def documents(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(900):
        source = rnd.choice(["big", "Big ", "BIG", "small", None, " ", "other"]) if i % 9 else "small"
        rows.append((i, " ".join(rnd.choice(["apple", "pear", "42", "!!", "कार्ड"]) for _ in range(rnd.randrange(0, 80))), source))
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def run_mix(spark, **options):
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 5), ("absent", 0.1, 3)], TARGET)
    mixture, report = mixing.mix(documents(spark), targets, **options)
    return {r["doc_id"]: r for r in mixture.collect()}, {r["source"]: r for r in report.collect()}


def test_mix(spark, monkeypatch):
    m, r = run_mix(spark, total_tokens=30000)
    assert set(r) == {"big", "small", "absent"} and {x["source"] for x in m.values()} == {"big", "small"}
    for source, repeats in (("big", 1), ("small", 5)):
        rows = [x for x in m.values() if x["source"] == source]
        copies = {x["copies"] for x in rows}
        assert max(copies) <= repeats and max(copies) - min(copies) <= 1
        largest = max(x["n_tokens"] for x in rows)
        assert abs(r[source]["mixed_tokens"] - r[source]["budget_tokens"]) <= largest
        assert r[source]["mixed_tokens"] == sum(x["copies"] * x["n_tokens"] for x in rows) <= repeats * r[source]["available_tokens"]
    assert r["absent"]["mixed_tokens"] == 0 and r["absent"]["short_tokens"] > 0
    monkeypatch.setattr(mixing, "RANGES", 3)  # the same choice whatever the ranges
    assert {k: v["copies"] for k, v in run_mix(spark, total_tokens=30000)[0].items()} == {k: v["copies"] for k, v in m.items()}


def test_mix_exact_shares(spark):
    _, r = run_mix(spark, exact_shares=True)
    assert abs(r["big"]["mixed_tokens"] / r["small"]["mixed_tokens"] - 2) < 0.1


def test_mix_reaches_every_reachable_share(spark, data):
    """On the given tables each source with text has its share of the planned total to within one document; the others are reported."""
    docs, targets = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/mix_targets.parquet")
    mixture, report = mixing.mix(docs, targets, exact_shares=True)
    rows, largest = report.collect(), {r["source"]: r["n"] for r in mixture.groupBy("source").agg(F.max("n_tokens").alias("n")).collect()}
    total = min(r["available_tokens"] * r["max_repeats"] / r["target_share"] for r in rows if r["available_tokens"])
    for r in rows:
        assert r["reachable"] == (r["available_tokens"] > 0)
        assert abs(r["mixed_tokens"] - (r["target_share"] * total if r["reachable"] else 0)) <= largest.get(r["source"], 0) + 1
    reachable = [r for r in rows if r["reachable"]]
    mixed = sum(r["mixed_tokens"] for r in reachable)
    assert all(abs(r["actual_share"] - r["due_share"]) <= sum(largest.values()) / mixed for r in reachable)


def test_mix_weights_order(spark):
    """A document of twice the weight is drawn about as often as the method says."""
    n = 4000
    docs = spark.createDataFrame([(i, ("aa " * 80) if i % 2 else ("aa !! " * 40), "s") for i in range(n)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("s", 1.0, 1)], TARGET)
    m, _ = mixing.mix(docs, targets, total_tokens=n * 8)
    got = m.groupBy((F.col("doc_id") % 2).alias("odd")).count().collect()
    share = {r["odd"]: r["count"] for r in got}
    assert share[1] > share[0] * 1.5


def test_mix_empty(spark):
    docs = documents(spark).limit(0)
    m, r = mixing.mix(docs, spark.createDataFrame([("big", 0.6, 1)], TARGET))
    assert m.count() == 0 and r.count() == 1
    m, r = mixing.mix(documents(spark), spark.createDataFrame([], TARGET))
    assert m.count() == 0 and r.count() == 0
