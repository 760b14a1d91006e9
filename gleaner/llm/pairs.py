"""Records of two sources that describe the same offer, without a common key.

Both sides are brought to the same attributes (merchant, issuer, value, least spend, last day). Each
attribute is a set of shingles (letter trigrams of a merchant's name in all writings of the record,
one element for the others); a band of the signature takes the MinHash of three attributes, and
records that share a band are candidates. Each candidate pair gets similarity features, and a logistic
classifier trained on weak labels gives it a calibrated probability. All candidates are compared, in
cells of two chunks of records (gleaner.llm.cells), and none is stored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.dates import parse_date_cell
from gleaner.functions.text import is_filler, squeeze
from gleaner.functions.values import let
from gleaner.llm import cells
from gleaner.llm.canonical import ADDITIONS, ASIDE, folded, words
from gleaner.operators.units import Reader, fits, money, to_int
from gleaner.session import BROADCAST_LIMIT, ensure_checkpoint_dir, own_exchange, small_side

# Words of offer titles that are no part of a merchant's name.
TITLE_WORDS = (
    "flat off on at orders order instant discount cashback of spends spend earn points point reward rewards deal for cardholders cardholder with get your bill extra savings save less money back "
    "percent pct per cent rs inr rupees paise thousand hundred lakh min minimum partner store stores by using use the cards card bank bk"
)
# Fixed pattern: the part of a title that states the least spend.
SPEND_TAIL = re.compile(r"(?:on|for|with)?\s*(?:a\s+)?min(?:imum|\.)?\s*(?:spend|order|transaction|trxn|booking)(?:\s+value)?\s*(?:of|:)?\s*(.*)$", re.IGNORECASE)


def value_of(text: str | None) -> tuple[str, int] | None:
    """('P', thousandths of a percent), ('X', thousandths) or ('F', paise): the first value that a text states."""
    if not text:
        return None
    r = Reader(text)
    for i in range(len(r.t)):
        if n := r.number(i):
            after = r.at(n[1])
            if after in ("%", "percent", "pct") or (after == "per" and r.at(n[1] + 1) == "cent"):
                return "P", to_int(n[0] * 1000)
            if after in ("x", "×"):
                return "X", to_int(n[0] * 1000)
        if (a := r.amount(i)) and money(a[1]):
            return "F", to_int(a[0] * a[1].scale)
    return None


def paise_of(text: str | None) -> int | None:
    """Paise of a cell that writes an amount; a number without a unit is in rupees."""
    if not text:
        return None
    r = Reader(text)
    for i in range(len(r.t)):
        if a := r.amount(i):
            return to_int(a[0] * (a[1].scale if money(a[1]) else 100))
    return None


def kind_of(title: str | None, benefit_type: str | None) -> str | None:
    """'points', 'cashback' or 'off', by the words of the title, else by the type."""
    t = (title or "").lower()
    if re.search(r"\b(?:points?|rewards?)\b|\d\s*x\b", t):
        return "points"
    if re.search(r"cash ?back|money back", t):
        return "cashback"
    if re.search(r"\b(?:off|less|discount|savings?)\b", t):
        return "off"
    b = re.sub(r"[^a-z]", "", (benefit_type or "").lower())
    return {"rewardmultiplier": "points", "cashback": "cashback", "percentagediscount": "off", "flatdiscount": "off"}.get(b)


def split_title(title: str | None) -> tuple[str, str]:
    """The title without its least spend, and the text of that spend."""
    m = SPEND_TAIL.search(title or "")
    return ((title or "")[: m.start()], m[1]) if m else (title or "", "")


ATTRIBUTES = "side string, id string, issuer string, slug string, name string, kind string, value_kind string, value bigint, spend bigint, until date, city string"


def _within(n: int | None) -> int | None:
    """A number that a BIGINT column can hold; a larger one is no value."""
    return n if fits(n) else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"side": pa.string(), "id": pa.string(), "issuer": pa.string(), "slug": pa.string(), "name": pa.string(), "kind": pa.string(), "value_kind": pa.string(), "value": pa.int64(), "spend": pa.int64(), "until": pa.date32(), "city": pa.string()}
    for b in batches:
        out = []
        for side, rid, issuer, slug, title, kind, value_text, percent, spend_text, until, city in zip(*(c.to_pylist() for c in b.columns), strict=True):
            head, tail = split_title(title)
            value = value_of(value_text) or (("P", round(percent * 1000)) if percent is not None and math.isfinite(percent) else None) or value_of(head)
            value = value if value and fits(value[1]) else (None, None)
            spend = _within(paise_of(spend_text))
            spend = _within(paise_of(tail)) if spend is None else spend
            out.append((side, rid, issuer, slug, head, kind_of(title, kind), *value, spend, until, city))
        columns = zip(*out, strict=True) if out else [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types))


def issuer_key(c: Column) -> Column:
    """The distinctive words of a bank's name, in lower case; null for none."""
    words = F.regexp_replace(F.lower(squeeze(c)), r"\b(bank|banks|bk|cards?|credit|ltd|limited|the)\b|[^a-z0-9 ]", " ")
    return F.nullif(squeeze(words), F.lit(""))


def cell(c: Column) -> Column:
    """The text of a cell, null for fillers."""
    return F.when(~is_filler(c), squeeze(c))


def attributes(bank_offers: DataFrame, partner_listings: DataFrame) -> DataFrame:
    """One row for each record of either side ('b' or 'l') with the common attributes; rows without an id left out."""
    b = bank_offers.select(
        F.lit("b").alias("side"), F.col("bank_offer_id").alias("id"), issuer_key(F.col("issuer")).alias("issuer"), cell(F.col("merchant_id")).alias("slug"), "title", "benefit_type",
        F.lit(None).cast("string").alias("value_text"), "discount_percentage", F.col("minimum_spend").cast("decimal(20,2)").cast("string").alias("spend_text"), F.col("valid_until").alias("until"), F.lit(None).cast("string").alias("city"),
    )
    until = parse_date_cell(F.col("valid_until"))
    p = partner_listings.select(
        F.lit("l").alias("side"), F.col("listing_id").alias("id"), issuer_key(F.col("bank_name")).alias("issuer"), cell(F.col("merchant_id")).alias("slug"), "title", "benefit_type",
        cell(F.col("benefit_value")).alias("value_text"), F.lit(None).cast("double").alias("discount_percentage"), cell(F.col("minimum_spend")).alias("spend_text"), until.alias("until"), cell(F.col("city")).alias("city"),
    )
    return b.unionByName(p).where("id is not null").mapInArrow(_read, ATTRIBUTES)


#: The end of a title that says with whose cards an offer holds.
WITH_CARD = r"(?i)\bwith\s+\S+(?:\s+\S+){0,2}\s*$"


def with_merchants(rows: DataFrame, merchants: DataFrame) -> DataFrame:
    """`rows` with `m_name` and `m_slug`: the letters of the merchant that the title and the slug name, null for none, and `listed`.

    Words of titles, additions, and those of the record's own issuer and city are no part of a name; an
    alias stands for its merchant's name. `listed` is the first of the two that is a name of the
    reference list as it stands. Nothing is corrected here: names written in different ways are
    compared by their shingles.
    """
    common = list(dict.fromkeys((*TITLE_WORDS.split(), *ADDITIONS)))
    own = F.concat(words(folded(F.coalesce("issuer", F.lit("")))), words(folded(F.coalesce("city", F.lit("")))))

    def letters(text: Column, free: Column | None = None) -> Column:
        found = words(folded(text))
        return F.nullif(F.array_join(found if free is None else F.array_except(F.filter(found, lambda w: ~w.isin(*common)), free), ""), F.lit(""))

    title = F.regexp_replace(F.regexp_replace(F.regexp_replace("name", WITH_CARD, " "), ASIDE, " "), r"\S*\p{N}\S*", " ")
    slug = F.regexp_replace(F.lower("slug"), r"^m[_-]|[_-]+", " ")
    rows = rows.withColumn("free", own).withColumn("m_name", letters(title, F.col("free"))).withColumn("m_slug", letters(slug, F.col("free"))).drop("free", "name", "slug", "city")
    m = merchants.where("merchant_name is not null")
    named = m.select(letters(F.col("merchant_name")).alias("text"), letters(F.col("merchant_name")).alias("meant"))
    alias = m.select(letters(F.col("merchant_name")).alias("meant"), F.explode("merchant_aliases").alias("alias")).select(letters(F.col("alias")).alias("text"), "meant")
    listed = named.unionByName(alias.join(named.select("text"), "text", "left_anti")).where("text is not null").groupBy("text").agg(F.min("meant").alias("meant"), F.max("meant").alias("other"))
    listed = listed.where("meant = other").select("text", "meant").checkpoint()  # the reference list is fixed and small
    for c in ("m_name", "m_slug"):
        by = small_side(listed.select(F.col("text").alias(c), F.col("meant").alias(f"{c}_listed")))
        rows = rows.join(by, c, "left").withColumn(c, F.coalesce(f"{c}_listed", c))
    return rows.withColumn("listed", F.coalesce("m_name_listed", "m_slug_listed")).drop("m_name_listed", "m_slug_listed")


# --- candidates ------------------------------------------------------------------------------------

#: The attributes that make the signature, and all their triples: the attributes of a band.
TOKENS = ("merchant", "issuer", "value", "spend", "until")
TRIPLES = tuple(combinations(range(len(TOKENS)), 3))
#: Days by which the last day may be written off, and the width of a date bucket (at least twice as wide).
DAYS_OFF, BUCKET = 3, 16
#: Bands for each triple with the merchant, and MinHashes of its shingles in each.
BANDS, ROWS = 3, 2
#: Bank records of one block from which it is refined by further attributes.
HOT = 64


def trigrams(text: Column) -> Column:
    """The letter trigrams of a text, its ends marked; empty for null."""
    t = F.concat(F.lit("  "), text, F.lit("  "))
    return F.coalesce(F.transform(F.sequence(F.lit(1), F.char_length(t) - 2), lambda i: F.substring(t, i, 3)), F.array().cast("array<string>"))


def minhash_bands(shingles: Column, bands: int = BANDS, rows: int = ROWS) -> Column:
    """The MinHash signature of a set of shingles, each band of `rows` minima as one hash; null for an empty set.

    Two sets of Jaccard likeness J agree in a band with chance J ** rows. Each shingle is hashed once,
    and that hash again for each minimum.
    """

    def bands_of(hashes: Column) -> Column:
        least = lambda r: F.array_min(F.transform(hashes, lambda h: F.xxhash64(F.lit(r), h)))
        return F.array(*[F.xxhash64(*[least(b * rows + r) for r in range(rows)]) for b in range(bands)])

    return F.when(F.size(shingles) > 0, let(F.transform(shingles, lambda g: F.xxhash64(g)), bands_of))


def _value() -> Column:
    return F.concat("value_kind", F.col("value").cast("string"))


def _rid() -> Column:
    return F.xxhash64("side", "id", "m_name", "m_slug", "listed", "issuer", "kind", _value(), "spend", "until").alias("rid")


def _merchant_tokens() -> Column:
    return minhash_bands(F.array_union(trigrams(F.col("m_name")), trigrams(F.col("m_slug"))))


def with_tokens(rows: DataFrame) -> DataFrame:
    """`rows` with `rid` and what each attribute gives to the signature; of the last day a listing has the buckets within DAYS_OFF."""
    day = F.datediff("until", F.lit("1970-01-01").cast("date"))
    bucket = lambda by: F.floor((day + by) / BUCKET)
    spread = F.when(F.col("side") == "l", F.array_distinct(F.array(bucket(-DAYS_OFF), bucket(DAYS_OFF)))).otherwise(F.array(bucket(0)))
    return rows.select(
        _rid(), "side", "id", "m_name", "m_slug", "listed", "issuer", "kind", "spend", "until", _value().alias("value"),
        _merchant_tokens().alias("m_tokens"),
        F.when(F.col("until").isNotNull(), spread).alias("buckets"),
    ).dropDuplicates(["rid"])


#: Parts into which the hash of a record says whether training reads it.
DRAWS = 1_000_000


def packed(rows: DataFrame, n_bank: int, n_listings: int) -> DataFrame:
    """`rows` as chunks of one side (cells.PACKED), spread by id over that many parts for each side; equal rows once."""
    spread = lambda n, after: (F.pmod(F.xxhash64("id"), F.lit(n)) + after).cast("int")
    part = F.when(F.col("side") == "b", spread(n_bank, 0)).otherwise(spread(n_listings, n_bank))
    rows = rows.repartitionById(n_bank + n_listings, part).sortWithinPartitions("side", "id")
    code = lambda c: F.when(c.isNotNull(), F.xxhash64(c))
    hashed = {"issuer": F.col("issuer"), "value": _value(), "kind": F.col("kind"), "listed": F.col("listed"), "merchant": F.coalesce("m_name", "m_slug")}
    rows = rows.select("*", _rid(), _merchant_tokens().alias("m_tokens"))
    return rows.select(
        "side", "id", "rid", F.pmod(F.xxhash64("rid"), F.lit(DRAWS)).cast("int").alias("draw"), "m_name", "m_slug", *[code(c).alias(n) for n, c in hashed.items()], "spend",
        F.datediff("until", F.lit("1970-01-01").cast("date")).alias("until"), *[F.col("m_tokens")[i].alias(f"band_{i}") for i in range(BANDS)],
    ).mapInArrow(cells.pack, cells.PACKED)


def _hashes(subset: tuple[int, ...], also: Sequence[Column] = ()) -> Column:
    """The keys of a record for the attributes `subset`: one for each band of the merchant and bucket of the day; null where it lacks one."""
    fixed = {1: F.xxhash64("issuer"), 2: F.xxhash64("value"), 3: F.col("spend")}
    there = F.lit(True)
    for i in subset:
        there = there & F.col(("m_tokens", "issuer", "value", "spend", "buckets")[i]).isNotNull()
    head = [F.lit(sum(1 << i for i in subset)), *[fixed[i] for i in subset if i in fixed], *also]
    per_day = lambda more: F.transform("buckets", lambda d: F.xxhash64(*head, *more, d)) if 4 in subset else F.array(F.xxhash64(*head, *more))
    keys = F.flatten(F.array(*[per_day([F.lit(b), F.col("m_tokens")[b]]) for b in range(BANDS)])) if 0 in subset else per_day([])
    return F.when(there, keys)


#: The last bits of a key tell its triple, and whether it stands for attributes that are missing.
TRIPLE_BITS, MISSING = 31, 16


def _marked(keys: Column, triple: int) -> Column:
    """The keys with the number of their triple; no key for null."""
    return F.coalesce(F.transform(keys, lambda k: k.bitwiseAND(~TRIPLE_BITS).bitwiseOR(triple)), F.array().cast("array<bigint>"))


def block_keys(rows: DataFrame) -> DataFrame:
    """(key, rid) of each row, once for each band: skinny rows, attributes are joined to the pairs afterwards."""
    found = [_marked(_hashes(t), n) for n, t in enumerate(TRIPLES)]
    return rows.select("rid", F.explode(F.flatten(F.array(*found))).alias("key"))


def refined_keys(hot: DataFrame, rows: DataFrame, whole: bool, bank: bool) -> DataFrame:
    """(key, rid) of the rows of hot blocks (key, rid), divided by one further attribute, or by all and the kind.

    The key of the block is part of the new ones, so a pair meets again if it agrees in a further
    attribute too. It also meets if it can neither agree nor differ in the two others because the bank's
    record lacks both, or lacks one and the listing the other; such blocks are divided by the kind.
    """
    joined = hot.join(rows, "rid")
    kind = F.coalesce(F.xxhash64("kind"), F.lit(0))
    lacks = [F.col(c).isNull() for c in ("m_tokens", "issuer", "value", "spend", "buckets")]
    none = F.array().cast("array<bigint>")
    found = F.when(F.col("key").bitwiseAND(MISSING) != 0, F.array(F.xxhash64("key", kind).bitwiseOR(TRIPLE_BITS))) if whole else F.lit(None).cast("array<bigint>")
    for n, t in enumerate(TRIPLES):
        x, y = sorted(set(range(5)) - set(t))
        if whole:
            keys = _marked(_hashes((x, y), [F.col("key"), kind]), n)
        else:
            open_ = [(lacks[x] & lacks[y], lacks[x], lacks[y]), (F.lit(True), lacks[y], lacks[x])][0 if bank else 1]
            missing = F.array_compact(F.array(*[F.when(c, F.xxhash64("key", F.lit(i))) for i, c in enumerate(open_)]))
            keys = F.flatten(F.array(*[_marked(_hashes((i,), [F.col("key")]), n) for i in (x, y)], _marked(missing, n + MISSING)))
        found = F.coalesce(found, F.when(F.col("key").bitwiseAND(TRIPLE_BITS) == n, F.coalesce(keys, none)))
    return joined.select("rid", F.explode(found).alias("key"))


def hot_keys(keys: DataFrame) -> DataFrame:
    """(key, n) of the blocks that hold more than HOT bank records."""
    return keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT)


def candidate_pairs(bank: DataFrame, listings: DataFrame) -> DataFrame:
    """(b, l): the rids of the pairs that share a band, each once, but for what hot blocks leave out; those are `left_out_pairs`.

    For a look at the blocks only: what is matched are all pairs, by `candidate_cells`. A block of more than HOT bank records is not compared as it is: its records meet in it only where
    they also agree in a fourth attribute, or cannot differ in one as both others are missing; where that
    is hot too, in all five and the kind. What is left out is a pair that agrees in the three attributes
    of a hot block only and differs in another, or whose listing states no other, so that HOT rivals fit as well.
    """
    keys = {"b": block_keys(bank), "l": block_keys(listings)}
    rows = {"b": bank, "l": listings}
    pairs = []
    for step in range(3):
        usual, hot = keys, None
        if step < 2:
            hot = hot_keys(keys["b"]).select("key", F.lit(True).alias("hot")).checkpoint()
            hot = None if hot.isEmpty() else own_exchange(hot)
        if hot is not None:
            parted = {s: keys[s].join(hot, "key", "left") for s in keys}
            usual = {s: parted[s].where("hot is null") for s in keys}
            keys = {s: refined_keys(parted[s].where("hot").select("key", "rid"), rows[s], whole=step == 1, bank=s == "b").checkpoint() for s in keys}
        pairs.append(usual["b"].select("key", F.col("rid").alias("b")).join(usual["l"].select("key", F.col("rid").alias("l")), "key").select("b", "l"))
        if hot is None:
            break  # nothing is left to refine
    out = pairs[0]
    for p in pairs[1:]:
        out = out.unionByName(p)
    return out.distinct()


def left_out_pairs(bank: DataFrame, listings: DataFrame) -> DataFrame:
    """(b, l): the rids of the pairs that share a band and are not in `candidate_pairs`, each once; both together are all pairs.

    The hot blocks are compared whole here. Each is cut into pieces of about HOT bank records, and its
    listings meet every piece, so no task has to hold a block.
    """
    keys = {"b": block_keys(bank), "l": block_keys(listings)}
    hot = own_exchange(hot_keys(keys["b"]).select("key", F.ceil(F.col("n") / HOT).alias("pieces")).checkpoint())
    parted = {s: keys[s].join(hot, "key") for s in keys}
    b = parted["b"].select("key", F.pmod(F.xxhash64("rid"), "pieces").alias("piece"), F.col("rid").alias("b"))
    met = parted["l"].select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"), F.col("rid").alias("l")).join(b, ["key", "piece"]).select("b", "l")
    return met.distinct().join(candidate_pairs(bank, listings), ["b", "l"], "left_anti")


# --- features, weak labels, classifier --------------------------------------------------------------

#: Bounds of what training reads: listings drawn for it, and pairs taken to the driver.
TRAIN_LISTINGS, TRAIN_PAIRS = 10_000, 60_000
#: Least confidence of an accepted pair.
ACCEPT = 0.5
#: Likeness from which two merchants' letters count as one name, and below which as two.
LIKE, UNLIKE = 0.75, 0.5
#: Attributes that are compared, and those of them whose conflict makes another offer.
COMPARED = ("merchant", "issuer", "value", "spend", "until", "kind")
HARD = 5
FEATURES = ("chance", *[f"x_{c}" for c in COMPARED], *[f"n_{c}" for c in COMPARED], "half", "unlike", "days")
#: What the weights are drawn to, as far as labels do not say otherwise, and how strongly.
PRIOR = np.array([-1.0, *[-6.0] * 4, -8.0, -3.0, *[0.0] * 6, 1.0, -2.0, -0.5, 0.0])
PENALTY = 0.5


RULES = cells.Rules(LIKE, UNLIKE, DAYS_OFF, BUCKET, COMPARED)


@dataclass(frozen=True)
class Cells:
    """All pairs of chunks (chunks of bank records with `rare`), and of the bank's records the log of their number and how rare an equal day is."""

    cells: DataFrame
    log_n: float
    every_day: float


def candidate_cells(chunks: DataFrame) -> Cells:
    """The cells of packed chunks, in which every pair that shares a band is compared.

    `rare` has -log of the share of bank records that have the same value, for each value of the
    chunk. Chunks of bank records are broadcast if they are small as measured, else the cells are a
    product of stored partitions, which shuffles nothing.
    """
    bank, listings = (chunks.where(F.col("side") == s).select("chunk", "data", "n") for s in "bl")
    total = float(max(1, bank.agg(F.sum("n")).first()[0] or 0))
    counts = bank.mapInArrow(cells.value_counts, "chunk bigint, c string, v bigint, n bigint")
    counted = counts.groupBy("c", "v").agg(F.sum("n").alias("n"))
    days = counted.where("c = 'until'").count() or 1
    rarity = counted.where("c <> 'until'").select("c", "v", (-F.log(F.col("n") / F.lit(total))).alias("r"))
    rare = counts.select("chunk", "c", "v").join(own_exchange(rarity), ["c", "v"]).groupBy("chunk").agg(F.collect_list(F.struct("c", "v", "r")).alias("rare"))
    bank = bank.join(rare, "chunk", "left").select(F.col("data").alias("b_data"), "rare").checkpoint()
    size = bank.agg(F.sum(F.length("b_data") + 64 * F.coalesce(F.size("rare"), F.lit(0)))).first()[0] or 0
    listings = listings.select(F.col("chunk").alias("l_chunk"), F.col("data").alias("l_data"))
    return Cells(listings.crossJoin(F.broadcast(bank) if size <= BROADCAST_LIMIT else bank), math.log(total), math.log(max(1.0, days / (2 * DAYS_OFF + 1))))


def compared(found: Cells, drawn: int | None = None) -> DataFrame:
    """Every candidate pair with its ids, the rids b and l, and how its attributes compare (cells.compare); of listings with draw < `drawn` only, if given."""
    kinds = "b_id string, l_id string, b bigint, l bigint, " + ", ".join([f"a_{c} int" for c in COMPARED] + [f"g_{c} double" for c in COMPARED] + [f"{c} double" for c in ("half", "unlike", "days", "log_n")])
    return found.cells.mapInArrow(cells.compared_rows(RULES, found.log_n, found.every_day, drawn), kinds)


def weak_labels(pairs: pd.DataFrame) -> np.ndarray:
    """1, 0 or nan (undecided) for each compared pair, from all that both records state.

    A pair without a conflict that is hardly to be expected by accident, and is the only one of its
    listing without a conflict, is the same offer, and every other pair of that listing another one.
    A conflict in the last day (another run of the same terms) or two in merchant, issuer, value and
    spend make another offer; a single one, where all else is hardly to be expected by accident, may be
    a coarse or misread entry and decides nothing.
    """
    against = (pairs[[f"a_{c}" for c in COMPARED[:HARD]]] < 0).sum(axis=1).to_numpy()
    conflict, run = against > 0, (pairs["a_until"] < 0).to_numpy()
    chance = pairs["log_n"].to_numpy() - sum((pairs[f"a_{c}"] > 0) * pairs[f"g_{c}"] for c in COMPARED).to_numpy()
    free = pd.Series(~conflict).groupby(pairs["l"].to_numpy()).transform("sum").to_numpy()
    sure = ~conflict & (free == 1) & (chance < math.log(0.05))
    known = pd.Series(sure).groupby(pairs["l"].to_numpy()).transform("any").to_numpy()
    coarse = (against == 1) & ~run & (chance < math.log(0.05))
    return np.where(sure, 1.0, np.where(known | (conflict & ~coarse), 0.0, np.nan))


def masked(pairs: pd.DataFrame, rng: np.random.Generator, copies: int = 3) -> pd.DataFrame:
    """The pairs as they are and `copies` times with up to two attributes of each listing hidden.

    The labels were given from all attributes, so what the classifier learns of the hidden ones'
    weight is not the rule that made the labels: it sees what a record looks like that lacks them.
    """
    out = [pairs]
    codes, _ = pd.factorize(pairs["l"])
    for _ in range(copies):
        n = codes.max(initial=-1) + 1
        hide = np.zeros((n, len(COMPARED)), bool)
        for k in range(2):
            hide[np.arange(n), rng.integers(0, len(COMPARED), n)] |= rng.random(n) < (0.9, 0.4)[k]
        part = pairs.copy()
        for i, c in enumerate(COMPARED):
            part.loc[hide[codes, i], f"a_{c}"] = 0
        part.loc[hide[codes, 0], "half"] = 0.0
        out.append(part)
    return pd.concat(out, ignore_index=True)


def feature_columns() -> dict[str, Column]:
    """FEATURES of compared pairs: the log of the number of bank records that would agree as much by accident, what differs and what a side lacks."""
    a = {c: F.col(f"a_{c}") for c in COMPARED}
    chance = F.col("log_n") - sum((F.when(a[c] > 0, F.col(f"g_{c}")).otherwise(0.0) for c in COMPARED), F.lit(0.0))
    return {
        "chance": chance, **{f"x_{c}": (a[c] < 0).cast("double") for c in COMPARED}, **{f"n_{c}": (a[c] == 0).cast("double") for c in COMPARED},
        "half": F.col("half"), "unlike": F.when(a["merchant"] > 0, F.col("unlike")).otherwise(0.0), "days": F.when(a["until"] > 0, F.col("days")).otherwise(0.0),
    }


def feature_matrix(pairs: pd.DataFrame) -> np.ndarray:
    """The same as `feature_columns` for pairs on the driver."""
    a = pairs[[f"a_{c}" for c in COMPARED]].to_numpy()
    g = pairs[[f"g_{c}" for c in COMPARED]].to_numpy()
    chance = pairs["log_n"].to_numpy() - (g * (a > 0)).sum(1)
    unlike, days = pairs["unlike"].to_numpy() * (a[:, 0] > 0), pairs["days"].to_numpy() * (a[:, 4] > 0)
    return np.column_stack([chance, a < 0, a == 0, pairs["half"].to_numpy(), unlike, days]).astype(float)


@dataclass(frozen=True)
class Model:
    """A logistic classifier over FEATURES (weights, the bias last), and the scaling that calibrates its score."""

    weights: np.ndarray
    slope: float
    shift: float

    def odds(self, pairs: dict[str, np.ndarray]) -> np.ndarray:
        """The calibrated odds of compared pairs."""
        z = feature_matrix(pd.DataFrame(pairs, copy=False)) @ self.weights[:-1] + self.weights[-1]
        return np.exp(np.minimum(z * self.slope + self.shift, 60.0))


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, penalty: float) -> np.ndarray:
    """The weights (the bias last) most likely for labels y under a normal prior, by Newton's method; the prior itself without labels."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w, ridge = prior.astype(float).copy(), penalty * np.eye(len(prior))

    def loss(w: np.ndarray) -> float:
        z = x1 @ w
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + penalty / 2 * ((w - prior) ** 2).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + ridge, x1.T @ (y - p) - ridge @ (w - prior))
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return w


def fit(pairs: pd.DataFrame, seed: int = 0) -> Model:
    """The classifier, fitted on the labelled pairs of four fifths of the listings and calibrated on those of the rest.

    One rule for every size: weights and calibration start from PRIOR and from the score as it is, and
    move as far as the labels say; without labels they stay there.
    """
    rng = np.random.default_rng(seed)
    labelled = pairs.assign(y=weak_labels(pairs)).pipe(lambda d: d[d["y"].notna()])
    codes, listings = pd.factorize(labelled["l"])
    held = (rng.random(len(listings)) < 0.2)[codes]
    w_x = masked(labelled[~held], rng)
    weights = _logistic(feature_matrix(w_x), w_x["y"].to_numpy(float), PRIOR, PENALTY)
    c_x = masked(labelled[held], rng)
    z = feature_matrix(c_x) @ weights[:-1] + weights[-1]
    slope, shift = _logistic(z[:, None], c_x["y"].to_numpy(float), np.array([1.0, 0.0]), PENALTY)
    return Model(weights, float(max(slope, 1e-3)), float(shift))


def train(found: Cells, n_listings: int) -> Model:
    """The model of the weakly labelled candidate pairs of at most about TRAIN_LISTINGS listings, drawn by hash, and at most TRAIN_PAIRS pairs."""
    share = int(min(1.0, TRAIN_LISTINGS / max(1, n_listings)) * DRAWS)
    rows = compared(found, share).orderBy(F.xxhash64("l"), "b_id").limit(TRAIN_PAIRS)
    return fit(rows.drop("b_id", "l_id", "b").toPandas())


def match_offers(bank_offers: DataFrame, partner_listings: DataFrame, merchants: DataFrame) -> DataFrame:
    """(bank_offer_id, listing_id, confidence) of the accepted pairs.

    The confidence is the chance of a pair if its listing is at most one of its candidates: its odds
    by the calibrated classifier, over one plus those of all candidates of the listing. So a listing
    that fits two offers equally well is given to neither. Null attributes take no part on either
    side; equal rows count once; a record version that differs under one id takes part by itself, and
    a pair has the best odds of them.
    """
    spark = bank_offers.sparkSession
    ensure_checkpoint_dir(spark)
    n_bank, n_listings = bank_offers.count(), partner_listings.count()
    chunks = lambda n: math.ceil(n / cells.CHUNK)
    rows = with_merchants(attributes(bank_offers, partner_listings), merchants)
    chunks = packed(rows, max(1, chunks(n_bank)), max(2 * spark.sparkContext.defaultParallelism, chunks(n_listings))).checkpoint()  # read by Python once
    found = candidate_cells(chunks)
    model = train(found, chunks.where("side = 'l'").agg(F.sum("n")).first()[0] or 0)
    best = found.cells.mapInArrow(cells.best_rows(RULES, found.log_n, found.every_day, model.odds), "l_id string, odds double, b_id string, all double")
    best = best.groupBy("l_id").agg(F.max(F.struct("odds", "b_id")).alias("top"), F.sum("all").alias("all"))
    confidence = F.round(F.col("top.odds") / (1 + F.col("all")), 6)
    return best.select(F.col("top.b_id").alias("bank_offer_id"), F.col("l_id").alias("listing_id"), confidence.alias("confidence")).where(F.col("confidence") > ACCEPT)
