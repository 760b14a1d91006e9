"""Free-entered values mapped to the entries of a reference list.

Each distinct token of the typed values is repaired first: joined to the reference vocabulary by edit
distance (over shared deletions of one or two letters, so without a cross join). The repaired tokens of a value
are then combined by soft TF-IDF to rank the complete entries, and the score decides on what is not written in full.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import squeeze
from gleaner.operators.orphans import url_slug
from gleaner.session import ensure_checkpoint_dir, own_exchange, small_side

UNMATCHED = "UNMATCHED"

#: Least length of a token for a repair of one edit (a swap of neighbours counts as one), and for one of two.
ONE_EDIT, TWO_EDITS = 2, 8
#: Least length of a token whose repair can contradict an entry; shorter ones resemble too much by accident.
FIRM = 4
#: How many times the largest IDF weight a word counts that nothing explains, and the least score of an entry not written in full.
GAP, LEAST = 3.0, 0.55
#: What stands in brackets or behind a comma is beside the name.
ASIDE = r"\([^)]*\)?|\[[^\]]*\]?|,.*$"

# Words that may stand beside any name and say nothing about it.
ADDITIONS = (
    "a", "an", "and", "at", "by", "for", "from", "in", "of", "on", "the", "with", "pvt", "private", "ltd", "limited", "llp", "inc", "corp", "co", "company", "group", "india", "indian", "bharat",
    "official", "online", "offline", "store", "stores", "shop", "shops", "shopping", "outlet", "outlets", "showroom", "branch", "website", "web", "site", "www", "http", "https", "com", "net", "org", "example", "app",
    "gift", "voucher", "vouchers", "evoucher", "coupon", "offer", "offers", "deal", "deals", "sale", "brand", "merchant", "partner", "card", "cards", "credit", "cc", "bank", "branded", "html", "htm", "php", "aspx",
)


def _plain_letters() -> tuple[str, str]:
    """Letters with accents and wide forms, and what is left of each without."""
    pairs = []
    for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]):
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(base) == 1 and base != c:
            pairs.append((c, base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _plain_letters()


def folded(text: Column) -> Column:
    """Lower case without accents; signs such as the trademark sign as blanks."""
    bare = F.regexp_replace(F.translate(text, ACCENTED, PLAIN), r"[\u0300-\u036f]", "")
    return F.lower(F.regexp_replace(bare, r"[\p{So}\p{Sk}\p{Cf}]", " "))


def words(text: Column) -> Column:
    """The distinct words of folded text: runs of letters and digits; apostrophes and an & between letters join."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(text, r"['’`]|(?<=\p{L})&(?=\p{L})", ""), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def deletions(token: Column) -> Column:
    """The token and all tokens that lack one of its letters."""
    n = F.char_length(token)
    return F.array_distinct(F.concat(F.array(token), F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(token, F.lit(1), i - 1), F.substring(token, i + 1, n)))))


def deletion_keys(token: Column) -> Column:
    """struct(key, depth) of a token: hashes of `deletions` under depth 1, for long tokens those that lack two letters under 2."""
    one = deletions(token)
    two = F.array_except(F.flatten(F.transform(one, deletions)), one)
    hashed = lambda xs, depth: F.transform(xs, lambda x: F.struct(F.xxhash64(x).alias("key"), F.lit(depth).alias("depth")))
    return F.when(F.char_length(token) >= TWO_EDITS, F.concat(hashed(one, 1), hashed(two, 2))).otherwise(hashed(one, 1))


def reference_names(rows: DataFrame) -> DataFrame:
    """(kind, entry, name_id, need, all) of rows (kind, entry, name, optional).

    `need` are the words of a name, `all` those that it may be written with besides: an optional word
    (an issuer, say) is no contradiction in a typed value and not missed in it.
    """
    f = rows.where("name is not null").select("kind", "entry", words(folded(F.col("name"))).alias("named"), words(folded(F.coalesce("optional", F.lit("")))).alias("opt"))
    named = f.select("kind", "entry", F.array_except("named", "opt").alias("need"), "opt")
    named = named.where(F.size("need") > 0).distinct()
    return named.select("kind", "entry", F.xxhash64("kind", "entry", "need").alias("name_id"), "need", F.array_union("need", "opt").alias("all"))


def vocabulary(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(index, weights): the names of each reference token with the words it covers, and the words' IDF.

    A token is a word of a name, or the name (as a whole or but for its first or last word) written
    in one, which covers all those words.
    """
    one = names.select("kind", "name_id", F.explode("all").alias("vt")).select("kind", "name_id", "vt", F.array("vt").alias("covers"))
    run = F.explode(F.array("need", F.slice("need", F.lit(2), F.size("need")), F.slice("need", F.lit(1), F.size("need") - 1))).alias("covers")
    joined = names.where(F.size("need") > 1).select("kind", "name_id", run).where(F.size("covers") > 1).select("kind", "name_id", F.array_join("covers", "").alias("vt"), "covers")
    index = one.unionByName(joined).groupBy("kind", "name_id", "vt").agg(F.max("covers").alias("covers"))
    total = names.groupBy("kind").agg(F.countDistinct("name_id").alias("n"))
    weights = one.groupBy("kind", "vt").agg(F.countDistinct("name_id").alias("df")).join(total, "kind").select("kind", "vt", F.log(1 + F.col("n") / F.col("df")).alias("idf"))
    return index, weights


def repair(tokens: DataFrame, vocab: DataFrame, longest: int) -> DataFrame:
    """(kind, tok, vt, sim): each distinct typed token with the nearest reference tokens.

    A token of the vocabulary stands for itself. Others are repaired by one edit, long ones by any
    two, a swap of neighbours counting as one; only the nearest candidates stay, all of them if they are as near. Tokens longer than any in the vocabulary cannot match and are left out.
    """
    exact = tokens.join(small_side(vocab), (tokens.tok == vocab.vt) & (tokens.kind == vocab.k), "left").select(tokens.kind, "tok", "vt")
    same = exact.where("vt is not null").select("kind", "tok", "vt", F.lit(1.0).alias("sim"))
    unknown = exact.where(F.col("vt").isNull() & F.char_length("tok").between(ONE_EDIT, longest + 2)).select("kind", "tok")
    typed = unknown.select("kind", "tok", F.inline(deletion_keys(F.col("tok"))))
    known = vocab.where(F.char_length("vt") >= ONE_EDIT).select(F.col("k").alias("kind"), "vt", F.inline(deletion_keys(F.col("vt")))).withColumnRenamed("depth", "known_depth")
    n = F.greatest(F.char_length("tok"), F.char_length("vt"))
    edits = F.levenshtein("tok", "vt")
    swap = (edits == 2) & (F.col("depth") == 1) & (F.char_length("tok") == F.char_length("vt")) & (F.array_sort(F.split("tok", "")) == F.array_sort(F.split("vt", "")))
    exchanged = lambda i: F.concat(F.substring("tok", F.lit(1), i - 1), F.substring("tok", i + 1, F.lit(1)), F.substring("tok", i, F.lit(1)), F.substring("tok", i + 2, n))
    swap_and_one = (edits == 3) & F.exists(F.sequence(F.lit(1), F.char_length("tok") - 1), lambda i: F.levenshtein(exchanged(i), F.col("vt")) <= 1)
    cost = F.when((edits <= 1) | swap, 1).when((n >= TWO_EDITS) & ((edits == 2) | swap_and_one), 2)
    shared = typed.join(known.hint("merge"), ["kind", "key"])  # the estimate behind `small_side` does not see how many keys a token has
    near = shared.groupBy("kind", "tok", "vt").agg(F.min(F.greatest("depth", "known_depth")).alias("depth")).withColumn("cost", cost).where("cost is not null")
    best = near.groupBy("kind", "tok").agg(F.min("cost").alias("least"))
    fixed = near.join(best, ["kind", "tok"]).where("cost = least").select("kind", "tok", "vt", (1 - F.col("cost") / n).alias("sim"))
    return same.unionByName(fixed)


def map_values(values: DataFrame, names: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """(kind, raw, canonical, score) of each distinct row (kind, raw) of `values` that means an entry.

    An entry is a candidate through any of its words: it has one of the typed words or their repairs
    and is contradicted by none. A typed word contradicts an entry if it is, or is repaired to, a
    reference word that the entry does not have (another line of business); repairs of words under
    FIRM letters and ADDITIONS never do. A word that resembles nothing in the reference list is an
    addition if it is a single letter, stands ASIDE or is one of ADDITIONS or of `places` (word), else a
    gap: it may name another line of business that is not listed, and lowers the score.

    The score is the soft TF-IDF cosine of value and entry, gaps counted with GAP times the largest
    weight. An entry is meant if it ranks first and all its words are there, and if it has one word
    only, no gap is; or if it is the only candidate and scores LEAST or more. Else the value has no
    row, as with no candidate or with equal first ranks. Null and blank values give no row either.

    As a candidate must have all the firm words of a value, the entries of its rarest word hold them
    all: no candidate is dropped, and words that many entries share multiply no rows.
    """
    ensure_checkpoint_dir(values.sparkSession)
    names = names.checkpoint()  # the reference list is fixed and small; so are all tables made of it
    index, weights = (t.checkpoint() for t in vocabulary(names))
    longest = index.agg(F.max(F.char_length("vt"))).first()[0] or 0
    # Of each name: its words, the weight of all of them, and what each token covers.
    total = names.groupBy("kind").agg(F.countDistinct("name_id").alias("n_names"))
    word = names.select("kind", "name_id", "entry", F.size("need").alias("n_need"), F.explode("need").alias("vt")).join(weights, ["kind", "vt"])
    meta = word.groupBy("kind", "name_id", "entry", "n_need").agg(F.sum(F.col("idf") ** 2).alias("norm"))
    covers = index.join(names.select("kind", "name_id", "need"), ["kind", "name_id"]).select("kind", "vt", "name_id", F.array_intersect("covers", "need").alias("covers")).join(meta, ["kind", "name_id"])
    entries = covers.groupBy("kind", "name_id", "entry", "n_need", "norm").agg(F.map_from_entries(F.collect_list(F.struct("vt", "covers"))).alias("index"))
    entries = entries.join(total, "kind").select("*", (F.log(1 + F.col("n_names")) ** 2).alias("top_w2")).drop("n_names").checkpoint()
    idf = index.select("kind", "vt", F.explode("covers").alias("w")).distinct().join(weights.withColumnRenamed("vt", "w"), ["kind", "w"]).groupBy("kind", "vt").agg(F.sum(F.col("idf") ** 2).alias("w2"))
    # The names that have a token; null for one that all have (an optional word of all), as it tells nothing apart.
    having = index.groupBy("kind", "vt").agg(F.collect_set("name_id").alias("names")).join(total, "kind")
    having = having.select("kind", "vt", F.when(F.size("names") < F.greatest("n_names", F.lit(2)), F.col("names")).alias("names"))
    known = idf.join(having, ["kind", "vt"]).checkpoint()

    distinct = values.where(squeeze(F.col("raw")) != "").select("kind", "raw").distinct().checkpoint()  # far fewer than rows, and used three times
    own = words(folded(F.regexp_replace("raw", ASIDE, " ")))
    typed = distinct.select("kind", "raw", own.alias("own"), F.explode(words(folded(F.col("raw")))).alias("tok")).select("kind", "raw", "tok", F.array_contains("own", F.col("tok")).alias("inside"))
    tokens = typed.select("kind", "tok").distinct().checkpoint()
    fixed = repair(tokens, index.select(F.col("kind").alias("k"), "vt").distinct(), longest)
    # Each typed token with its repairs and the names that have one of them.
    firm = ~F.col("tok").isin(*ADDITIONS) & ((F.col("sim") == 1) | ((F.char_length("tok") >= FIRM) & (F.char_length("vt") >= FIRM)))
    repaired = (
        fixed.join(small_side(known), ["kind", "vt"])
        .groupBy("kind", "tok")
        .agg(
            F.collect_list(F.struct("vt", "sim", "w2")).alias("fixes"), F.bool_or(firm).alias("firm"), F.max("w2").alias("w2"),
            F.when(F.bool_and(F.col("names").isNotNull()), F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"),
        )
    )
    bare = tokens.join(repaired.select("kind", "tok"), ["kind", "tok"], "left_anti").where(~F.col("tok").isin(*ADDITIONS) & (F.char_length("tok") > 1))
    if places is not None:
        bare = bare.join(places.select(F.explode(words(folded(F.col("word")))).alias("tok")).distinct(), "tok", "left_anti")
    fixes_type = "array<struct<vt:string,sim:double,w2:double>>"
    gaps = bare.select("kind", "tok", F.lit(None).cast(fixes_type).alias("fixes"), F.lit(False).alias("firm"), F.lit(0.0).alias("w2"), F.lit(None).cast("array<bigint>").alias("names"))
    per_token = own_exchange(repaired.unionByName(gaps))
    # All that follows is grouped within the value, on the partitioning of this one shuffle.
    within = (
        typed.join(per_token, ["kind", "tok"])
        .groupBy("kind", "raw")
        .agg(
            F.collect_list(F.when(F.col("fixes").isNotNull(), F.struct("fixes", "firm", "w2"))).alias("tokens"), F.count_if(F.col("fixes").isNull() & F.col("inside")).alias("gaps"),
            F.collect_list(F.when(F.col("firm"), F.col("names"))).alias("firm_names"), F.collect_list(F.when(~F.col("firm"), F.col("names"))).alias("loose_names"),
        )
    )
    common = F.aggregate(F.slice("firm_names", F.lit(2), F.size("firm_names")), F.get("firm_names", F.lit(0)), lambda acc, x: F.array_intersect(acc, x))
    chosen = F.when(F.size("firm_names") > 0, common).otherwise(F.array_distinct(F.flatten("loose_names")))

    def nearest(token: Column) -> Column:
        """Of a token's repairs that the name knows, the one that counts most, with what it covers; null for none."""
        inside = F.filter(token["fixes"], lambda x: F.map_contains_key("index", x["vt"]))
        best = F.array_max(F.transform(inside, lambda x: F.struct((x["sim"] * x["w2"]).alias("dot"), F.try_element_at("index", x["vt"]).alias("covers"))))
        return F.struct(best.alias("best"), token["firm"].alias("firm"), token["w2"].alias("w2"))

    candidates = within.select("kind", "raw", "tokens", "gaps", F.explode(chosen).alias("name_id")).join(small_side(entries), ["kind", "name_id"])
    hits = candidates.withColumn("hits", F.transform("tokens", nearest)).where(~F.exists("hits", lambda h: h["firm"] & h["best"].isNull()))
    found = F.filter("hits", lambda h: h["best"].isNotNull())
    covered = F.array_distinct(F.flatten(F.transform(found, lambda h: h["best"]["covers"])))
    dot = F.aggregate(found, F.lit(0.0), lambda acc, h: acc + h["best"]["dot"])
    weight = F.aggregate(found, F.lit(0.0), lambda acc, h: acc + h["w2"])
    scored = hits.select("kind", "raw", "entry", "n_need", "gaps", "norm", "top_w2", covered.alias("covered"), dot.alias("dot"), weight.alias("weight")).where(F.size("covered") > 0)
    score = F.round(F.col("dot") / F.sqrt((F.col("weight") + GAP * F.col("gaps") * F.col("top_w2")) * F.col("norm")), 6)
    full = F.size("covered") >= F.col("n_need")
    rank = F.struct(full.alias("full"), score.alias("score"), (full & ((F.col("n_need") > 1) | (F.col("gaps") == 0))).alias("clear"))
    ranked = scored.groupBy("kind", "raw", "entry").agg(F.max(rank).alias("rank"))
    decided = ranked.groupBy("kind", "raw").agg(F.max("rank").alias("top"), F.count("*").alias("n_entries"), F.collect_list(F.struct("rank", "entry")).alias("all"))
    firsts = F.filter("all", lambda x: (x["rank"]["full"] == F.col("top.full")) & (x["rank"]["score"] == F.col("top.score")))
    meant = (F.size(firsts) == 1) & (F.col("top.clear") | ((F.col("n_entries") == 1) & (F.col("top.score") >= LEAST)))
    return decided.where(meant).select("kind", "raw", firsts[0]["entry"].alias("canonical"), F.col("top.score").alias("score"))


def offer_reference(merchants: DataFrame, cards: DataFrame) -> DataFrame:
    """The names of merchants (aliases count) and of cards (by name and by the slug of the URL)."""
    none = F.lit(None).cast("string")
    merchants = merchants.select("merchant_id", "merchant_name", "merchant_aliases").distinct()
    m = merchants.select(F.lit("merchant").alias("kind"), F.col("merchant_id").alias("entry"), F.explode(F.concat(F.array("merchant_name"), F.coalesce("merchant_aliases", F.array().cast("array<string>")))).alias("name"), none.alias("optional"))
    flat = cards.select("identity.card_id", "identity.card_name", "identity.issuer", url_slug(F.col("identity.official_url")).alias("slug")).distinct()
    bank = F.regexp_replace(F.coalesce("issuer", F.lit("")), r"(?i)\b(bank|card|cards)\b", " ")
    c = flat.select(
        F.lit("card").alias("kind"),
        F.col("card_id").alias("entry"),
        F.explode(F.array("card_name", F.regexp_replace("card_id", "_", " "), F.regexp_replace("slug", "-", " "))).alias("name"),
        F.concat(bank, F.lit(" credit card bank")).alias("optional"),
    )
    return reference_names(m.where("entry is not null").unionByName(c.where("entry is not null")))


def typed_values(offers: DataFrame, feed_rows: DataFrame) -> DataFrame:
    """(field_name, record_id, kind, raw) of every typed value that is not blank."""
    a = offers.select(F.lit("merchant_name").alias("field_name"), F.col("identity.offer_id").alias("record_id"), F.lit("merchant").alias("kind"), F.col("merchant.merchant_name").alias("raw"))
    b = offers.select(F.lit("unmatched_card_slugs").alias("field_name"), F.col("identity.offer_id").alias("record_id"), F.lit("card").alias("kind"), F.explode("eligibility.unmatched_card_slugs").alias("raw"))
    c = feed_rows.select(F.lit("brandName").alias("field_name"), F.col("offerId").alias("record_id"), F.lit("merchant").alias("kind"), F.col("brandName").alias("raw"))
    return a.unionByName(b).unionByName(c).where(squeeze(F.col("raw")) != "")


def map_offer_values(offers: DataFrame, feed_rows: DataFrame, merchants: DataFrame, cards: DataFrame) -> DataFrame:
    """(field_name, record_id, raw_value, canonical_id) of every non-blank typed value, each once.

    Words of the cities and locations that the tables name are additions wherever they stand beside a name.
    """
    rows = typed_values(offers, feed_rows).distinct()
    places = feed_rows.select(F.col("city").alias("word")).unionByName(offers.select(F.explode("eligibility.location").alias("word"))).distinct()
    mapped = map_values(rows, offer_reference(merchants, cards), places).select("kind", "raw", "canonical")
    canonical = F.coalesce("canonical", F.lit(UNMATCHED))
    return rows.join(own_exchange(mapped), ["kind", "raw"], "left").select("field_name", "record_id", F.col("raw").alias("raw_value"), canonical.alias("canonical_id"))
