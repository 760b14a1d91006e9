"""Card slugs resolved to a card master by a cascade: equal slug, equal set of words, one containing card."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.classify import card_tokens
from gleaner.session import small_side


def card_keys(cards: DataFrame) -> DataFrame:
    """(card_id, issuer, slug, tokens) of a card master: the slug is the URL's last segment without extension."""
    last = F.regexp_extract("identity.official_url", r"([^/?#]+?)(?:\.[A-Za-z0-9]+)?/*(?:[?#].*)?$", 1)
    return (
        cards.select("identity.card_id", F.lower("identity.issuer").alias("issuer"), F.lower(last).alias("slug"), card_tokens(F.col("identity.card_name")).alias("tokens"))
        .where("card_id is not null")
        .distinct()
    )


def resolve_slugs(slugs: DataFrame, cards: DataFrame) -> DataFrame:
    """(slug, issuer, card_ids, step) of each distinct (slug, issuer) that resolves.

    step 1: the slug is a card's slug; 2: its words are a card's words; 3: its words are among those
    of exactly one card of the issuer (of any card where the issuer is unknown). Each step sees what
    the one before left. Step 3 joins by word and counts, so it needs no comparison with every card.
    """
    keys = card_keys(cards)
    asked = slugs.select(F.trim("slug").alias("slug"), "issuer").where("slug <> ''").distinct().withColumn("low", F.lower("slug"))
    by_slug = keys.where("slug <> ''").groupBy(F.col("slug").alias("low")).agg(F.array_sort(F.collect_set("card_id")).alias("c1"))
    by_words = keys.where(F.size("tokens") > 0).groupBy("tokens").agg(F.array_sort(F.collect_set("card_id")).alias("c2"))
    two = asked.withColumn("tokens", card_tokens(F.col("slug"))).join(small_side(by_slug), "low", "left").join(small_side(by_words), "tokens", "left")
    rest = two.where("c1 is null and c2 is null").where(F.size("tokens") > 0).select("slug", "issuer", F.size("tokens").alias("wanted"), F.explode("tokens").alias("word"))
    words = keys.select("card_id", F.col("issuer").alias("card_issuer"), F.explode("tokens").alias("word"))
    issuers = keys.select(F.col("issuer").alias("known")).distinct()
    inside = (
        rest.join(small_side(words), "word")
        .groupBy("slug", "issuer", "wanted", "card_id", "card_issuer")
        .agg(F.count("*").alias("hits"))
        .where("hits = wanted")
        .join(small_side(issuers), F.lower("issuer") == F.col("known"), "left")
        .where(F.col("known").isNull() | (F.col("card_issuer") == F.col("known")))
        .groupBy("slug", "issuer")
        .agg(F.collect_set("card_id").alias("c3"))
        .where(F.size("c3") == 1)
    )
    same = (F.col("t.slug") == F.col("i.slug")) & F.col("t.issuer").eqNullSafe(F.col("i.issuer"))
    ids = F.coalesce("c1", "c2", "c3")
    step = F.when(F.col("c1").isNotNull(), 1).when(F.col("c2").isNotNull(), 2).otherwise(3)
    return two.alias("t").join(inside.alias("i"), same, "left").where(ids.isNotNull()).select("t.slug", "t.issuer", ids.alias("card_ids"), step.alias("step"))


def link_cards(records: DataFrame, cards: DataFrame) -> DataFrame:
    """(record_id, card_ids, unmatched, match_rate) of records (record_id, issuer, slugs ARRAY<STRING>).

    card_ids is sorted, unmatched in order of first appearance, match_rate the share of distinct
    slugs that resolve, null for none. Null and blank slugs do not count; a record without slugs has
    empty lists. Slugs are resolved once each however many records use them.
    """
    slugs = records.select("record_id", "issuer", F.posexplode("slugs").alias("pos", "slug")).withColumn("slug", F.trim("slug")).where("slug <> ''")
    resolved = resolve_slugs(slugs, cards).select(F.col("slug").alias("s"), F.col("issuer").alias("i"), "card_ids")
    joined = slugs.join(resolved, (F.col("slug") == F.col("s")) & F.col("issuer").eqNullSafe(F.col("i")), "left")
    per_slug = joined.groupBy("record_id", "slug").agg(F.min("pos").alias("pos"), F.first("card_ids", ignorenulls=True).alias("card_ids"))
    linked = per_slug.groupBy("record_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("card_ids")))).alias("card_ids"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("card_ids").isNull(), F.struct("pos", "slug")))), lambda x: x["slug"]).alias("unmatched"),
        F.bround(F.count("card_ids") / F.count("*"), 4).alias("match_rate"),
    )
    none = F.array().cast("array<string>")
    return records.select("record_id").distinct().join(linked, "record_id", "left").select("record_id", F.coalesce("card_ids", none).alias("card_ids"), F.coalesce("unmatched", none).alias("unmatched"), "match_rate")


def families(links: DataFrame, cards: DataFrame) -> DataFrame:
    """(record_id, families): the distinct product families behind the card_ids of each record, sorted."""
    fam = cards.select(F.col("identity.card_id").alias("card_id"), F.col("product_family_id").alias("family")).where("family is not null").distinct()
    return links.select("record_id", F.explode("card_ids").alias("card_id")).join(small_side(fam), "card_id").groupBy("record_id").agg(F.array_sort(F.collect_set("family")).alias("families"))
