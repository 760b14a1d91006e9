"""The merchant dimension built from ordered mentions, and gaps between merchants and issuers.

What a running dictionary would hold at each record is worked out by aggregates per key (first
name, first category, aliases) and one join, so a merchant with a third of all mentions is combined
before the shuffle and no task walks through its records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.classify import alias_key, category
from gleaner.functions.text import clean, titleise
from gleaner.session import own_exchange


def merchant_dimension(mentions: DataFrame, alias_lists: bool = False) -> DataFrame:
    """One row for each alias key of mentions (seq, name, category, issuer).

    merchant_id is the key as an id, merchant_name the first name seen, merchant_category the first
    category given and the seq from which it is known, n_aliases how many names it has
    (`merchant_aliases` has them as rows), partners the sorted issuers, which are few. Mentions without a
    usable name take no part; ties of seq go by name. With `alias_lists` the names also come as a list
    `aliases` by first appearance, for tables in which no merchant has very many.
    """
    rows = mentions.select("seq", titleise(F.col("name")).alias("shown"), clean(F.col("name")).alias("name"), category(F.col("category")).alias("category"), "issuer", alias_key(F.col("name")).alias("key")).where("key is not null")
    names = rows.groupBy("key", "name").agg(F.min("seq").alias("seq")).groupBy("key").agg(
        F.count("*").alias("n_aliases"), *([F.transform(F.array_sort(F.collect_list(F.struct("seq", "name"))), lambda x: x["name"]).alias("aliases")] if alias_lists else [])
    )
    firsts = rows.groupBy("key").agg(
        F.min(F.struct("seq", "shown"))["shown"].alias("merchant_name"),
        F.min(F.when(F.col("category").isNotNull(), F.struct("seq", "category"))).alias("c"),
        F.array_sort(F.collect_set("issuer")).alias("partners"),
    )
    return firsts.join(names, "key").select(
        "key", F.concat(F.lit("m_"), F.regexp_replace("key", " ", "_")).alias("merchant_id"), "merchant_name",
        F.col("c.category").alias("merchant_category"), F.col("c.seq").alias("category_seq"), "n_aliases", *(["aliases"] if alias_lists else []), "partners",
    )


def merchant_aliases(mentions: DataFrame) -> DataFrame:
    """(key, name, seq) of each name of each merchant with its first appearance: a child table, as a merchant may have any number of names."""
    return mentions.select("seq", clean(F.col("name")).alias("name"), alias_key(F.col("name")).alias("key")).where("key is not null").groupBy("key", "name").agg(F.min("seq").alias("seq"))


def resolve_mentions(mentions: DataFrame, dimension: DataFrame) -> DataFrame:
    """(seq, name, merchant_id, merchant_name, merchant_category) of each mention, in the state of the dimension at its seq.

    A mention that stands before the first category of its merchant has none; its own counts.
    """
    known = dimension.select("key", "merchant_id", "merchant_name", F.col("merchant_category").alias("c"), "category_seq")
    rows = mentions.select("seq", "name", alias_key(F.col("name")).alias("key"))
    return rows.join(own_exchange(known), "key", "left").select("seq", "name", "merchant_id", "merchant_name", F.when(F.col("category_seq") <= F.col("seq"), F.col("c")).alias("merchant_category"))


def partnership_gaps(dimension: DataFrame, issuers: DataFrame, min_partners: int = 2) -> DataFrame:
    """(merchant_id, merchant_name, known_partners, missing_issuers) of merchants with several partners but not all.

    `issuers` (issuer) is the universe, a list of banks: few, however many offers there are.
    """
    every = issuers.where("issuer is not null").agg(F.array_sort(F.collect_set("issuer"))).first()[0]
    universe = F.array(*[F.lit(x) for x in every]).cast("array<string>")
    return (
        dimension.where(F.size("partners") >= min_partners)
        .select("merchant_id", "merchant_name", F.col("partners").alias("known_partners"), F.array_except(universe, "partners").alias("missing_issuers"))
        .where(F.size("missing_issuers") > 0)
    )
