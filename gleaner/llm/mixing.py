"""Mixing sources to target weights by weighted sampling without replacement.

Each document gets an exponential key scaled by its quality weight; in key order a source is a
weighted random order of its documents (Efraimidis and Spirakis). A source's token budget is met by
complete epochs over all its documents and then by the documents whose prefix sum of tokens, in key
order, stays within the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import reference_key
from gleaner.llm.bpe import TOKENIZERS, VOCABULARY, count_tokens
from gleaner.session import ensure_checkpoint_dir, small_side

#: Key ranges within a source; only the range in which a budget ends is put in order row by row.
RANGES = 4096


def quality_weight(text: str) -> Column:
    """A weight in [0.1, 1] by form only: the share of letters, marks and digits among characters that are not blank, and length up to 200."""
    solid = F.char_length(F.regexp_replace(text, r"\s+", ""))
    letters = F.char_length(F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}]+", ""))
    share = letters / F.greatest(solid, F.lit(1))
    return F.greatest(F.lit(0.1), share * F.least(F.lit(1.0), F.char_length(text) / F.lit(200.0)))


def sized_documents(documents: DataFrame, key: str, vocabulary: str, folder: str) -> DataFrame:
    """(key, source, n_tokens, weight) of the documents with a source label and at least one token."""
    labelled = documents.select(key, reference_key(F.col("source")).alias("source"), F.round(quality_weight("text"), 6).alias("weight"), "text").where("source is not null and text <> ''")
    return count_tokens(labelled, "text", "n_tokens", vocabulary, folder)


def budgets(sizes: DataFrame, targets: DataFrame, total_tokens: int | None, exact_shares: bool) -> DataFrame:
    """The budget of each target source and how it is met.

    Labels that differ only in writing are one source: their shares add up and the largest
    max_repeats counts. A source's budget is its share of the total, or all that its repeats allow if
    that is less. The total is `total_tokens`, by default the size of all target sources together;
    with `exact_shares` it is the largest at which every source that has text reaches its share.
    `epochs` complete passes are followed by documents of `rest` tokens. A source is `reachable` if its
    repeats allow its share of the total.
    """
    available = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count("*").alias("n_docs"))
    wanted = (
        targets.select(reference_key(F.col("source")).alias("source"), "target_share", "max_repeats")
        .where("source is not null and target_share > 0 and max_repeats > 0")
        .groupBy("source")
        .agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").cast("long").alias("max_repeats"))
    )
    rows = wanted.join(available, "source", "left").na.fill(0, ["available_tokens", "n_docs"])
    cap = F.col("available_tokens") * F.col("max_repeats")
    over_targets = Window.partitionBy()  # one row for each target source
    if exact_shares:
        total = F.min(F.when(F.col("available_tokens") > 0, cap / F.col("target_share"))).over(over_targets)
    elif total_tokens is None:
        total = F.sum("available_tokens").over(over_targets).cast("double")
    else:
        total = F.lit(float(total_tokens))
    return (
        rows.withColumn("total", F.coalesce(total, F.lit(0.0)))
        .withColumn("reachable", (F.col("available_tokens") > 0) & (cap >= F.floor(F.col("total") * F.col("target_share") + 1e-6)))
        .withColumn("budget_tokens", F.least(cap, F.floor(F.col("total") * F.col("target_share") + 1e-6)).cast("long"))
        .withColumn("epochs", F.when(F.col("available_tokens") > 0, F.floor(F.col("budget_tokens") / F.col("available_tokens"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("budget_tokens") - F.col("epochs") * F.col("available_tokens"))
        .drop("total")
    )


def mix(documents: DataFrame, targets: DataFrame, key: str = "doc_id", seed: int = 0, total_tokens: int | None = None, exact_shares: bool = False, vocabulary: str = VOCABULARY, folder: str = TOKENIZERS) -> tuple[DataFrame, DataFrame]:
    """(mixture, report): each chosen document with its number of copies, and the shares reached.

    mixture: key, source, n_tokens, copies. report: one row for each target source, those without
    text included: target_share, max_repeats, available_tokens, reachable, budget_tokens, mixed_tokens,
    copies, due_share (the target share if all are reachable, else that among the budgets, as what
    others lack raises it), actual_share (of all mixed tokens; it differs from due_share by no more
    than a document of each source), short_tokens (its share of the whole mixture that it lacks).
    Documents without a label or of no target source, null and empty texts take no part. The same
    seed gives the same mixture whatever the partitioning; equal keys go by document key. A large
    source is cut into RANGES ranges by key, whose sums give each range its place; only rows of the
    range in which the budget ends are sorted, so no source is collected in one task. The document
    at which the budget ends is taken if that comes nearer to the budget than leaving it.
    """
    ensure_checkpoint_dir(documents.sparkSession)
    sizes = sized_documents(documents, key, vocabulary, folder).checkpoint()  # texts are encoded once
    plan = budgets(sizes, targets, total_tokens, exact_shares)
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    order = -F.log(uniform) / F.col("weight")
    keyed = sizes.withColumn("order", order).withColumn("range", F.floor((1 - F.exp(-F.col("order") * 0.5)) * RANGES).cast("int"))
    w = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.groupBy("source", "range").agg(F.sum("n_tokens").alias("in_range")).withColumn("before", F.coalesce(F.sum("in_range").over(w), F.lit(0)))
    placed = placed.join(small_side(plan.select("source", "epochs", "rest")), "source").withColumn(
        "side", F.when(F.col("before") + F.col("in_range") <= F.col("rest"), "in").when(F.col("before") <= F.col("rest"), "cut").otherwise("out")
    )
    rows = keyed.join(small_side(placed.select("source", "range", "before", "epochs", "rest", "side")), ["source", "range"])
    inside = Window.partitionBy("source", "range").orderBy("order", key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = rows.where("side <> 'cut'").withColumn("extra", (F.col("side") == "in").cast("long"))
    cut = rows.where("side = 'cut'").withColumn("extra", (2 * (F.col("before") + F.sum("n_tokens").over(inside)) - F.col("n_tokens") <= 2 * F.col("rest")).cast("long"))
    mixture = whole.unionByName(cut).select(key, "source", "n_tokens", (F.col("epochs") + F.col("extra")).alias("copies")).where("copies > 0")
    reached = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.sum("copies").alias("copies"))
    everything = F.sum("mixed_tokens").over(Window.partitionBy())  # over the target sources only
    report = plan.join(reached, "source", "left").na.fill(0, ["mixed_tokens", "copies"])
    report = report.select(
        "source", "target_share", "max_repeats", "n_docs", "available_tokens", "reachable", "budget_tokens", "mixed_tokens", "copies",
        F.round(F.col("budget_tokens") / F.sum("budget_tokens").over(Window.partitionBy()), 6).alias("due_share"),
        F.round(F.col("mixed_tokens") / everything, 6).alias("actual_share"),
        F.greatest(F.lit(0), F.round(F.col("target_share") * everything).cast("long") - F.col("mixed_tokens")).alias("short_tokens"),
    )
    return mixture, report
