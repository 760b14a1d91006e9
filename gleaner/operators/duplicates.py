"""Duplicates by key: reports, first-wins removal and ordered folds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.session import own_exchange


def _keyed(keys: Sequence[str]) -> Column:
    """Whether a row has a key at all: not all of its parts are null."""
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNotNull()
    return out


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(n_rows, n_groups, n_redundant, n_unkeyed): groups are keys held twice or more, redundant their rows after the first.

    Rows whose key parts are all null are counted apart and are no duplicates of each other. Counts
    are combined before the shuffle, so a hot key costs one row for each task.
    """
    per_key = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    real = _keyed(keys)
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count_if(real & (F.col("__n") > 1)).alias("n_groups"),
        F.coalesce(F.sum(F.when(real, F.col("__n") - 1)), F.lit(0)).cast("long").alias("n_redundant"),
        F.coalesce(F.sum(F.when(~real, F.col("__n"))), F.lit(0)).cast("long").alias("n_unkeyed"),
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str] | Column, row: str) -> DataFrame:
    """(row, n_rows, first_row, redundant) of each row of a key held twice or more; `keys` are columns (all null: no key) or an expression.

    first_row is the least `row` of the group, redundant says that a row is not that one. The groups
    are counted with a combine before the shuffle and joined back, so none is collected.
    """
    parts = [keys.alias("__k0")] if isinstance(keys, Column) else [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    names = [f"__k{i}" for i in range(len(parts))]
    keyed = df.select(F.col(row).alias("__row"), *parts).where(_keyed(names))
    groups = own_exchange(keyed.groupBy(*[F.col(n).alias(f"g{n}") for n in names]).agg(F.count("*").alias("n_rows"), F.min("__row").alias("first_row")).where("n_rows > 1"))
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"g{n}"))
    return keyed.join(groups, same).select(F.col("__row").alias(row), "n_rows", "first_row", (F.col("__row") != F.col("first_row")).alias("redundant"))


def merge_rows(df: DataFrame, keys: Sequence[str], order: str, merge: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One row for each key: `merge` maps a column to an aggregate in which order does not count, the others are of the first row by `order`.

    Everything combines before the shuffle: no group is held together.
    """
    rest = [c for c in df.columns if c not in merge]
    first = F.min(F.struct(F.col(order).alias("__order"), F.struct(*[F.col(c) for c in rest]).alias("__row"))).alias("__first")
    out = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(first, *[f(F.col(c)).alias(f"__m_{c}") for c, f in merge.items()])
    return out.select(*[(F.col(f"__m_{c}") if c in merge else F.col(f"__first.__row.{c}")).alias(c) for c in df.columns])


def first_wins(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row of each key by `order` (ties: the least row), and every row without a key.

    A minimum over rows, combined before the shuffle; no window, so no task holds a key's rows.
    """
    whole = F.struct(F.col(order).alias("__order"), F.struct(*[F.col(c) for c in df.columns]).alias("__row"))
    kept = df.where(_keyed(keys)).groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min(whole).alias("__m")).select("__m.__row.*")
    return kept.unionByName(df.where(~_keyed(keys)))


def fold(df: DataFrame, keys: Sequence[str], order: str, merge: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """One row for each key: the columns of `merge` folded from left to right in `order`, the others of the first row.

    merge maps a column to a function of (value so far, next value). Only for folds in which order
    counts, as the rows of one key are held together; where it does not, `merge_rows` is the way.
    """
    row = F.struct(F.col(order).alias("__order"), *[F.col(c) for c in df.columns if c != order])
    rows = F.array_sort(F.collect_list(row))
    names = [c for c in df.columns if c != order]
    groups = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(rows.alias("__rows"))
    step = lambda acc, x: F.struct(acc["__order"].alias("__order"), *[(merge[c](acc[c], x[c]) if c in merge else acc[c]).alias(c) for c in names])
    out = F.aggregate(F.slice("__rows", F.lit(2), F.size("__rows")), F.col("__rows")[0], step)
    return groups.select(out.alias("__r")).select(*[F.col(f"__r.{'__order' if c == order else c}").alias(c) for c in df.columns])
