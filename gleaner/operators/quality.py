"""Field coverage, completeness, group counts, distributions and validation of any table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_type(df: DataFrame, path: str) -> T.DataType:
    return df.select(F.col(path)).schema[0].dataType


def populated(df: DataFrame, path: str) -> Column:
    """Whether a field holds something: text not blank, a list or map not empty, any other value not null (0 and false count)."""
    c, kind = F.col(path), leaf_type(df, path)
    if isinstance(kind, T.StringType):
        return F.coalesce(F.trim(c) != "", F.lit(False))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def coverage(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """(field, n, total, coverage) with coverage as "n/total": one pass over the table, one row for each field."""
    fields = list(fields or df.columns)
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(populated(df, f)).alias(f"n{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"n{i}").alias("n")) for i, f in enumerate(fields)])
    return counts.select("total", F.inline(rows)).select("field", "n", "total", F.concat_ws("/", F.col("n").cast("string"), F.col("total").cast("string")).alias("coverage"))


def completeness(df: DataFrame, fields: Sequence[str]) -> Column:
    """The share of `fields` that a row populates, to four places; 0 for no fields."""
    if not fields:
        return F.lit(0.0)
    n = sum((populated(df, f).cast("int") for f in fields), F.lit(0))
    return F.bround(n / F.lit(float(len(fields))), 4)


def completeness_stats(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(n_rows, mean, lowest, highest, below_half); an empty table gives zero rows counted and null figures."""
    s = completeness(df, fields)
    return df.select(s.alias("s")).agg(F.count("*").alias("n_rows"), F.round(F.avg("s"), 4).alias("mean"), F.min("s").alias("lowest"), F.max("s").alias("highest"), F.count_if(F.col("s") < 0.5).alias("below_half"))


def group_counts(df: DataFrame, by: str) -> DataFrame:
    """(value, n) of a column, null as the text None."""
    return df.groupBy(F.coalesce(F.col(by).cast("string"), F.lit("None")).alias("value")).agg(F.count("*").alias("n"))


def distributions(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """(field, value, n) of several columns, given as name: path. The rows are combined before one shuffle of counts."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.coalesce(F.col(p).cast("string"), F.lit("None")).alias("value")) for n, p in columns.items()])
    return df.select(F.inline(pairs)).groupBy("field", "value").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Rules:
    """What a record must hold: paths that are required (not null), not empty, of a type (a Spark type's name), of an enumeration, and recommended ones.

    A type is known where the table is read; for a VARIANT it is checked for each value.
    """

    required: Sequence[str] = ()
    non_empty: Sequence[str] = ()
    types: Mapping[str, str] = field(default_factory=dict)
    enums: Mapping[str, Sequence[str]] = field(default_factory=dict)
    recommended: Sequence[str] = ()


# The kinds of VARIANT values of a type.
VARIANT_KINDS = {"string": "^STRING", "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)", "boolean": "^BOOLEAN", "array": "^ARRAY", "object": "^OBJECT", "date": "^DATE"}


def _of_type(df: DataFrame, path: str, name: str) -> Column:
    kind = leaf_type(df, path)
    if kind.typeName() == "variant":
        return F.schema_of_variant(F.col(path)).rlike(VARIANT_KINDS[name])
    groups = {"number": T.NumericType, "object": (T.StructType, T.MapType), "array": T.ArrayType}
    return F.lit(isinstance(kind, groups[name]) if name in groups else kind.typeName() == name)


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """(name, n): how many rows meet each condition, all in one pass; null does not."""
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in conditions])))


def validate(df: DataFrame, rules: Rules) -> DataFrame:
    """`df` with ARRAY<STRING> `errors` and `warnings`, in the order of the rules, and BOOLEAN `valid`. No row is dropped.

    A column of that name in `df` is replaced. A null is no enumeration error.
    """
    errors = [F.when(F.col(p).isNull(), f"missing: {p}") for p in rules.required]
    errors += [F.when(F.col(p).isNotNull() & ~populated(df, p), f"empty: {p}") for p in rules.non_empty]
    errors += [F.when(F.col(p).isNotNull() & ~_of_type(df, p, t), f"not {t}: {p}") for p, t in rules.types.items()]
    errors += [F.when(F.col(p).isNotNull() & ~F.col(p).cast("string").isin(*allowed), F.concat(F.lit(f"not allowed: {p}="), F.col(p).cast("string"))) for p, allowed in rules.enums.items()]
    warnings = [F.when(~populated(df, p), f"recommended: {p}") for p in rules.recommended]
    none = F.array().cast("array<string>")
    found = {"errors": F.array_compact(F.array(*errors)) if errors else none, "warnings": F.array_compact(F.array(*warnings)) if warnings else none}
    return df.withColumns(found).withColumn("valid", F.size("errors") == 0)


def validation_report(validated: DataFrame) -> DataFrame:
    """(n_rows, n_valid, n_invalid, n_warned) of a validated table."""
    return validated.agg(F.count("*").alias("n_rows"), F.count_if("valid").alias("n_valid"), F.count_if(~F.col("valid")).alias("n_invalid"), F.count_if(F.size("warnings") > 0).alias("n_warned"))
