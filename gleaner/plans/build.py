"""The build of the offer set in stages, with a report of each: `python -m gleaner.plans.build FOLDER OUT`."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import quality, reconcile
from gleaner.plans.pipeline import Pipeline, PipelineResult
from gleaner.sources.files import write_table
from gleaner.sources.tables import table

RULES = quality.Rules(required=("offer_id", "source_name"), enums={"kind": ("merged", "single", "leftover")}, recommended=("valid_until",))


def build(spark: SparkSession, folder: str, materialise: bool = True) -> PipelineResult:
    """Extract (equal rows once), enrich (counts of linked documents), reconcile, validate; a failing stage ends the run and is recorded."""

    def enrich(df: DataFrame) -> DataFrame:
        docs = F.coalesce("eligibility.linked_eligibility_documents", F.array().cast(df.select("eligibility.linked_eligibility_documents").schema[0].dataType))
        return df.withColumn("n_parsed", F.size(F.filter(docs, lambda d: F.coalesce(d["parsed"], F.lit(False)))))

    stages = Pipeline().add("extract", lambda df: df.distinct()).add("enrich", enrich).add("reconcile", reconcile.reconcile).add("validate", lambda df: quality.validate(df, RULES))
    return stages.run(table(spark, folder, "offers"), materialise)


def report(spark: SparkSession, result: PipelineResult) -> DataFrame:
    """(stage, ok, n_rows, error) of a run."""
    return spark.createDataFrame([(s.name, s.ok, s.rows, s.error) for s in result.stages], "stage string, ok boolean, n_rows bigint, error string")


def main() -> None:
    from gleaner.session import build_session

    a = argparse.ArgumentParser(description=__doc__)
    a.add_argument("folder")
    a.add_argument("out")
    args = a.parse_args()
    spark = build_session()
    result = build(spark, args.folder)
    write_table(report(spark, result), f"{args.out}/report", "json")
    if result.ok:
        write_table(result.data, f"{args.out}/offers")
    raise SystemExit(0 if result.ok else 1)


if __name__ == "__main__":
    main()
