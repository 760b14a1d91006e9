"""Parquet tables by name under one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table `name` of the data set at `root`; a file or a directory of files."""
    return spark.read.parquet(f"{root}/{name}.parquet")
