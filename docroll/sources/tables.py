"""Parquet tables of a data folder (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """A lazily scanned parquet table; filters and projections reach the scan."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, data_dir: str, names=TABLE_NAMES) -> None:
    """Register tables as temp views for SQL text."""
    for n in names:
        table(spark, data_dir, n).createOrReplaceTempView(n)
