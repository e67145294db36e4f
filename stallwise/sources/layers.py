"""Parquet layers between the stages: staging, quarantine, model, enriched fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, base: str, name: str, partition_by: list[str] | None = None) -> str:
    path = f"{base.rstrip('/')}/{name}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}")


def stage(df: DataFrame, base: str, name: str) -> DataFrame:
    """Write a table and continue from the written copy, so that later steps do not recompute it."""
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(write_table(df, base, name))


def write_quarantine(df: DataFrame, base: str, entity: str) -> str:
    """Bad rows of one entity, one folder per check."""
    return write_table(df, base, f"quarantine_{entity}", partition_by=["check_name"])
