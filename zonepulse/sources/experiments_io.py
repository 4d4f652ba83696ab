"""Experiment log and experiment summary files (CSV with header)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonepulse.schemas import EXPERIMENT_LOG, EXPERIMENT_SUMMARY


def append_experiments(df: DataFrame, path: str) -> None:
    """Append finished experiment rows to the log."""
    df.select(*[f.name for f in EXPERIMENT_LOG.fields]).write.mode("append") \
        .option("header", True).csv(path)


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    """All logged experiments."""
    return spark.read.schema(EXPERIMENT_LOG).option("header", True).csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    """The experiment summary table (CSV, header from the column names)."""
    df.select(*[f.name for f in EXPERIMENT_SUMMARY.fields]).write \
        .mode("overwrite").option("header", True).csv(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The experiment summary with its declared schema."""
    return spark.read.schema(EXPERIMENT_SUMMARY).option("header", True).csv(path)
