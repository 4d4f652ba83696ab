"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepulse.session import scratch_path

#: Words of every contract: maximal runs without ASCII white space (Java regex).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch that carries whole texts.
TEXTS_PER_BATCH = 500


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts lineage).

    The files outlive every executor, and a plan that uses the result twice computes
    it once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's Arrow batches to ``TEXTS_PER_BATCH`` rows.

    A Python worker and the JVM each hold a batch of whole texts; the default of 10,000
    rows is meant for numbers. The setting stays, it changes no result.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= TEXTS_PER_BATCH:
        conf.set(key, str(TEXTS_PER_BATCH))
    return df


def other_columns_aside(*own: str) -> Callable:
    """Decorator of ``f(docs, ...)`` that returns rows with the columns of ``docs``: inside,
    columns other than ``own`` bear names that no operator uses, by position, so they may
    have any name outside."""
    def decorate(f: Callable) -> Callable:
        @wraps(f)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            names = [c if c in own else f"other_column_{i}" for i, c in enumerate(docs.columns)]
            return f(docs.toDF(*names), *args, **options).toDF(*docs.columns)
        return run
    return decorate


def word_count(text: Column) -> Column:
    """Number of words of a text as long; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def with_positions(df: DataFrame, *order: Column, name: str = "_pos") -> DataFrame:
    """Add the 0-based global position of each row under ``order``.

    Rows are range-partitioned and ranked inside their partition; a table with one row per
    partition says how many rows lie before it, so no task ever sees the whole table and
    the plan does not grow with the number of partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "positions")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(placed.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).cast("long").alias("_start")), "position-starts")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (placed.withColumn("_rank", rank).join(starts, "_part")
            .withColumn(name, F.col("_start") + F.col("_rank")).drop("_part", "_start", "_rank"))


def as_bytes(values: Iterable[str | None]) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if v is None else v.encode("utf-8") for v in values]
