"""One commit over the many outputs of a micro-batch.

Each output is staged under a folder of the attempt, ``{base}/{output}/{batch}-{attempt}``.
The attempt becomes visible by one marker, an empty file ``{base}/_manifest/{batch}-{attempt}``,
whose creation is atomic. Readers take the folders that have a marker, so they see all
outputs of a batch or none. A batch that is run again after its commit writes nothing; one
that failed before it leaves staged folders, which the next commit of the batch deletes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from zonepulse.sources.files import children, create, delete

MANIFEST = "_manifest"


def committed(spark: SparkSession, base: str) -> dict[int, str]:
    """Batch id -> name of its committed attempt."""
    names = sorted(children(spark, f"{base}/{MANIFEST}"), reverse=True)
    return {int(n.split("-")[0]): n for n in names if n[0].isdigit()}


class BatchCommit:
    """Context of one attempt at a batch: ``write`` stages an output, leaving it commits."""

    def __init__(self, spark: SparkSession, base: str, batch_id: int):
        self.spark, self.base, self.batch_id = spark, base.rstrip("/"), int(batch_id)
        self.name = f"{self.batch_id}-{uuid.uuid4().hex[:12]}"
        self.outputs: list[str] = []

    def __enter__(self) -> BatchCommit:
        self.done = self.batch_id in committed(self.spark, self.base)
        return self

    def write(self, output: str, df: DataFrame) -> None:
        self.outputs.append(output)
        if not self.done:
            df.write.mode("overwrite").parquet(f"{self.base}/{output}/{self.name}")

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None or self.done:
            return
        create(self.spark, f"{self.base}/{MANIFEST}/{self.name}")
        for output in self.outputs:
            for n in children(self.spark, f"{self.base}/{output}"):
                if n.startswith(f"{self.batch_id}-") and n != self.name:
                    delete(self.spark, f"{self.base}/{output}/{n}")


def read_committed(spark: SparkSession, base: str, output: str) -> DataFrame:
    """Rows of an output over all committed batches."""
    base = base.rstrip("/")
    names = sorted(committed(spark, base).values())
    if not names:
        raise FileNotFoundError(f"no committed batch under {base}")
    return spark.read.parquet(*[f"{base}/{output}/{n}" for n in names])
