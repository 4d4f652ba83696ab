"""Keyed upsert sink on plain files.

Every micro-batch writes its changed documents under ``changes/batch_id=N``
(overwritten if the batch is retried, so a restart never double-counts); the
current table is the latest change per ``doc_id``. ``compact`` rewrites the
current state into a new version directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonepulse.sources.files import children, delete, exists


def _writer(target: str, compact_every: int):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/changes/batch_id={batch_id}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, target)
    return write


def upsert_windows(docs: DataFrame, target: str, checkpoint: str, trigger: dict | None = None,
                   query_name: str | None = None, compact_every: int = 100) -> StreamingQuery:
    """Start the update-mode stream that upserts window documents by ``doc_id``; every
    ``compact_every`` batches the changes are folded into a new version (0: never)."""
    w = (docs.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(_writer(target, compact_every)))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return w.start()


def _versions(spark: SparkSession, target: str) -> list[int]:
    """Batch ids of the committed versions, ascending. A version counts once its write has
    left the commit marker; what a crash left behind is not read."""
    found = [int(n.split("=")[1]) for n in children(spark, f"{target}/versions") if n.startswith("upto=")]
    return sorted(v for v in found if exists(spark, f"{target}/versions/upto={v}/_SUCCESS"))


def read_upserted(spark: SparkSession, target: str, key: str = "doc_id") -> DataFrame:
    """Current documents: for each key the row of the highest batch id, read from the
    newest committed version plus the change batches written after it."""
    versions = _versions(spark, target)
    batches = [n for n in children(spark, f"{target}/changes") if n.startswith("batch_id=")
               and (not versions or int(n.split("=")[1]) > versions[-1])]
    parts = [spark.read.option("basePath", f"{target}/changes").parquet(*[f"{target}/changes/{n}" for n in batches])] if batches else []
    if versions:
        parts.append(spark.read.parquet(f"{target}/versions/upto={versions[-1]}"))
    if not parts:
        raise FileNotFoundError(f"no documents under {target}")
    changes = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    cols = [c for c in changes.columns if c != "batch_id"]
    latest = changes.groupBy(key).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("_d"))
    return latest.select("_d.*")


def compact(spark: SparkSession, target: str, key: str = "doc_id", keep_versions: int = 2) -> str:
    """Fold every change batch so far into ``versions/upto=N`` (N = last batch id) and
    return its path; later reads start from it. Change batches that the oldest of the
    ``keep_versions`` kept versions covers are deleted with the versions before it, so the
    folder does not grow with the age of the stream."""
    batches = [int(n.split("=")[1]) for n in children(spark, f"{target}/changes") if n.startswith("batch_id=")]
    done = _versions(spark, target)
    upto = max([*batches, *done[-1:]])
    path = f"{target}/versions/upto={upto}"
    if upto not in done:
        current = read_upserted(spark, target, key).withColumn("batch_id", F.lit(upto).cast("int"))
        current.write.mode("overwrite").parquet(path)
        done.append(upto)
    kept = done[-keep_versions:]
    for v in done[:-keep_versions]:
        delete(spark, f"{target}/versions/upto={v}")
    for b in batches:
        if b <= kept[0]:
            delete(spark, f"{target}/changes/batch_id={b}")
    return path
