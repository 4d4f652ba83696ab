"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes. Time zone matters: epoch <-> timestamp
# conversions and window boundaries are defined in UTC.
# Wide generated code (many CASE branches over computed columns) exceeds the JVM's
# default 8000-byte JIT limit and would run interpreted; let the JIT compile it.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"

BASE_CONF = {
    "spark.driver.extraJavaOptions": JVM_OPTIONS,
    "spark.executor.extraJavaOptions": JVM_OPTIONS,
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


#: Intermediates written by this process and not yet released.
_SCRATCH: list[str] = []


def build_session(master: str = "local[*]", app: str = "zonepulse",
                  shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(BASE_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone to UTC (a runtime SQL conf, cheap to set)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Functions of Python operators are pickled by reference, so workers must be able to
    import the package wherever the job was started from. Spark's file server hands the
    archive out; nothing is read from a shared folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_zonepulse_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="zonepulse-ship-"), "zonepulse.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._zonepulse_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    This is the folder named by ``spark.checkpoint.dir`` (shared storage on a cluster).
    Where nothing is configured, a folder is created only for a local master, as in
    tests; on a cluster every executor would write to a disk of its own, so it is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="zonepulse-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediates."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_table(df, name: str):
    """Write ``df`` under the shared checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> int:
    """Delete the intermediates written so far; call it once their results are consumed."""
    jvm, gone = spark.sparkContext._jvm, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict:
    """Settings for a cluster run over ``input_bytes`` of input on ``total_cores`` cores.

    Scan splits and shuffle partitions aim at ``target_partition_mb`` each so every
    task's working set fits executor memory; AQE then coalesces small partitions and
    splits skewed ones (a hot key becomes several tasks instead of one straggler).
    """
    target = target_partition_mb << 20
    shuffle = max(3 * total_cores, -(-input_bytes // target))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
