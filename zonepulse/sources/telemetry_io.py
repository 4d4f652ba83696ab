"""Telemetry sources and sinks: topic or file streams, JSON codec, the CSV event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.schemas import TELEMETRY
from zonepulse.sources import message_log

# Fixed value: the topic name that producers and consumers share.
TELEMETRY_TOPIC = "metrics-topic"


def read_telemetry_stream(spark: SparkSession, source: str = "kafka", path: str | None = None,
                          topic: str = TELEMETRY_TOPIC, **options) -> DataFrame:
    """A stream with a ``value`` column holding one JSON message per row.

    ``kafka`` subscribes one topic starting at the latest offset (options such as
    ``kafka.bootstrap.servers`` pass through); ``text`` reads newline-delimited JSON
    files from ``path`` (same decoding path, used where no broker is available);
    ``message_log`` reads the log in ``path``, with partitions and offsets, from the latest
    message unless ``startingOffsets`` says ``earliest``.
    """
    if source == "kafka":
        reader = (spark.readStream.format("kafka").option("subscribe", topic)
                  .option("startingOffsets", options.pop("startingOffsets", "latest")))
    elif source == message_log.FORMAT:
        message_log.register(spark)
        reader = spark.readStream.format(source).option("startingOffsets", options.pop("startingOffsets", "latest"))
    elif source == "text":
        reader = spark.readStream.format("text")
    else:
        raise ValueError(f"unknown telemetry source {source!r}")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path) if path else reader.load()


def decode_telemetry(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Message bytes/text -> JSON with the declared schema -> flat columns, after those of
    the message named in ``keep``. Malformed messages give a row of nulls (dropped later by
    the event-time filter)."""
    return df.select(*keep, F.from_json(F.col("value").cast("string"), TELEMETRY).alias("data")) \
        .select(*keep, "data.*")


def encode_telemetry(df: DataFrame, key: str | None = None) -> DataFrame:
    """Telemetry rows -> one JSON message per row in ``value``, under ``key`` if a column is named."""
    keys = [F.col(key).cast("string").alias("key")] if key else []
    return df.select(*keys, F.to_json(F.struct(*[F.col(f.name) for f in TELEMETRY.fields])).alias("value"))


def write_topic(df: DataFrame, target: str, sink: str = "kafka", **options) -> None:
    """Publish encoded rows (``value``, and ``key`` if there is one) to a topic, to a message
    log or as text files where no broker exists."""
    if sink == "kafka":
        w = df.write.format("kafka").option("topic", target)
        for k, v in options.items():
            w = w.option(k, v)
        w.save()
    elif sink == message_log.FORMAT:
        message_log.register(df.sparkSession)
        df.write.format(sink).mode("append").options(path=target, **options).save()
    elif sink == "text":
        df.write.mode("append").text(target)
    else:
        raise ValueError(f"unknown sink {sink!r}")


def write_topic_stream(stream: DataFrame, target: str, checkpoint: str, sink: str = "kafka",
                       trigger: dict | None = None, **options):
    """S4 for a stream. A message log takes every batch once, also if it is run again after
    a fault; Kafka at least once."""
    if sink == "kafka":
        w = stream.writeStream.format("kafka").option("topic", target)
    elif sink == message_log.FORMAT:
        message_log.register(stream.sparkSession)
        w = stream.writeStream.format(sink).option("path", target)
    else:
        raise ValueError(f"unknown sink {sink!r}")
    return (w.options(**options).option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def append_telemetry(df: DataFrame, path: str) -> None:
    """Append events to the CSV event log (header in every part file)."""
    df.select(*[f.name for f in TELEMETRY.fields]).write.mode("append") \
        .option("header", True).csv(path)


def append_telemetry_stream(stream: DataFrame, path: str, checkpoint: str,
                            trigger: dict | None = None):
    """S5 for a stream: decoded events appended to the CSV log, exactly once per batch
    (the file sink's log in ``path`` and the checkpoint make retries idempotent)."""
    return (stream.select(*[f.name for f in TELEMETRY.fields]).writeStream.format("csv")
            .option("header", True).option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def read_telemetry_log(spark: SparkSession, path: str) -> DataFrame:
    """The event log as a table with the declared schema."""
    return spark.read.schema(TELEMETRY).option("header", True).csv(path)
