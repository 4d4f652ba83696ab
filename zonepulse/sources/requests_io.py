"""Request envelopes: topic streams, decoding (wrapped or bare) and encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.functions import cache_key
from zonepulse.schemas import ENVELOPE, REQUEST
from zonepulse.sources import message_log

# The topic names that producers and consumers share.
REQUEST_TOPIC = "consultas_geoespaciales"
RETRY_TOPIC = "consultas_retry"
DLQ_TOPIC = "consultas_dlq"
#: Messages of one micro-batch at most, so that a start on a backlog stays bounded.
MAX_MESSAGES = 1_000_000


def read_requests_stream(spark: SparkSession, source: str = "kafka",
                         paths: tuple[str, str] | None = None, **options) -> DataFrame:
    """The main and the retry request streams as one stream of ``value`` messages.

    Kafka subscribes both topics from the earliest offset; ``message_log`` unions the logs of
    both; the text source unions two file streams, folders below included. Offsets live in the query checkpoint, which
    replaces manual commits.
    """
    if source == "kafka":
        r = (spark.readStream.format("kafka").option("subscribe", f"{REQUEST_TOPIC},{RETRY_TOPIC}")
             .option("startingOffsets", options.pop("startingOffsets", "earliest"))
             .option("maxOffsetsPerTrigger", options.pop("maxOffsetsPerTrigger", MAX_MESSAGES)))
        for k, v in options.items():
            r = r.option(k, v)
        # an offset repeats across topics and partitions; all three make the order value
        return r.load().select(F.col("value").cast("string").alias("value"), "topic",
                               F.xxhash64("topic", "partition", "offset").alias("seq"))
    if source == message_log.FORMAT:
        message_log.register(spark)
        logs = [spark.readStream.format(source).options(path=p, **options).load().withColumn("topic", F.lit(topic))
                for p, topic in zip(paths, (REQUEST_TOPIC, RETRY_TOPIC))]
        return logs[0].unionByName(logs[1]).select("value", "topic", F.xxhash64("topic", "partition", "offset").alias("seq"))
    if source == "text":
        main, retry = paths
        def one(p, topic):
            r = spark.readStream.format("text").option("recursiveFileLookup", True)
            for k, v in options.items():
                r = r.option(k, v)
            return r.load(p).withColumn("topic", F.lit(topic))
        both = one(main, REQUEST_TOPIC).unionByName(one(retry, RETRY_TOPIC))
        # files carry no offsets: a deterministic tie-breaker after t_start
        return both.withColumn("seq", F.xxhash64("topic", "value"))
    raise ValueError(f"unknown request source {source!r}")


def decodable(value: Column) -> Column:
    """Whether a message is a request: a JSON object whose ``req``, if there is one, is an object."""
    text = value.cast("string")

    def is_request(parsed: Column) -> Column:
        inner = F.try_variant_get(parsed, "$.req", "variant")
        return parsed.isNotNull() & (inner.isNull() | F.coalesce(F.schema_of_variant(inner).startswith("OBJECT"), F.lit(False)))

    # an array of one binds what is used several times, so a message is parsed once
    found = F.transform(F.array(F.try_parse_json(text)), is_request)[0]
    return F.coalesce(F.ltrim(text).startswith("{"), F.lit(False)) & found


def decode_requests(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Envelope or bare request -> flat request columns.

    A payload without ``req`` is itself the request. Defaults: confidence_min 0.0,
    bins 5, retries 0. A non-empty ``cache_key`` is kept, else it is computed (P7);
    a non-zero ``t_start`` is kept, else it is ``now``.
    """
    now = now if now is not None else F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    text = F.col("value").cast("string")
    # one parse: the envelope fields and the bare request fields share no names
    env = F.from_json(text, T.StructType(ENVELOPE.fields + REQUEST.fields))
    extra = [c for c in df.columns if c != "value"]  # e.g. an arrival order, the topic
    d = df.select(*extra, env.alias("env"))
    bare = F.struct(*[F.col(f"env.{f.name}").alias(f.name) for f in REQUEST.fields])
    req = F.when(F.col("env.req").isNotNull(), F.col("env.req")).otherwise(bare)
    d = d.select(*extra, F.col("env.id").alias("id"), req.alias("req"),
                 F.col("env.retries").alias("retries"), F.col("env.t_start").alias("t_start"),
                 F.col("env.cache_key").alias("cache_key"))
    out = d.select(
        *extra, "id",
        F.col("req.zone_id").alias("zone_id"),
        F.col("req.query_type").alias("query_type"),
        F.coalesce(F.col("req.confidence_min"), F.lit(0.0)).alias("confidence_min"),
        F.coalesce(F.col("req.bins"), F.lit(5)).alias("bins"),
        F.col("req.zone_id_b").alias("zone_id_b"),
        F.coalesce(F.col("retries"), F.lit(0)).alias("retries"),
        F.coalesce(F.nullif(F.col("t_start"), F.lit(0.0)), now.cast("double")).alias("t_start"),
        F.col("cache_key"))
    computed = cache_key(F.col("query_type"), F.col("zone_id"), F.col("zone_id_b"),
                         F.col("confidence_min"), F.col("bins"))
    return out.withColumn("cache_key", F.coalesce(F.nullif(F.col("cache_key"), F.lit("")), computed))


def _req_struct() -> Column:
    return F.struct("zone_id", "query_type", "confidence_min", "bins", "zone_id_b")


def encode_requests(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """{id, req{...}, retries, t_start} as JSON; a null zone_id_b is omitted.
    Columns in ``keep`` (e.g. an arrival order) stay next to ``value``."""
    return df.select(*(keep or []), F.to_json(F.struct(
        F.col("id"), _req_struct().alias("req"), F.col("retries"), F.col("t_start"))).alias("value"))


def encode_bare_requests(df: DataFrame) -> DataFrame:
    """The bare form: the request object itself as the message."""
    return df.select(F.to_json(_req_struct()).alias("value"))


def encode_failed(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Retry / dead-letter payload: envelope plus retries, t_start and cache_key.
    Columns in ``keep`` (e.g. the route) stay next to ``value``."""
    return df.select(*(keep or []), F.to_json(F.struct(
        F.col("id"), _req_struct().alias("req"), F.col("retries"), F.col("t_start"), F.col("cache_key"))).alias("value"))
