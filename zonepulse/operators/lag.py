"""Consumer lag samples (W1) and backlog episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Offsets per block of the arrival order; bounds every window partition below.
SEQ_BLOCK = 1 << 20


def with_lag(offsets: DataFrame) -> DataFrame:
    """lag = high watermark - offset - 1."""
    return offsets.withColumn("lag", F.col("high_watermark") - F.col("msg_offset") - 1)


def lag_samples(offsets: DataFrame, every: int = 10) -> DataFrame:
    """Observations with a positive lag that is a multiple of ``every``."""
    lag = F.col("lag")
    return with_lag(offsets).where((lag > 0) & (lag % every == 0))


def backlog_episodes(offsets: DataFrame, key: str = "consumer_id", order: str = "seq",
                     time_col: str = "processed_at", block: int = SEQ_BLOCK) -> DataFrame:
    """Per consumer, an episode opens at the first observation with lag > 0 and closes
    at the next observation with lag = 0; episodes still open are not emitted.

    Output: consumer, open/close order and time, ``duration_ms``.

    Gaps-and-islands without a window over a whole consumer: rows are cut into blocks
    of ``block`` consecutive positions. Inside a block a window (at most ``block`` rows)
    numbers the islands (zeros seen before the row). A block summary (one row per
    consumer and block) carries the still-open episode from block to block; its window
    holds one row per block, i.e. rows / ``block``.
    """
    d = with_lag(offsets).select(
        F.col(key).alias("k"), F.col(order).alias("o"), F.col(time_col).alias("t"), "lag",
        F.floor(F.col(order) / block).cast("long").alias("blk"))
    zero = (F.col("lag") == 0).cast("int")
    w_in = Window.partitionBy("k", "blk").orderBy("o")
    d = d.withColumn("li", F.coalesce(F.sum(zero).over(
        w_in.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per (consumer, block, island): first positive row and the closing zero
    pos_o = F.when(F.col("lag") > 0, F.col("o"))
    isl = d.groupBy("k", "blk", "li").agg(
        F.min_by(F.struct("o", "t"), pos_o).alias("open"),
        F.count(pos_o).alias("npos"),
        F.max_by(F.struct("o", "t"), F.when(F.col("lag") == 0, F.col("o"))).alias("close"),
        F.sum(zero).alias("nzero"))
    isl = isl.withColumn("open", F.when(F.col("npos") > 0, F.col("open"))) \
        .withColumn("close", F.when(F.col("nzero") > 0, F.col("close")))

    def episode(df: DataFrame, open_col, close_col) -> DataFrame:
        return df.select("k", open_col.alias("open"), close_col.alias("close")) \
            .where(F.col("open").isNotNull() & F.col("close").isNotNull())

    # islands opened after a zero of the same block close inside the block (or stay open)
    inner = episode(isl.where(F.col("li") > 0), F.col("open"), F.col("close"))

    # block summary: head island (li = 0), zero count, island left open at the end
    zeros = d.groupBy("k", "blk").agg(F.sum(zero).alias("nz"))
    summ = isl.join(zeros, ["k", "blk"]).groupBy("k", "blk").agg(
        F.first(F.when(F.col("li") == 0, F.col("open")), ignorenulls=True).alias("head_open"),
        F.first(F.when(F.col("li") == 0, F.col("close")), ignorenulls=True).alias("head_close"),
        F.first(F.when((F.col("li") == F.col("nz")) & (F.col("nz") > 0), F.col("open")),
                ignorenulls=True).alias("tail_open"))
    # state entering block b: after the last earlier block z holding a zero, the open
    # island is z's tail, else the first head_open of the zero-free blocks in (z, b)
    w_b = Window.partitionBy("k").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("seg", F.max(F.when(F.col("head_close").isNotNull(), F.col("blk"))).over(w_b))
    w_seg = Window.partitionBy("k", "seg").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("carry", F.min_by(
        "head_open", F.when(F.col("head_open").isNotNull(), F.col("blk"))).over(w_seg))
    tails = summ.select("k", F.col("blk").alias("seg"), F.col("tail_open").alias("seg_tail"))
    summ = summ.join(tails, ["k", "seg"], "left")
    entering = F.coalesce(F.col("seg_tail"), F.col("carry"))
    head = episode(summ, F.coalesce(entering, F.col("head_open")), F.col("head_close"))

    out = inner.unionByName(head)
    return out.select(F.col("k").alias(key), F.col("open.o").alias("open_seq"),
                      F.col("open.t").alias("open_time"), F.col("close.o").alias("close_seq"),
                      F.col("close.t").alias("close_time"),
                      ((F.col("close.t") - F.col("open.t")) * F.lit(1000.0)).alias("duration_ms"))


def lag_events(offsets: DataFrame, every: int = 10, key: str = "consumer_id", order: str = "seq",
               time_col: str = "processed_at", block: int = SEQ_BLOCK) -> DataFrame:
    """W1 and W2 as telemetry: the events a consumer emits about its backlog.

    Every positive lag that is a multiple of ``every`` gives ``consumer_lag`` with the lag as
    value. The message that closes an episode gives ``recovery_time`` (milliseconds) and
    ``consumer_lag`` 0, with its own query type, zone and cache key, so that A9 can read
    them. ``offsets`` carries query_type, zone_id and cache_key of each message.
    """
    message = ["query_type", "zone_id", "cache_key"]
    rows = with_lag(offsets).select(key, order, F.col(time_col).alias("timestamp"), *message, "lag")
    samples = rows.where((F.col("lag") > 0) & (F.col("lag") % every == 0)).select(
        key, order, F.lit(0).alias("event_index"), "timestamp", F.lit("consumer_lag").alias("event_type"), *message,
        F.col("lag").cast("double").alias("latency_ms"))
    closed = backlog_episodes(offsets, key, order, time_col, block).select(
        key, F.col("close_seq").alias(order), "duration_ms")
    both = F.array(F.struct(F.lit(0).alias("event_index"), F.lit("recovery_time").alias("event_type"),
                            F.col("duration_ms").alias("latency_ms")),
                   F.struct(F.lit(1).alias("event_index"), F.lit("consumer_lag").alias("event_type"),
                            F.lit(0.0).alias("latency_ms")))
    closing = rows.join(closed, [key, order]).select(key, order, "timestamp", *message, F.inline(both))
    return samples.unionByName(closing.select(*samples.columns))
