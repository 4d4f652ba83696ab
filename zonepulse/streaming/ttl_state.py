"""T4 as a stream: the TTL cache decision per key kept in state (one ValueState)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

REPLAY_SCHEMA = T.StructType([T.StructField("cache_key", T.StringType()),
                              T.StructField("seq", T.LongType()),
                              T.StructField("cached", T.BooleanType())])
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EXPIRY = T.StructType([T.StructField("expiry", T.DoubleType())])


class TTLCacheProcessor(StatefulProcessor):
    """Per cache key: hit iff t < expiry; a valid miss sets expiry = t + ttl.
    Columns named in ``keep`` pass through to the output."""

    def __init__(self, ttl: float, keep: tuple[str, ...] = (), state_ms: int | None = None):
        self.ttl = float(ttl)
        self.state_ms = state_ms
        self.keep = tuple(keep)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.expiry = handle.getValueState("expiry", _EXPIRY, self.state_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        from zonepulse.operators.requests import fold_run
        chunks = [pdf for pdf in rows if len(pdf)]
        if not chunks:
            return
        # only the numbers are laid together and sorted; the rows leave in the chunks they came in
        column = lambda c, kind: np.concatenate([pdf[c].to_numpy(dtype=kind) for pdf in chunks])
        t = column("t", "float64")
        order = np.lexsort((column("seq", "int64"), t))
        expiry = self.expiry.get()[0] if self.expiry.exists() else float("-inf")
        cached = np.zeros(len(t), dtype=bool)
        cached[order], expiry = fold_run(t[order], column("valid", "bool")[order], expiry, self.ttl)
        if expiry != float("-inf"):
            self.expiry.update((float(expiry),))
        at = 0
        for i, pdf in enumerate(chunks):
            chunks[i] = None
            yield pd.DataFrame({"cache_key": [key[0]] * len(pdf), "seq": pdf["seq"].astype("int64").to_numpy(),
                                "cached": cached[at: at + len(pdf)], **{c: pdf[c].to_numpy() for c in self.keep}})
            at += len(pdf)

    def close(self) -> None:
        pass


def ttl_replay_stream(req: DataFrame, ttl: float, time_col: str = "t_start",
                      order_col: str = "seq", valid_col: str = "valid",
                      keep: tuple[str, ...] = (), state_seconds: float | None = None) -> DataFrame:
    """Streaming T4 (per-key ValueState; needs the RocksDB state store provider, which is
    selected here when the session still uses another one). ``keep`` names input
    columns carried to the output next to cache_key, seq and cached.

    With ``state_seconds`` the store drops a key that long after its last fill, so state is
    bounded by the keys of that time; a live stream passes twice the TTL, when the expiry
    has long passed. A bounded replay (``availableNow``) leaves it out: clock-driven state
    would keep its trigger from ending, and its recorded clock is not the wall's."""
    from pyspark.sql import functions as F
    spark = req.sparkSession
    conf_key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(conf_key, "") or ""):
        spark.conf.set(conf_key, ROCKSDB_PROVIDER)
    state_ms = int(1000 * state_seconds) if state_seconds else None
    keep = tuple(c for c in keep if c not in ("cache_key", "seq", "t", "valid", "cached"))
    ev = req.select(F.col("cache_key"), F.col(order_col).cast("long").alias("seq"),
                    F.col(time_col).cast("double").alias("t"),
                    F.coalesce(F.col(valid_col), F.lit(False)).alias("valid"), *keep)
    schema = T.StructType(list(REPLAY_SCHEMA.fields) + [ev.schema[c] for c in keep])
    return ev.groupBy("cache_key").transformWithStateInPandas(
        statefulProcessor=TTLCacheProcessor(ttl, keep, state_ms), outputStructType=schema,
        outputMode="Append", timeMode="ProcessingTime" if state_ms else "None")


_PENDING = T.StructType([T.StructField("seq", T.LongType()), T.StructField("t", T.DoubleType()),
                         T.StructField("valid", T.BooleanType())])


class TTLTimerProcessor(StatefulProcessor):
    """Per cache key in event time: requests wait in a list until the watermark has passed
    them, then are judged in (t, seq) order from the key's expiry.

    A timer stands at the earliest waiting request. When it fires, all requests up to the
    watermark are judged, and it is set anew for the rest. The list holds the requests
    of one key within the watermark's delay, three numbers each.
    """

    def __init__(self, ttl: float):
        self.ttl = float(ttl)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.expiry = handle.getValueState("expiry", _EXPIRY)
        self.timer = handle.getValueState("timer", T.StructType([T.StructField("ms", T.LongType())]))
        self.waiting = handle.getListState("waiting", _PENDING)

    def _stand_at(self, t: float) -> None:
        """Have the timer stand at ``t`` unless it stands earlier."""
        ms = int(t * 1000.0) + 1
        if self.timer.exists():
            old = self.timer.get()[0]
            if old <= ms:
                return
            self.handle.deleteTimer(old)
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            if len(pdf):
                self.waiting.appendList(list(zip(pdf["seq"].astype("int64").tolist(), pdf["t"].astype(float).tolist(),
                                                 pdf["valid"].astype(bool).tolist())))
                self._stand_at(float(pdf["t"].min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        from zonepulse.operators.requests import fold_run
        passed = timerValues.getCurrentWatermarkInMs() / 1000.0
        pdf = pd.DataFrame(list(self.waiting.get()), columns=["seq", "t", "valid"])
        ready = pdf[pdf["t"] < passed].sort_values(["t", "seq"], kind="stable")
        rest = pdf[~(pdf["t"] < passed)]
        self.timer.clear()
        if len(rest):
            self.waiting.put(list(rest.itertuples(index=False, name=None)))
            self._stand_at(float(rest["t"].min()))
        else:
            self.waiting.clear()
        expiry = self.expiry.get()[0] if self.expiry.exists() else float("-inf")
        cached, expiry = fold_run(ready["t"].to_numpy(dtype="float64"), ready["valid"].to_numpy(dtype=bool), expiry, self.ttl)
        if expiry != float("-inf"):
            self.expiry.update((float(expiry),))
        if len(ready):
            yield pd.DataFrame({"cache_key": [key[0]] * len(ready), "seq": ready["seq"].astype("int64").to_numpy(), "cached": cached})

    def close(self) -> None:
        pass


def ttl_replay_event_time(req: DataFrame, ttl: float, delay: str, time_col: str = "t_start", order_col: str = "seq",
                          valid_col: str = "valid") -> DataFrame:
    """T4 over a stream out of order: cache_key, seq and cached of each request that arrives
    within ``delay`` of the newest one, judged in time order once the watermark passes it.

    Requests later than that are dropped, as the watermark says; those without key or time
    take no part."""
    from pyspark.sql import functions as F
    spark = req.sparkSession
    conf_key = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(conf_key, "") or ""):
        spark.conf.set(conf_key, ROCKSDB_PROVIDER)
    t = F.col(time_col).cast("double")
    ev = req.where(F.col("cache_key").isNotNull() & t.isNotNull() & ~F.isnan(t)).select(
        "cache_key", F.col(order_col).cast("long").alias("seq"), t.alias("t"),
        F.coalesce(F.col(valid_col), F.lit(False)).alias("valid"),
        F.timestamp_micros((t * F.lit(1e6)).cast("long")).alias("event_time")).withWatermark("event_time", delay)
    return ev.groupBy("cache_key").transformWithStateInPandas(
        statefulProcessor=TTLTimerProcessor(ttl), outputStructType=REPLAY_SCHEMA, outputMode="Append", timeMode="EventTime")
