"""The message log: offsets, two-phase commit, streams run again, odd messages."""

import os

import pytest
from pyspark.sql import functions as F

from zonepulse.sources import message_log as ml
from zonepulse.sources import requests_io as rio
from zonepulse.sources import telemetry_io as tio


def _read(spark, path):
    ml.register(spark)
    return spark.read.format(ml.FORMAT).option("path", path).load()


def _sorted(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_offsets_go_on_over_writes(spark, tmp_dir):
    rows = spark.range(30_000).select((F.col("id") % 50).cast("string").alias("key"), F.col("id").cast("string").alias("value"))
    for part in (rows.where("id % 3 = 0"), rows.where("id % 3 > 0").repartition(7)):
        tio.write_topic(part, tmp_dir, ml.FORMAT, partitions=5)
    got = _read(spark, tmp_dir)
    assert got.schema == ml.MESSAGE
    assert sorted(r.value for r in got.select("value").collect()) == sorted(str(i) for i in range(30_000))
    per = got.groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"),
                                       F.countDistinct("offset").alias("d")).collect()
    assert all(r.lo == 0 and r.hi + 1 == r.n == r.d for r in per) and {r.partition for r in per} <= set(range(5))
    assert got.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").count() == 0
    again = _read(spark, tmp_dir)                          # offsets belong to the log, not to a read
    assert _sorted(got) == _sorted(again)


def test_odd_messages(spark, tmp_dir):
    rows = [(None, "a"), (None, None), ("", ""), ("é", "x" * 300_000), (None, "b"), ("k", "line\nbreak")]
    tio.write_topic(spark.createDataFrame(rows, "key string, value string").coalesce(1), tmp_dir, ml.FORMAT, partitions=2)
    got = _read(spark, tmp_dir)
    assert _sorted(got.select("key", "value")) == sorted(map(repr, rows))
    assert {r.partition for r in got.where("key is null").collect()} == {0, 1}      # round the partitions
    empty = f"{tmp_dir}/none"
    assert _read(spark, empty).collect() == []
    tio.write_topic(spark.createDataFrame([], "value string"), empty, ml.FORMAT)
    assert _read(spark, empty).collect() == []
    tio.write_topic(spark.createDataFrame([("no key",)], "value string"), empty, ml.FORMAT)
    assert [r.value for r in _read(spark, empty).collect()] == ["no key"]
    with pytest.raises(Exception, match="only appended"):
        spark.createDataFrame(rows, "key string, value string").write.format(ml.FORMAT).option("path", empty).mode("overwrite").save()


def test_a_failed_write_shows_nothing(spark, tmp_dir):
    tio.write_topic(spark.createDataFrame([("first",)], "value string"), tmp_dir, ml.FORMAT)
    broken = spark.range(40_000, numPartitions=4).select(F.when(
        F.col("id") == 39_999, F.raise_error(F.lit("fault"))).otherwise(F.col("id").cast("string")).alias("value"))
    with pytest.raises(Exception, match="fault"):
        tio.write_topic(broken, tmp_dir, ml.FORMAT)
    assert [r.value for r in _read(spark, tmp_dir).collect()] == ["first"]
    tio.write_topic(spark.createDataFrame([("second",)], "value string"), tmp_dir, ml.FORMAT)
    assert sorted(r.value for r in _read(spark, tmp_dir).collect()) == ["first", "second"]


def test_a_batch_committed_twice_counts_once(tmp_dir):
    import pyarrow as pa
    batch = lambda *v: iter([pa.RecordBatch.from_pydict({"value": list(v)})])
    w = ml._StreamWriter(tmp_dir, 3, "s")
    for batch_id, attempt in ((0, "a"), (0, "a"), (1, "b"), (0, "a"), (1, "b")):
        w.commit([w.write(batch(attempt)), None], batch_id)
    other = ml._StreamWriter(tmp_dir, 3, "t")
    other.commit([other.write(batch("c"))], 0)
    values = [v for s in ml._segments(tmp_dir, 0, ml._last_commit(tmp_dir)) for b in ml._messages(tmp_dir, s) for v in b.column("value").to_pylist()]
    assert sorted(values) == ["a", "b", "c"]
    staged = w.write(batch("never"))
    w.abort([staged, None], 2)
    assert not os.path.exists(f"{tmp_dir}/segments/{staged.file}")


def test_streams_restart_and_start_at_the_latest(spark, tmp_dir):
    log, out = f"{tmp_dir}/log", f"{tmp_dir}/out"
    tio.write_topic(spark.createDataFrame([("old",)], "value string"), log, ml.FORMAT)

    def consume(name, start):
        (tio.read_telemetry_stream(spark, ml.FORMAT, log, startingOffsets=start).writeStream.format("parquet")
         .option("path", f"{out}/{name}").option("checkpointLocation", f"{tmp_dir}/{name}").trigger(availableNow=True)
         .start().awaitTermination())
        return sorted(r.value for r in spark.read.schema(ml.MESSAGE).parquet(f"{out}/{name}").collect())

    assert consume("early", "earliest") == ["old"] and consume("late", "latest") == []
    tio.write_topic(spark.createDataFrame([("new",)], "value string"), log, ml.FORMAT)
    assert consume("early", "earliest") == ["new", "old"]
    assert consume("late", "latest") == ["new"]
    assert consume("late", "latest") == ["new"]


def test_requests_from_two_logs(spark, tmp_dir):
    for name in ("main", "retry"):
        tio.write_topic(spark.createDataFrame([('{"id": "%s", "req": {"zone_id": "Z1"}}' % name,)] * 3, "value string"),
                        f"{tmp_dir}/{name}", ml.FORMAT, partitions=2)
    src = rio.read_requests_stream(spark, ml.FORMAT, (f"{tmp_dir}/main", f"{tmp_dir}/retry"))
    rio.decode_requests(src).writeStream.format("parquet").option("path", f"{tmp_dir}/out").option(
        "checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert sorted((r.id, r.topic) for r in got.collect()) == [("main", rio.REQUEST_TOPIC)] * 3 + [("retry", rio.RETRY_TOPIC)] * 3
    assert got.select("seq").distinct().count() == 6          # offsets tell equal messages apart
