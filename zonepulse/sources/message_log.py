"""S1/S4 without a broker: a partitioned message log in shared storage as a Python data source.

Layout of a log: ``segments/<id>.parquet`` (partition, key, value: what one task wrote) and
``commits/<n>.json``. Tasks only write segments. The driver's commit, the second phase,
numbers the messages of all of them by one manifest, which appears by a rename: readers see
all messages of a write or none, and segments of failed or repeated attempts are never named.
A message's offset is its place in its partition; it is fixed by the manifest.

A log has one writer at a time (a job, or a stream with its checkpoint). The manifest keeps
the last batch of every stream, so a batch that is run again after a fault adds nothing.
Paths are those that pyarrow's file systems resolve, on the driver and on every executor.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

FORMAT = "message_log"
PARTITIONS = 8
MESSAGE = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
                        T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
_STORED = pa.schema([("partition", pa.int32()), ("key", pa.string()), ("value", pa.string())])
_READ = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()), ("value", pa.string())])
#: Rows that a reading task holds at a time.
READ_ROWS = 8192


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _last_commit(path: str) -> int:
    """Number of commits of a log."""
    fs, root = _open(path)
    found = fs.get_file_info(pafs.FileSelector(f"{root}/commits", allow_not_found=True))
    numbers = [int(i.base_name[:-5]) for i in found if re.fullmatch(r"\d+\.json", i.base_name)]
    return max(numbers, default=-1) + 1


def _manifest(path: str, number: int) -> dict:
    fs, root = _open(path)
    with fs.open_input_stream(f"{root}/commits/{number:012d}.json") as f:
        return json.loads(f.read())


@dataclass
class Segment(WriterCommitMessage, InputPartition):
    """A segment: its file, the messages of each partition in it and, once committed, their first offsets."""

    file: str
    rows: dict
    first: dict | None = None


def _write_segment(path: str, partitions: int, batches: Iterator[pa.RecordBatch]) -> Segment:
    """First phase: the rows of one task as one file, batch by batch. Equal keys share a
    partition; rows without a key go round the partitions."""
    fs, root = _open(path)
    fs.create_dir(f"{root}/segments", recursive=True)
    name, out, unkeyed = f"{uuid.uuid4().hex}.parquet", None, 0
    rows = np.zeros(partitions, dtype="int64")
    try:
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                out = pq.ParquetWriter(f"{root}/segments/{name}", _STORED, filesystem=fs)
            keys = b.column("key").cast(pa.string()) if "key" in b.schema.names else pa.nulls(b.num_rows, pa.string())
            place = np.empty(b.num_rows, dtype="int32")
            for i, k in enumerate(keys.to_pylist()):
                place[i] = (zlib.crc32(k.encode()) if k is not None else unkeyed) % partitions
                unkeyed += k is None
            rows += np.bincount(place, minlength=partitions)
            out.write_batch(pa.RecordBatch.from_arrays([pa.array(place), keys, b.column("value").cast(pa.string())], schema=_STORED))
    finally:
        if out is not None:
            out.close()
    return Segment(name, {str(p): int(n) for p, n in enumerate(rows) if n})


def _commit(path: str, messages: list, stream: str | None = None, batch: int | None = None) -> None:
    """Second phase: one manifest numbers the messages of all segments."""
    fs, root = _open(path)
    number = _last_commit(path)
    before = _manifest(path, number - 1) if number else {"next": {}, "batches": {}}
    if stream is not None and before["batches"].get(stream, -1) >= batch:
        return
    following, segments = dict(before["next"]), []
    for m in sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.file):
        segments.append({"file": m.file, "rows": m.rows, "first": {p: following.get(p, 0) for p in m.rows}})
        for p, n in m.rows.items():
            following[p] = following.get(p, 0) + n
    batches = before["batches"] | ({stream: batch} if stream is not None else {})
    fs.create_dir(f"{root}/commits", recursive=True)
    staged = f"{root}/commits/.{uuid.uuid4().hex}"
    with fs.open_output_stream(staged) as f:
        f.write(json.dumps({"segments": segments, "next": following, "batches": batches}).encode())
    fs.move(staged, f"{root}/commits/{number:012d}.json")


def _abort(path: str, messages: list) -> None:
    fs, root = _open(path)
    for m in messages:
        if m is not None and m.rows:
            fs.delete_file(f"{root}/segments/{m.file}")


def _segments(path: str, start: int, end: int) -> list[Segment]:
    return [Segment(**s) for n in range(start, end) for s in _manifest(path, n)["segments"]]


def _messages(path: str, segment: Segment) -> Iterator[pa.RecordBatch]:
    fs, root = _open(path)
    following = {int(p): n for p, n in segment.first.items()}
    with fs.open_input_file(f"{root}/segments/{segment.file}") as f:
        for b in pq.ParquetFile(f).iter_batches(READ_ROWS):
            place = b.column("partition").to_numpy()
            offset = np.empty(len(place), dtype="int64")
            for p in np.unique(place):
                at = np.flatnonzero(place == p)
                offset[at] = following[int(p)] + np.arange(len(at))
                following[int(p)] += len(at)
            yield pa.RecordBatch.from_arrays([b.column("partition"), pa.array(offset), b.column("key"), b.column("value")], schema=_READ)


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return _segments(self.path, 0, _last_commit(self.path))

    def read(self, partition):
        return _messages(self.path, partition) if partition is not None else iter(())


class _StreamReader(DataSourceStreamReader):
    """Offsets count commits; a micro-batch reads whole commits."""

    def __init__(self, path: str, starting: str):
        self.path, self.starting = path, starting

    def initialOffset(self):
        return {"commits": _last_commit(self.path) if self.starting == "latest" else 0}

    def latestOffset(self):
        return {"commits": _last_commit(self.path)}

    def partitions(self, start, end):
        return _segments(self.path, start["commits"], end["commits"])

    def read(self, partition):
        return _messages(self.path, partition)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, partitions: int):
        self.path, self.n = path, partitions

    def write(self, iterator):
        return _write_segment(self.path, self.n, iterator)

    def commit(self, messages):
        _commit(self.path, messages)

    def abort(self, messages):
        _abort(self.path, messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, partitions: int, stream: str):
        self.path, self.n, self.stream = path, partitions, stream

    def write(self, iterator):
        return _write_segment(self.path, self.n, iterator)

    def commit(self, messages, batchId):
        _commit(self.path, messages, self.stream, batchId)

    def abort(self, messages, batchId):
        _abort(self.path, messages)


class MessageLog(DataSource):
    """Format ``message_log``. Options: ``path``; writing ``partitions`` (fixed for a log by its
    writers); streams ``startingOffsets`` (earliest or latest) and ``stream``, a name by which
    batches run again are known (else the checkpoint's path)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return MESSAGE

    def _partitions(self) -> int:
        return int(self.options.get("partitions", PARTITIONS))

    def reader(self, schema):
        return _Reader(self.options["path"])

    def streamReader(self, schema):
        return _StreamReader(self.options["path"], self.options.get("startingOffsets", "earliest"))

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a message log is only appended to")
        return _Writer(self.options["path"], self._partitions())

    def streamWriter(self, schema, overwrite):
        name = self.options.get("stream") or self.options.get("checkpointLocation")
        if not name:
            raise ValueError("name the stream: option 'stream' or a checkpoint location")
        return _StreamWriter(self.options["path"], self._partitions(), name)


def register(spark: SparkSession) -> None:
    """Make the format known to a session. The workers that plan a source import no shipped
    package, so this module travels by value."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(MessageLog)
