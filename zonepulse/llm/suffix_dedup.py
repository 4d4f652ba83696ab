"""Removal of long repeated substrings by two-stage suffix sorting.

A byte goes if it lies in a string of ``window`` bytes that starts somewhere else too, in
another text or the same. Only suffixes that begin with the same window need to meet, so
the corpus is first cut by content: the smallest hashed ``GRAM``-gram of a window (leftmost
on ties) is its anchor, neighbouring windows with one anchor form a stretch, and equal
windows always fall into stretches with equal anchor grams. Stretches whose anchor gram is
unique in the corpus are done. Stretches that occur twice or more as a whole are repeated
from end to end. Of the rest one copy of each is fetched, dealt by anchor gram, and suffix
sorted in batches:

1. suffixes smaller than their successors are sorted directly, by buckets of two bytes;
2. all others are induced by a scan over the buckets of the first byte, in order;
3. neighbours in the order whose common prefix reaches ``window`` mark repeated windows.

Sorting needs no more than ``window`` bytes of a suffix, and separators end every stretch.
What is sorted together stays below ``bucket_limit`` strings: an anchor gram with more
different stretches has them cut again, by the place of the anchor in the window. All windows
of a range of places share a core of bytes around the anchor, and equal windows have equal
cores, so the pieces of a stretch are dealt anew by their core. The ranges narrow (from a
quarter of the window down to one place, where a core is a whole window) until no group is
too large; equal pieces are counted and go on as one.

Copies cost one row per stretch and never meet as text: equal rows are first laid together
with their number, stretches are counted by a map-side combined aggregation, and the text
itself is shuffled once.

Defined results:

* null or empty text: 0 bytes, nothing removed, SHA-256 of the empty string;
* ``text`` is what stays; a character that a cut divides becomes U+FFFD, while
  ``kept_sha256`` is the digest of the bytes;
* a text shorter than the window is never touched; a text that occurs twice goes as a whole;
* repeated rows and ids: every row counts as a place of its own and is returned;
* empty table: empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm.common import materialise, read_table, small_batches

WINDOW = 400
GRAM = 32
#: Different stretches of one anchor gram that are suffix sorted together.
BUCKET_LIMIT = 1000
_POSITIONS = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15


def _digest(data, size: int = 8) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=size).digest()[:8], "little", signed=True)


class Cutter:
    """Cuts texts into stretches: runs of windows with one anchor."""

    def __init__(self, window: int, gram: int, piece: int = 1 << 20) -> None:
        self.window, self.gram, self.piece = window, gram, piece
        n = piece + 2 * window + 8
        powers = lambda base: np.cumprod(np.array([1] + [base] * n, np.uint64), dtype=np.uint64)
        self.up, self.down = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))

    def runs(self, data: bytes, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first window start, windows, anchor position) of each stretch of joined texts that end at ``ends``."""
        w, g = self.window, self.gram
        n = len(data)
        if n < w:
            return
        b = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(b * self.down[:n], dtype=np.uint64)])
        h = (sums[g:] - sums[: n - g + 1]) * self.up[: n - g + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h = (h & ~_POSITIONS) | np.arange(len(h), dtype=np.uint64)
        span = w - g + 1                                   # grams in a window
        pad = np.full(-len(h) % span, ~np.uint64(0), np.uint64)
        block = np.concatenate([h, pad]).reshape(-1, span)
        ahead = np.minimum.accumulate(block, axis=1).ravel()
        back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - w + 1
        least = np.minimum(back[:windows], ahead[span - 1: span - 1 + windows])
        end_of = ends[np.searchsorted(ends, np.arange(windows), side="right")]
        starts = np.flatnonzero(np.arange(windows) + w <= end_of)
        if not len(starts):
            return
        at = (least[starts] & _POSITIONS).astype(np.int64)
        cut = np.flatnonzero((at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut, [len(starts)]]) - 1
        yield from zip(starts[first].tolist(), (last - first + 1).tolist(), at[first].tolist())

    def stretches(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text index, start, windows, anchor digest, stretch digest, place of the anchor) of all texts."""
        joined: list[tuple[int, int, bytes]] = []          # (text, offset in it, bytes)
        size = 0

        def flush() -> Iterator[tuple[int, int, int, int, int, int]]:
            data = b"".join(x[2] for x in joined)
            ends = np.cumsum([len(x[2]) for x in joined])
            begins = ends - [len(x[2]) for x in joined]
            view = memoryview(data)
            for start, count, at in self.runs(data, ends):
                k = int(np.searchsorted(ends, start, side="right"))
                yield (joined[k][0], start - int(begins[k]) + joined[k][1], count,
                       _digest(view[at: at + self.gram]), _digest(view[start: start + count - 1 + self.window]), at - start)

        for i, text in enumerate(texts):
            if len(text) < self.window:
                continue
            for offset in range(0, len(text) - self.window + 1, self.piece):
                part = text[offset: offset + self.piece + self.window - 1]
                if joined and size + len(part) > self.piece + self.window:
                    yield from flush()
                    joined, size = [], 0
                joined.append((i, offset, part))
                size += len(part)
        if joined:
            yield from flush()


def two_stage_order(t: np.ndarray, raw: bytes, depth: int) -> np.ndarray:
    """Suffix array of ``t`` to ``depth`` bytes; ``raw`` is the same as bytes, and 0 ends it.

    Suffixes smaller than their successors are sorted directly, all others induced.
    """
    n = len(t)
    differ = np.concatenate([t[:-1] != t[1:], [True]])
    nxt = np.minimum.accumulate(np.where(differ, np.arange(n), n)[::-1])[::-1]
    smaller = np.ones(n, bool)
    smaller[:-1] = (t[nxt[:-1]] < t[np.minimum(nxt[:-1] + 1, n - 1)]) | (nxt[:-1] == n - 1)
    direct = np.flatnonzero(smaller)
    key = t[direct].astype(np.int64) * 256 + t[np.minimum(direct + 1, n - 1)]
    order = np.argsort(key, kind="stable")
    direct, key = direct[order], key[order]
    edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    sorted_small: list[list[np.ndarray]] = [[] for _ in range(256)]
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        part = direct[lo:hi]
        if hi - lo > 1:
            part = np.array(sorted(part.tolist(), key=lambda i: raw[i: i + depth]), np.int64)
        sorted_small[int(key[lo]) >> 8].append(part)
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    result = []

    def scan(found: np.ndarray, c: int) -> np.ndarray:
        """Induce the predecessors of ``found``; returns those that fall into bucket ``c`` itself."""
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        first = t[before]
        mine = before[first == c]
        rest = first != c
        before, first = before[rest], first[rest]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        cuts = np.concatenate([[0], np.flatnonzero(first[1:] != first[:-1]) + 1, [len(first)]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if hi > lo:
                induced[int(first[lo])].append(before[lo:hi])
        return mine

    for c in range(256):
        queue = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        while len(queue):
            result.append(queue)
            queue = scan(queue, c)
        for part in sorted_small[c]:
            result.append(part)
        if sorted_small[c]:
            left = scan(np.concatenate(sorted_small[c]), c)
            assert not len(left)       # a larger suffix starts with a larger byte than a smaller successor
    return np.concatenate(result)


def repeated_starts(strings: list[bytes], window: int) -> list[np.ndarray]:
    """For each string the starts of windows that start elsewhere in ``strings`` too."""
    raw = b"".join(s.translate(_SHIFT) + b"\0" for s in strings)
    t = np.frombuffer(raw, np.uint8)
    lengths = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(lengths)
    begins = ends - lengths
    order = two_stage_order(t, raw, window)
    valid = np.zeros(len(t), bool)
    for b, e in zip(begins.tolist(), ends.tolist()):
        valid[b: max(b, e - window)] = True
    order = order[valid[order]]
    padded = np.concatenate([t, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = padded[: len(t)].copy()
    for i in range(1, 8):
        word |= padded[i: len(t) + i] << np.uint64(8 * i)
    a, b = order[:-1], order[1:]
    alive = np.arange(len(a))
    for off in [*range(0, window - 7, 8), *([max(0, window - 8)] if window % 8 else [])]:
        alive = alive[word[a[alive] + off] == word[b[alive] + off]]
        if not len(alive):
            break
    hit = np.zeros(len(t), bool)
    hit[a[alive]] = True
    hit[b[alive]] = True
    return [np.flatnonzero(hit[b: e]) for b, e in zip(begins.tolist(), ends.tolist())]


#: UTF-8 has no byte above 0xF4, so a shift by one leaves 0 for the separator.
_SHIFT = bytes(min(i + 1, 255) for i in range(256))


def _ranges(starts: np.ndarray) -> list[int]:
    """Sorted starts as flat half-open ranges [a0, b0, a1, b1, ...]."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] != starts[:-1] + 1)
    lo = starts[np.concatenate([[0], cut + 1])]
    hi = starts[np.concatenate([cut, [len(starts) - 1]])] + 1
    return np.stack([lo, hi], 1).ravel().tolist()


_RANGES = pa.list_(pa.int32())


def _cut_texts(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(window, gram)
        for batch in batches:
            texts = [x.as_py().encode("utf-8") for x in batch.column(2)]
            rows = list(cutter.stretches(texts))
            i = np.array([r[0] for r in rows], np.int64)
            k1, k2 = (batch.column(c).to_numpy()[i] for c in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64()),
                 pa.array([r[4] for r in rows], pa.int64()),
                 pa.array([r[5] for r in rows], pa.int32())], ["k1", "k2", "start", "windows", "anchor", "stretch", "lead"])
    return run


#: A string to be sorted: its group, the stretch it belongs to, its first window in there, the
#: place of the anchor in it, how often it occurs, and its bytes.
_STRINGS = "key bigint, anchor bigint, stretch bigint, begin int, lead int, n bigint, data binary"
_STRING_NAMES = [c.split(" ")[0] for c in _STRINGS.split(", ")]
_STRING_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]


def _strings(rows: list[tuple], more: dict | None = None) -> pa.RecordBatch:
    types = _STRING_TYPES + list((more or {}).values())
    columns = list(zip(*rows)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], _STRING_NAMES + list(more or {}))


def _fetch(window: int):
    """Rows (text, list of (anchor, stretch, start, windows, lead, n, c)) to strings and the size c of their group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, wanted in zip(batch.column(0), batch.column(1)):
                data = text.as_py().encode("utf-8")
                out += [(w["anchor"], w["anchor"], w["stretch"], 0, w["lead"], w["n"],
                         data[w["start"]: w["start"] + w["windows"] - 1 + window], w["c"]) for w in wanted.as_py()]
            yield _strings(out, {"c": pa.int64()})
    return run


def cut_again(key: int, begin: int, lead: int, data: bytes, window: int, width: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(key, begin, lead, data) of the pieces of a string, by ranges of ``width`` places of the anchor.

    Window i has its anchor at place ``lead - i``. Equal windows of one group fall into
    pieces of equal keys: the key is a digest of the bytes that all windows of the range share.
    """
    windows, i = len(data) - window + 1, 0
    view = memoryview(data)
    while i < windows:
        cell = (lead - i) // width
        least, most = cell * width, (cell + 1) * width - 1
        j = min(windows, lead - least + 1)                       # first window of the next range
        core = view[max(lead - least, 0): max(lead - most + window, 0)]
        name = f"{key} {cell} {width} ".encode()
        yield _digest(name + bytes(core)), begin + i, lead - i, data[i: j - 1 + window]
        i = j


def _cut_strings(window: int, width: int):
    """Strings to their pieces, with a digest of each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, anchor, stretch, begin, lead, n, data in zip(*(batch.column(c).to_pylist() for c in _STRING_NAMES)):
                out += [(k, anchor, stretch, b, p, n, d, _digest(d)) for k, b, p, d in cut_again(key, begin, lead, data, window, width)]
            for at in range(0, len(out), 4096):
                yield _strings(out[at: at + 4096], {"piece": pa.int64()})
    return run


def _widths(window: int) -> list[int]:
    """Ranges of places by which hot groups are cut, one after the other, down to one place."""
    out = [max(1, window // 4)]
    while out[-1] > 1:
        out.append(max(1, out[-1] // 4))
    return out


def _sort_buckets(window: int, batch_bytes: int):
    """Strings sorted by key to the repeated windows of those that occur once: (anchor, stretch, ranges)."""
    def judge(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated_starts([r[6] for r in rows], window)
        kept = [(r[1], r[2], _ranges(f + r[3])) for r, f in zip(rows, found) if r[5] == 1 and len(f)]
        columns = list(zip(*kept)) or [[]] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(list(columns[0]), pa.int64()), pa.array(list(columns[1]), pa.int64()), pa.array(list(columns[2]), _RANGES)],
            ["anchor", "stretch", "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _STRING_NAMES)):
                if held and held[-1][0] != row[0] and size > batch_bytes:
                    yield judge(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield judge(held)
    return run


def _remove(window: int):
    """Rows (doc_id, text, m, list of (start, ranges)) to the result columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, places in zip(batch.column(1), batch.column(3)):
                data = text.as_py().encode("utf-8")
                spans = sorted((p["start"] + p["ranges"][i], p["start"] + p["ranges"][i + 1] - 1 + window)
                               for p in (places.as_py() or []) for i in range(0, len(p["ranges"]), 2))
                stays, at, removed, runs = [], 0, 0, 0
                view = memoryview(data)
                for lo, hi in spans:
                    if lo > at or not runs:
                        stays.append(view[at:lo])
                        runs += 1
                        at = lo
                    if hi > at:
                        removed += hi - at
                        at = hi
                kept = b"".join([*stays, view[at:]]) if runs else data
                out.append((len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), pa.int64()) for c in columns[:3]),
                 pa.array(list(columns[3]), pa.string()), pa.array(list(columns[4]), pa.string()), batch.column(2)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "_m"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int | None = None,
                   bucket_limit: int = BUCKET_LIMIT, batch_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what stays) of every document."""
    if window < 8:
        raise ValueError("a window has 8 bytes at least")
    gram = gram or min(GRAM, window // 2)
    text = F.coalesce("text", F.lit(""))
    keyed = small_batches(docs).select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("k1"),
                        F.xxhash64(F.lit(5), text, "doc_id").alias("k2"))
    # equal rows once, with their number; its exchange serves the fetch and the removal
    rows = keyed.groupBy("k1", "k2").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"),
                                         F.count("*").alias("m"))
    cuts = materialise(keyed.where(F.octet_length("text") >= window).select("k1", "k2", "text").mapInArrow(
        _cut_texts(window, gram), "k1 bigint, k2 bigint, start int, windows int, anchor bigint, stretch bigint, lead int"), "stretches")
    # written, so that the joins on it read plain exchanges, which Spark can split at hot anchors
    shared = materialise(cuts.groupBy("anchor").count().where("count >= 2").select("anchor"), "shared-anchors")
    places = materialise(cuts.join(shared, "anchor", "left_semi"), "shared-stretches")
    kinds = materialise(places.groupBy("anchor", "stretch").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "start", "windows", "lead")).alias("rep")), "stretch-kinds")
    crowd = materialise(kinds.groupBy("anchor").agg(F.count("*").alias("c")).where("c >= 2"), "mixed-anchors")
    mixed = kinds.join(crowd, "anchor")
    wanted = mixed.groupBy("rep.k1", "rep.k2").agg(F.collect_list(F.struct(
        "anchor", "stretch", F.col("rep.start").alias("start"), F.col("rep.windows").alias("windows"),
        F.col("rep.lead").alias("lead"), "n", "c")).alias("w"))
    strings = (rows.join(wanted, ["k1", "k2"]).select("text", "w")
               .mapInArrow(_fetch(window), _STRINGS + ", c bigint"))
    ready, whole = [], []
    widths = iter(_widths(window))
    most = crowd.agg(F.max("c")).first()[0] or 0
    while most > bucket_limit:
        strings = materialise(strings, "strings")
        ready.append(strings.where(F.col("c") <= bucket_limit).drop("c"))
        pieces = materialise(strings.where(F.col("c") > bucket_limit).drop("c").mapInArrow(
            _cut_strings(window, next(widths)), _STRINGS + ", piece bigint"), "pieces")
        same = ["key", "piece"]
        first = materialise(pieces.groupBy(*same).agg(F.sum("n").alias("n"), F.min(F.struct("anchor", "stretch", "begin")).alias("rep")),
                            "piece-kinds")
        many = first.where("n >= 2").select(*same)
        whole.append(pieces.join(many, same).select("anchor", "stretch", F.array(
            "begin", F.col("begin") + F.octet_length("data") - (window - 1)).alias("ranges")))
        groups = materialise(first.groupBy("key").agg(F.count("*").alias("c")).where("c >= 2"), "piece-groups")
        one = first.join(groups, "key").select(*same, "n", "c", "rep.*")
        strings = pieces.drop("n").join(one, [*same, "anchor", "stretch", "begin"]).select(*_STRING_NAMES, "c")
        most = groups.agg(F.max("c")).first()[0] or 0
    ready.append(strings.drop("c"))
    few = ready[0]
    for part in ready[1:]:
        few = few.unionByName(part)
    verdict = (few.select(*_STRING_NAMES).repartition("key").sortWithinPartitions("key", "anchor", "stretch", "begin")
               .mapInArrow(_sort_buckets(window, batch_bytes), "anchor bigint, stretch bigint, ranges array<int>"))
    for part in whole:
        verdict = verdict.unionByName(part)
    copies = kinds.where("n >= 2").select("anchor", "stretch", F.array(F.lit(0), F.col("rep.windows")).alias("ranges"))
    gone = (places.join(verdict.unionByName(copies), ["anchor", "stretch"])
            .groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "ranges")).alias("p")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    done = (rows.join(gone, ["k1", "k2"], "left").select("doc_id", "text", "m", "p")
            .mapInArrow(_remove(window), f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                        "kept_sha256 string, text string, _m bigint"))
    return (done.withColumn("_one", F.explode(F.sequence(F.lit(1), F.col("_m").cast("int")))).drop("_m", "_one"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their repeated strings of 400 bytes."""
    return remove_repeats(read_table(spark, sf_dir, "documents"))
