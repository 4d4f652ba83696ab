"""Quality rules and a hashed n-gram likelihood ratio.

Two multinomials over hashed byte n-grams (``GRAM`` bytes, ``BUCKETS`` buckets) are counted:
the raw corpus is every document, the trusted target every document labelled of quality 1
and not toxic. A document's verdict is the mean over its n-grams of
log(target share / raw share), both smoothed by one per bucket, against one threshold for
all documents. The threshold parts the trusted documents from those labelled bad or toxic:
the largest value whose balanced accuracy is within ``TOLERANCE`` of the best, read from a
histogram of ``BINS`` bins, yet at most ``CLEAN_SHARE`` of the trusted documents lie below
it, not counting those that mislabelled bad ones explain (see ``best_threshold``).
The base rules fail a document of fewer than 10 words, or with more than 20 % of its words
in 5-word windows that occur twice or more.

Only the two count vectors (``BUCKETS`` longs each, whatever the corpus) and the histogram
reach the driver.

Defined results:

* null or empty text: no words, ``base_failed`` true, ``kept`` false, ``llr`` 0;
* fewer than ``GRAM`` bytes: ``llr`` 0;
* labels repeated for one doc_id: trusted if any row trusts it and none calls it toxic or bad;
* a toxic document counts as bad for the threshold, whatever its quality;
* no labels, or labels of one kind only: threshold minus infinity, the base rules decide;
* repeated rows: each is counted and returned; null doc_id: never labelled;
* empty table: empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm.common import materialise, read_table, small_batches

GRAM = 4
BUCKETS = 1 << 16
BINS = 4000
SPAN = 8.0           # histogram from -SPAN to SPAN
CLEAN_SHARE = 0.002
TOLERANCE = 0.02
#: Noise of the labels is read where this share of the bad ones lies below, and believed so far.
NOISE_FROM = 0.25
MAX_NOISE = 0.1
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"


def gram_buckets(data: bytes, piece: int = 1 << 20) -> Iterator[np.ndarray]:
    """Buckets of all byte n-grams, in arrays of about ``piece`` entries."""
    for start in range(0, max(len(data) - GRAM + 1, 0), piece):
        b = np.frombuffer(data, np.uint8, min(piece + GRAM - 1, len(data) - start), start).astype(np.uint32)
        n = len(b) - GRAM + 1
        code = b[:n].copy()
        for i in range(1, GRAM):
            code |= b[i: n + i] << np.uint32(8 * i)
        code *= np.uint32(0x9E3779B1)
        yield (code ^ (code >> np.uint32(15))) >> np.uint32(16)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    data = text.encode("utf-8")
    words = data.split()
    n = len(words)
    chars = len(text) - (len(data) - len(data.translate(None, _SPACE)))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n >= 6:
        ids: dict[bytes, int] = {}
        code = [ids.setdefault(w, len(ids)) for w in words]
        windows = list(zip(code, code[1:], code[2:], code[3:], code[4:]))
        if len(set(windows)) < len(windows):
            seen, last = Counter(windows), -1
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    repeated += i + 5 - max(i, last)
                    last = i + 5
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def trusted_labels(labels: DataFrame) -> DataFrame:
    """doc_id and ``_good`` (true: trusted, false: bad quality) of the labelled documents."""
    good = F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0))
    bad = F.max(F.when(F.col("quality") == 0, 1).otherwise(0))
    return (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id")
            .agg(good.alias("g"), bad.alias("b")).where("g = 1 or b = 1").select("doc_id", (F.col("g") == 1).alias("_good")))


def threshold_labels(labels: DataFrame) -> DataFrame:
    """``trusted_labels`` with every toxic document as one that is not good, whatever its quality."""
    toxic = labels.where(F.col("doc_id").isNotNull() & (F.col("toxic") == 1)).select("doc_id", F.lit(False).alias("_good"))
    return trusted_labels(labels).unionByName(toxic).groupBy("doc_id").agg(F.min("_good").alias("_good"))


def gram_counts(docs: DataFrame) -> np.ndarray:
    """Bucket counts (``BUCKETS``) over all texts of ``docs``: one partial vector per task, summed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t in batch.column(0):
                if t.is_valid:
                    for buckets in gram_buckets(t.as_py().encode("utf-8")):
                        counts += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["bucket", "n"])

    rows = small_batches(docs).select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS, np.int64)
    for r in rows.collect():
        total[r.bucket] = r.n
    return total


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(target share / raw share) of every bucket, smoothed by one count per bucket."""
    share = lambda c: np.log((c + 1.0) / (c.sum() + len(c)))
    return share(target) - share(raw)


def score(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, the base counts and ``llr`` of every document."""
    table = ratio.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, llr = [], []
            for t in batch.column(1):
                text = t.as_py() if t.is_valid else ""
                rows.append(base_counts(text))
                total, n = 0.0, 0
                for buckets in gram_buckets(text.encode("utf-8")):
                    total += float(table[buckets].sum())
                    n += len(buckets)
                llr.append(total / n if n else 0.0)
            columns = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in columns), pa.array(llr, pa.float64())],
                ["doc_id", *NAMES, "llr"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in NAMES) + ", llr double")


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def best_threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """Threshold on the bin edges (kept: llr >= threshold) from histograms of both kinds.

    The largest edge whose balanced accuracy is within ``TOLERANCE`` of the best, but never
    so high that more than ``CLEAN_SHARE`` of the good are lost below it. Bad documents
    mislabelled as good lie as the bad do: their share ``noise`` is the least ratio of both
    cumulative shares (``MAX_NOISE`` at most), and only the good beyond ``noise`` times the
    bad at some edge (and a Kolmogorov-Smirnov bound for such a sample) count as lost.
    """
    if not good.sum() or not bad.sum():
        return -math.inf
    below_good = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    below_bad = np.concatenate([[0], np.cumsum(bad)]) / bad.sum()
    gain = (below_bad - below_good) / 2
    edge = int(np.flatnonzero(gain >= gain.max() - TOLERANCE)[-1])
    seen = below_bad >= NOISE_FROM
    noise = min(MAX_NOISE, float((below_good[seen] / below_bad[seen]).min()))
    room = CLEAN_SHARE + 1.5 * noise * math.sqrt(1 / max(1.0, noise * good.sum()) + 1 / bad.sum())
    lost = np.maximum.accumulate(below_good - noise * below_bad)
    edge = min(edge, int(np.searchsorted(lost, room, side="right")) - 1)
    return -math.inf if edge == 0 else -SPAN + edge * 2 * SPAN / BINS


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, base counts, llr, base_failed and kept of every document."""
    marks = materialise(threshold_labels(labels), "quality-labels")
    # labels grow with the corpus: dealt by doc_id like the texts, at every size
    good = marks.where("_good").select("doc_id").hint("shuffle_hash")
    trusted = docs.select("doc_id", "text").join(good, "doc_id", "left_semi")
    ratio = log_ratio(gram_counts(trusted), gram_counts(docs))
    scored = materialise(score(docs, ratio), "quality-scores")
    base_failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    scored = scored.withColumn("base_failed", base_failed)
    place = F.least(F.greatest(F.floor((F.col("llr") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    seen = (scored.where(~F.col("base_failed")).join(marks, "doc_id")
            .groupBy(place.alias("bin"), "_good").count().collect())
    kinds = np.zeros((2, BINS), np.int64)
    for r in seen:
        kinds[int(r["_good"]), r["bin"]] = r["count"]
    limit = best_threshold(kinds[1], kinds[0])
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(limit)))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and likelihood-ratio verdict of all documents."""
    return judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
