"""Hard-negative mining with exact integer scores from a residue-number-system GEMM.

Components become integers ``floor(scale * x)`` and a score is their inner product. No
float32 product could hold it exactly, so the component matrices are reduced modulo a few
primes below 1024, each pair of residue matrices is multiplied in float32 (64 products of
centred residues stay below 2^24, where float32 is exact; longer vectors are summed by
slices of 64 with a reduction in between), and Chinese remaindering gives the signed score
back. The number of primes follows from the largest squared norm (Cauchy-Schwarz).

The work is a blocked matrix product. Anchors are dealt into blocks of about
``anchor_block`` by a hash, rows into shards; a task holds one block of anchors and streams
the rows of one shard past it, so its memory is the block, one Arrow batch and the short
lists kept per anchor. Two passes:

1. the first ``n_positives`` rows of an anchor's label, by score;
2. for each of these the first ``n_negatives`` rows of other labels whose score lies in the
   window ``low * positive <= negative <= high * positive`` (exact fractions).

Each task emits its best rows per anchor, and a window over these few rows picks the best of
all shards. No row meets another row outside these blocks; ties are decided by vec_id.

Defined results:

* rows with a null vec_id, label or vector, or a null or non-finite component take no part;
* vectors of different lengths: the shorter count as filled up with zeros, so an empty vector
  scores 0 with all;
* repeated rows and ids: every row is a row of its own, an anchor's "other rows" are all but
  itself; a repeated anchor returns its rows as often as it occurs;
* a positive of negative score has an empty window and returns nothing;
* scores that a long cannot hold (a squared norm of 2^62 or more) raise ValueError;
* empty table or no anchors: empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepulse.llm.common import materialise, read_table

#: Largest sum that float32 holds exactly, and the slice length that keeps below it.
_EXACT = 1 << 24
_SLICE = 64
_NONE = np.iinfo(np.int64).min
#: Anchors multiplied at a time with one batch of rows.
_ANCHORS_AT_ONCE = 1024


def primes_for(bound: int, below: int = 1024) -> list[int]:
    """The largest primes under ``below`` whose product exceeds ``2 * bound``."""
    found, product = [], 1
    for n in range(below - 1, 2, -1):
        if product > 2 * bound:
            return found
        if all(n % d for d in range(2, int(n ** 0.5) + 1)):
            assert _SLICE * ((n - 1) // 2) ** 2 < _EXACT
            found.append(n)
            product *= n
    raise ValueError("bound too large for the primes")


def residues(values: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Centred residues of integral float64 ``values`` as float32, one matrix per prime."""
    out = []
    for p in primes:
        r = np.fmod(values, p)                       # exact for doubles of any size
        half = (p - 1) // 2
        r[r > half] -= p
        r[r < -half] += p
        out.append(r.astype(np.float32))
    return out


def exact_scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Signed inner products (int64) of the rows of two residue systems."""
    value, base, product = None, 1, []
    for p, a, b in zip(primes, left, right):
        r = np.zeros((len(a), len(b)))
        for at in range(0, a.shape[1], _SLICE):
            r += a[:, at: at + _SLICE] @ b[:, at: at + _SLICE].T
            np.fmod(r, p, out=r)
        r = r.astype(np.int64)
        if value is None:
            digit = r
            value = np.zeros_like(r)
        else:                                        # mixed radix: the next digit modulo p
            known = np.zeros_like(r)
            for digit_, base_ in product:
                known += digit_ * (base_ % p)
            digit = (r - known) * pow(base, -1, p)
        digit = digit % p
        digit[digit > (p - 1) // 2] -= p             # centred digits give the signed value
        product.append((digit, base))
        value += digit * np.int64(((base + 2 ** 63) % 2 ** 64) - 2 ** 63)
        base *= p
    return value if value is not None else np.zeros((len(left), len(right)), np.int64)


def _first(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores of the first ``k`` of each row: highest first, then leftmost."""
    order = np.argsort(~scores, axis=1, kind="stable")[:, :k]
    return order, np.take_along_axis(scores, order, 1)


class _Best:
    """Running best rows per list: scores, ids and row keys, best first."""

    def __init__(self, lists: int, k: int) -> None:
        self.k = k
        self.score = np.full((lists, k), _NONE)
        self.id = np.zeros((lists, k), np.int64)
        self.uid = np.zeros((lists, k), np.int64)

    def add(self, at: slice, score: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        s = np.concatenate([self.score[at], score], 1)
        i = np.concatenate([self.id[at], ids], 1)
        u = np.concatenate([self.uid[at], uids], 1)
        order = np.lexsort((u, i, ~s), axis=1)[:, : self.k]
        for mine, new in ((self.score, s), (self.id, i), (self.uid, u)):
            mine[at] = np.take_along_axis(new, order, 1)


def window_bounds(positive: np.ndarray, low: int, high: int, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """Integer bounds of ``low * p <= unit * n <= high * p``, without overflow."""
    q, r = np.divmod(positive, unit)
    return q * low - (-r * low) // unit, q * high + (r * high) // unit


class _Anchors:
    """One block of anchors: their residues and the lists kept for them."""

    def __init__(self, rows: list[dict], dims: int, primes: list[int], k: int, window: tuple[int, int, int] | None):
        self.uid, self.label = (np.concatenate([r[c] for r in rows]) for c in ("uid", "label"))
        self.parts = residues(np.concatenate([r["values"] for r in rows]), primes)
        self.primes, self.window, self.k = primes, window, k
        if window:
            scores = np.concatenate([r["scores"] for r in rows])             # _NONE where there is no positive
            self.low, self.high = window_bounds(scores, *window)
            self.high[scores == _NONE] = _NONE
            self.low[scores == _NONE] = _NONE + 1
        self.lists = scores.shape[1] if window else 1
        self.best = [_Best(len(self.uid), k) for _ in range(self.lists)]

    def meet(self, ids: np.ndarray, uids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> None:
        """Rows sorted by (id, uid) against all anchors of the block."""
        other = residues(values, self.primes)
        for lo in range(0, len(self.uid), _ANCHORS_AT_ONCE):
            at = slice(lo, lo + _ANCHORS_AT_ONCE)
            scores = exact_scores([p[at] for p in self.parts], other, self.primes)
            same = self.label[at, None] == labels[None, :]
            if not self.window:
                scores[~same | (self.uid[at, None] == uids[None, :])] = _NONE
                columns, found = _first(scores, self.k)
                self.best[0].add(at, found, ids[columns], uids[columns])
                continue
            scores[same] = _NONE
            order, ranked = _first(scores, scores.shape[1])
            for j in range(self.lists):
                low, high = self.low[at, j], self.high[at, j]
                begin = (ranked > high[:, None]).sum(1)
                take = np.minimum(begin[:, None] + np.arange(self.k), ranked.shape[1] - 1)
                found = np.take_along_axis(ranked, take, 1)
                beyond = begin[:, None] + np.arange(self.k) >= ranked.shape[1]
                found = np.where(beyond | (found < low[:, None]), _NONE, found)
                columns = np.take_along_axis(order, take, 1)
                self.best[j].add(at, found, ids[columns], uids[columns])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for j, best in enumerate(self.best):
            a, c = np.nonzero(best.score != _NONE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.uid[a]), pa.array(np.full(len(a), j, np.int32)), pa.array(best.score[a, c]),
                 pa.array(best.id[a, c]), pa.array(best.uid[a, c])], ["anchor", "list", "score", "id", "uid"])


_FOUND = "anchor bigint, list int, score bigint, id bigint, uid bigint"


def _multiply(dims: int, primes: list[int], k: int, window: tuple[int, int, int] | None, lists: int):
    """Batches sorted by (_block, _shard, _tag, id, uid): anchors first, then rows, of each group."""

    def dense(column: pa.Array) -> np.ndarray:
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        lengths = np.diff(column.offsets.to_numpy())
        out = np.zeros((len(column), dims))
        out[np.arange(dims)[None, :] < lengths[:, None]] = flat
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, waiting, anchors = None, [], None
        for batch in batches:
            block, shard, tag, ids, uids, labels = (batch.column(i).to_numpy() for i in range(6))
            edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(shard) != 0) | (np.diff(tag) != 0)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(block)]):
                if hi == lo:
                    continue
                if group != (block[lo], shard[lo]):
                    if anchors is not None:
                        yield from anchors.rows()
                    group, waiting, anchors = (block[lo], shard[lo]), [], None
                values = dense(batch.column(6).slice(lo, hi - lo))
                if tag[lo] == 0:
                    rows = {"uid": uids[lo:hi], "label": labels[lo:hi], "values": values}
                    if window:
                        scores = np.full((hi - lo, lists), _NONE)
                        for i, s in enumerate(batch.column(7).slice(lo, hi - lo).to_pylist()):
                            scores[i, : len(s or ())] = s or ()
                        rows["scores"] = scores
                    waiting.append(rows)
                    continue
                if anchors is None and waiting:
                    anchors = _Anchors(waiting, dims, primes, k, window)
                    waiting = []
                if anchors is not None:
                    anchors.meet(ids[lo:hi], uids[lo:hi], labels[lo:hi], values)
        if anchors is not None:
            yield from anchors.rows()
    return run


def mine_hard_negatives(rows: DataFrame, is_anchor: Column, vector: str = "embedding", scale: int = 256,
                        n_positives: int = 5, n_negatives: int = 10, window: tuple[int, int, int] = (30, 90, 100),
                        anchor_block: int = 4096) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` needs vec_id, label and the vector; ``is_anchor`` is a condition on vec_id.
    ``window`` is (low, high, unit): ``low * p <= unit * n <= high * p``.
    """
    low, high, unit = window
    spark = rows.sparkSession
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull()
              & F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    # floor of a double is a long in SQL; beyond its range the double is integral already
    whole = F.transform(F.col(vector), lambda x: F.when(
        F.abs(x.cast("double")) < F.lit(2.0 ** 52), F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
        .otherwise(x.cast("double") * F.lit(float(scale))))
    table = materialise(
        rows.where(usable).select(F.col("vec_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("uid"),
                                  F.col("label").cast("long").alias("label"), whole.alias("v")), "negative-rows")
    norm = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    known = table.withColumnRenamed("id", "vec_id").withColumn("_anchor", F.coalesce(is_anchor, F.lit(False)))
    most, dims, n_anchors = known.agg(F.max(norm), F.max(F.size("v")), F.count(F.when(F.col("_anchor"), 1))).first()
    if (most or 0) >= 2.0 ** 62:
        raise ValueError("scores do not fit a long: a squared norm reaches 2^62")
    primes = primes_for(int((most or 0) * (1 + 1e-9)) + 1)
    known = known.withColumnRenamed("vec_id", "id")
    anchors = known.where("_anchor")
    blocks = max(1, -(-n_anchors // anchor_block))
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks)
    block = F.pmod(F.xxhash64(F.lit(3), "uid"), F.lit(blocks)).cast("int")
    shard = F.pmod(F.xxhash64(F.lit(4), "uid"), F.lit(shards)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def product(with_scores: DataFrame, k: int, bounds: tuple[int, int, int] | None) -> DataFrame:
        """Best rows of each anchor over all rows: anchor, list, score, id, uid, rank."""
        columns = ["_block", "_shard", "_tag", "id", "uid", "label", "v", "s"]
        one = with_scores.select(block.alias("_block"), every(shards).alias("_shard"), F.lit(0).alias("_tag"),
                                 "id", "uid", "label", "v", "s")
        two = known.select(every(blocks).alias("_block"), shard.alias("_shard"), F.lit(1).alias("_tag"),
                           "id", "uid", "label", "v", F.lit(None).cast("array<bigint>").alias("s"))
        met = (one.unionByName(two).repartition(blocks * shards, "_block", "_shard")
               .sortWithinPartitions("_block", "_shard", "_tag", "id", "uid").select(*columns)
               .mapInArrow(_multiply(dims or 0, primes, k, bounds, n_positives), _FOUND))
        best = Window.partitionBy("anchor", "list").orderBy(F.desc("score"), "id", "uid")
        return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    positives = materialise(product(anchors.withColumn("s", F.lit(None).cast("array<bigint>")), n_positives, None)
                            .select("anchor", F.col("rank").alias("place"), F.col("score").alias("positive_score"),
                                    F.col("id").alias("positive_id")), "positives")
    lists = positives.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))),
                                                        lambda x: x["positive_score"]).alias("s"))
    bounded = anchors.join(lists.withColumnRenamed("anchor", "uid"), "uid")
    negatives = product(bounded, n_negatives, (low, high, unit)).select(
        "anchor", (F.col("list") + 1).alias("place"), "rank", F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    names = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    return (negatives.join(positives, ["anchor", "place"]).join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vec_id divisible by 100; labels move on where divisible by 7."""
    table = read_table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine_hard_negatives(table.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


#: DuckDB SQL of the same rows.
OP12_SQL = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
    CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM kept a, kept r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
  s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
