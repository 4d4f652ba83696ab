"""SimHash near-duplicates by a binary trie self-join.

A fingerprint has 64 bits; two link at ``max_bits`` or fewer differing bits. The distinct
fingerprints form a binary trie. Pairs of its nodes are walked down together, each step
adds the bits in which the two branches differ, and a pair is dropped as soon as that sum
exceeds the error budget. Equal nodes start the walk, so every pair of leaves is met once.

The walk is spread out by its first levels: of ``max_bits + 1`` equal blocks of bits, two
linked fingerprints agree in one at least, so the trie is walked once per rotation that
puts a block on top, and a node below that block is a task key of its own. A node pair
with more than ``pair_limit`` leaves is walked 8 levels further by a DataFrame step that
deals its leaves to all child pairs inside the budget, again and again until every pair
fits. What a task finds are links of a spanning forest of its leaves, so no group emits
all its pairs; connected components of these links follow by star contraction.

Defined results:

* null or empty text, or white space only: fingerprint zero, linked like any other;
* fewer words than a shingle: the whole sequence is the one shingle;
* equal fingerprints and repeated rows: always linked, each row is returned;
* null doc_id: never a component id unless no other document is reachable (then null);
* empty table: empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from zonepulse.llm.common import materialise, other_columns_aside, read_table, small_batches

_PIECE = 1 << 20


def word_lists(data: bytes, piece: int = _PIECE) -> Iterator[list[bytes]]:
    """The ASCII-white-space separated words of ``data`` in lists of about ``piece`` bytes."""
    if len(data) <= piece:
        yield data.split()
        return
    view, start = memoryview(data), 0
    while start < len(data):
        cut = min(start + piece, len(data))
        while cut < len(data) and data[cut] not in b" \t\n\x0b\x0c\r":
            cut += 1
        yield bytes(view[start:cut]).split()
        start = cut


def simhash(data: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of lower-cased (A-Z) word shingles hashed by XXH64 with seed 42."""
    digest, counts, total, tail = xxhash.xxh64_intdigest, np.zeros(2048, np.int64), 0, []
    offsets = np.arange(0, 2048, 256, dtype=np.int64)
    for words in word_lists(data.lower()):
        words = tail + words
        if len(words) >= shingle:
            hashes = [digest(b" ".join(s), 42) for s in zip(*(words[i:] for i in range(shingle)))]
            octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
            counts += np.bincount((octets + offsets).ravel(), minlength=2048)
            total += len(hashes)
        tail = words[-(shingle - 1):] if shingle > 1 else []
    if not total:
        return digest(b" ".join(tail), 42) if tail else 0
    octet_bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    ones = (counts.reshape(8, 256) @ octet_bits.astype(np.int64)).ravel()
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def with_simhash(docs: DataFrame, shingle: int = 3, name: str = "_simhash") -> DataFrame:
    """``docs`` plus the fingerprint of ``text`` (the 64 bits as a signed long)."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [simhash(t.as_py().encode("utf-8") if t.is_valid else b"", shingle) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(fp, np.uint64).view(np.int64), pa.int64())],
                [*batch.schema.names, name])

    return small_batches(docs).mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and ``fp`` of every document."""
    return with_simhash(docs.select("doc_id", "text"), shingle).select("doc_id", F.col("_simhash").alias("fp"))


class Forest:
    """Disjoint sets over 0..n-1; roots are the smallest members."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        p = self.parent
        while True:
            up = p[x]
            if np.array_equal(up, x):
                return x
            p[x] = p[up]
            x = up

    def union(self, x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            x, y = self.find(x), self.find(y)
            apart = x != y
            x, y = x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


def trie_links(leaves: np.ndarray, pairs: np.ndarray, depths: np.ndarray, max_bits: int,
               chunk: int = 400_000) -> np.ndarray:
    """Walk node pairs down the trie over ``leaves``; returns each leaf's set (smallest index).

    ``leaves`` (uint64) ascend inside every node. ``pairs`` has a row (lo, hi, lo2, hi2,
    differing bits so far) of leaf ranges for each pair of nodes to start from, and
    ``depths`` the bits both nodes already share as prefix length.
    """
    forest, ones = Forest(len(leaves)), {}
    stack = [(int(d), pairs[depths == d]) for d in np.unique(depths)]
    while stack:
        depth, p = stack.pop()
        if len(p) > chunk:
            stack += [(depth, p[: len(p) // 2]), (depth, p[len(p) // 2:])]
            continue
        size, size2 = p[:, 1] - p[:, 0], p[:, 3] - p[:, 2]
        small = size * size2 <= 8
        if small.any():     # few leaves: add all their remaining bits at once
            q, n = p[small], (size * size2)[small]
            of = np.repeat(np.arange(len(q)), n)
            k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            x = q[of, 0] + k // size2[small][of]
            y = q[of, 2] + k % size2[small][of]
            near = np.bitwise_count(leaves[x] ^ leaves[y]) <= max_bits
            forest.union(x[near], y[near])
            p = p[~small]
        if depth == 64:     # equal leaves
            forest.union(p[:, 0], p[:, 2])
            continue
        if not len(p):
            continue
        if depth not in ones:
            bit = (leaves >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        c = ones[depth]
        lo, hi, lo2, hi2, e = p.T
        mid, mid2 = hi - (c[hi] - c[lo]), hi2 - (c[hi2] - c[lo2])
        same = (lo == lo2) & (hi == hi2)
        down = [np.stack(x, 1) for x in (
            (lo, mid, lo2, mid2, e), (mid, hi, mid2, hi2, e), (lo, mid, mid2, hi2, e + 1))]
        down.append(np.stack((mid, hi, lo2, mid2, e + 1), 1)[~same])
        down = np.concatenate(down)
        alive = (down[:, 4] <= max_bits) & (down[:, 1] > down[:, 0]) & (down[:, 3] > down[:, 2])
        stack.append((depth + 1, down[alive]))
    return forest.find(np.arange(len(leaves)))


def _walk(max_bits: int, batch_rows: int):
    """Task side of the walk: rows (rot, depth, a, b, x) sorted by the first four, then x."""

    def links(t: np.ndarray) -> pa.RecordBatch:
        rot, depth, a, b, x = t
        leaves = x.view(np.uint64)
        new = np.ones(len(x), bool)
        new[1:] = (rot[1:] != rot[:-1]) | (depth[1:] != depth[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], len(x))
        d = depth[lo]
        upper = (leaves >> (64 - depth).astype(np.uint64)).view(np.int64) == b    # side of the second node
        c = np.concatenate([[0], np.cumsum(upper)])
        mid = hi - (c[hi] - c[lo])
        same = a[lo] == b[lo]
        bits = np.bitwise_count((a[lo] ^ b[lo]).view(np.uint64)).astype(np.int64)
        pairs = np.stack((lo, np.where(same, hi, mid), np.where(same, lo, mid), hi, bits), 1)
        full = (pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2])
        root = trie_links(leaves, pairs[full], d[full], max_bits)
        tied = np.flatnonzero(root != np.arange(len(x)))
        turn = rot[tied].astype(np.uint64)

        def back(v: np.ndarray) -> np.ndarray:      # undo the rotation
            return np.where(turn == 0, v, (v >> turn) | (v << ((np.uint64(64) - turn) % np.uint64(64)))).view(np.int64)

        u, v = back(leaves[tied]), back(leaves[root[tied]])
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]))
            rows += batch.num_rows
            if rows < batch_rows:
                continue
            t = np.concatenate(held, 1)
            key = t[:4]
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0))
            if len(change):                     # the last node pair may go on
                cut = change[-1] + 1
                yield links(t[:, :cut])
                t = t[:, cut:]
            held, rows = [np.ascontiguousarray(t)], t.shape[1]
        if rows:
            yield links(np.concatenate(held, 1))

    return run


def near_links(fps: DataFrame, max_bits: int = 3, pair_limit: int = 100_000) -> DataFrame:
    """Links (u, v) between distinct fingerprints of column ``fp``, enough to connect all near ones."""
    block = 64 // (max_bits + 1)
    turn = F.explode(F.array(*[F.lit(block * i) for i in range(max_bits + 1)]))
    x = F.when(F.col("rot") == 0, F.col("fp")).otherwise(
        F.expr("shiftleft(fp, rot) | shiftrightunsigned(fp, 64 - rot)"))
    prefix = F.expr(f"shiftrightunsigned(x, {64 - block})")
    front = (fps.select("fp").distinct().withColumn("rot", turn).withColumn("x", x)
             .select("rot", F.lit(block).alias("depth"), prefix.alias("a"), prefix.alias("b"), "x"))
    node = ["rot", "depth", "a", "b"]
    ripe, depth = [], block
    while True:
        front = materialise(front, "trie")
        crowded = materialise(front.groupBy(*node).count().where(F.col("count") > pair_limit).select(*node), "crowded")
        if depth + 8 > 56 or crowded.isEmpty():
            ripe.append(front)
            break
        ripe.append(front.join(crowded, node, "left_anti"))
        flips = [f for f in range(256) if f.bit_count() <= max_bits]
        own = F.expr("shiftrightunsigned(x, 64 - depth)")
        child = F.expr("shiftrightunsigned(x, 56 - depth) & 255L")
        other = F.when(own == F.col("a"), F.col("b")).otherwise(F.col("a"))
        front = (
            front.join(crowded, node, "left_semi")
            .withColumn("_flip", F.explode(F.array(*[F.lit(f).cast("long") for f in flips])))
            .where(F.expr(f"bit_count(_flip) + bit_count(a ^ b) <= {max_bits}"))
            .withColumn("_mine", own * 256 + child)
            .withColumn("_other", other * 256 + child.bitwiseXOR(F.col("_flip")))
            .select("rot", (F.col("depth") + 8).alias("depth"), F.least("_mine", "_other").alias("a"),
                    F.greatest("_mine", "_other").alias("b"), "x"))
        depth += 8
    rows = ripe[0]
    for more in ripe[1:]:
        rows = rows.unionByName(more)
    columns = [F.col(c).cast("long") for c in (*node, "x")]
    return (rows.select(*columns).repartition(*node).sortWithinPartitions(*node, F.col("x").bitwiseXOR(F.lit(-(1 << 63))))
            .mapInArrow(_walk(max_bits, 200_000), "u bigint, v bigint"))


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (u, v): (node, root), root the smallest node.

    Alternating large-star and small-star contraction, O(log n) rounds of joins on the
    node; each round is written to the shared scratch folder.
    """
    edges = materialise(links.where("u <> v").distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
        edges = materialise(small.where("u <> v").distinct(), "links")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3, pair_limit: int = 100_000) -> DataFrame:
    """doc_id, ``fp`` and ``component_id`` (smallest doc_id reachable) of every document."""
    fps = materialise(fingerprints(docs, shingle), "simhash")
    roots = components(near_links(fps, max_bits, pair_limit))
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("_first"))
    rooted = firsts.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "_first", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    of = rooted.join(ids, "root").select("fp", "component_id", F.col("root").alias("component_fp"))
    return fps.join(of, "fp").select("doc_id", "fp", "component_id", "component_fp")


@other_columns_aside("doc_id", "text")
def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (ties: fingerprint).

    Rows that agree in doc_id and fingerprint are near-duplicates of each other, so any
    one of them stands for all.
    """
    classes = materialise(simhash_components(docs, shingle, max_bits), "simhash-classes")
    best = classes.groupBy("component_fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "fp")).alias("b"))
    rows = classes.groupBy("doc_id").agg(F.count("*").alias("_rows"))
    keep = best.select(F.col("b.doc_id").alias("_id"), F.col("b.fp").alias("_fp"))
    keep = materialise(keep.join(rows, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("doc_id"), "simhash-keep")
    alone = docs.join(keep.where("_rows = 1"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    # a doc_id of several rows: its fingerprint tells which of them stays
    many = keep.where("_rows > 1")
    shared = docs.join(many, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    shared = with_simhash(shared, shingle).join(
        many, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_simhash") == F.col("_fp")), "left_semi")
    return alone.unionByName(shared.dropDuplicates(["doc_id", "_simhash"]).drop("_simhash"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents: 3-word shingles, 3 bits."""
    classes = simhash_components(read_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
