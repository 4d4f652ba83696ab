"""Prefix trie of conversations from padded turn-id matrices.

A conversation is the sequence of its turns; a turn's id is the first half of the SHA-256 of
its role and text, so texts never travel. Equal sequences are counted first. The distinct
sequences are range-partitioned in lexicographic order, so the members of every trie node
are neighbours, within one shard or over consecutive ones. A shard is worked on as matrices:

1. turn ids become dense numbers, padded by -1, in strips of ``STRIP`` columns that hold
   only the rows which reach them, so one long conversation does not widen all rows;
2. ``lexsort`` orders the rows strip by strip;
3. the columns where a row differs from the row before are OR-accumulated to the right: a
   set bit is the start of a node at that depth, and the clear ones count the shared turns;
4. ``reduceat`` over the starts gives each depth's counts, smallest members, leaves, children
   and saved tokens.

What a shard cannot see is how many turns its first and last rows share with the
neighbouring shards. These two numbers come from a table with the first and last sequence of
each shard. Nodes on those shared paths are emitted in parts with a key (a digest of their
turns); parts add up, since a node, child or leaf is counted in the shard where it starts
or ends. All other nodes are final.

Saved tokens need no look at finished nodes: a member saves, below a node, the words it
shares with the row before it, or all its words if it is a copy.

Digests of members: ids are ordered by a range partitioning on (sequence, id), joined into
pieces of ``PIECE`` ids where they lie, and the pieces of a sequence stream through one
SHA-256 in constant memory. A digest of all ids of a hot sequence is one stream by its
definition, but it reads pieces, not rows.

Defined results:

* null conv_id: the row takes no part; null role or text: empty;
* turns of equal number: by the digest of role and text (equal turns are interchangeable);
* repeated rows are turns of their own; negative ids: ``%`` keeps the sign, as in SQL;
* empty texts: turns without words; a rebuilt conversation without turns ends at the root;
* empty table: no conversation, so no root and an empty result;
* one conversation must fit into a row (16 bytes a turn); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepulse.llm.common import materialise, read_table, word_count

#: Columns of one padded matrix.
STRIP = 32
#: Ids of one piece of a member list.
PIECE = 4096
_ID = 16
_EMPTY = hashlib.sha256().hexdigest()


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, ids (array of hex turn ids), words (array) of each conversation in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").alias("turn"),
                    F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * _ID).alias("id"),
                    word_count(text).alias("words"))
    held = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = held.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.col("t.id").alias("ids"), F.col("t.words").alias("words"))


def rebuild(conversations: DataFrame, span: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first h turns replaced by those of conversation c - c % span.

    h is crc32(decimal c) % ``most``; a base holds for ``span`` conversations at most.
    """
    own = conversations.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"))
    bases = conversations.where(F.col("conv_id") % span == 0).select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, most - 1).alias("base_ids"), F.slice("words", 1, most - 1).alias("base_words"))
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % span).join(bases, "base", "left")

    def joined(name: str, kind: str):
        head = F.coalesce(F.expr(f"slice(base_{name}, 1, h)"), F.array().cast(f"array<{kind}>"))
        return F.concat(head, F.expr(f"slice({name}, h + 1, size({name}))")).alias(name)

    return both.select("conv_id", joined("ids", "string"), joined("words", "bigint"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (seq, conv_id) in order to rows (seq, first, ids joined by commas)."""
    seq, ids, out = None, [], []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(list(columns[0]), pa.binary()), pa.array(list(columns[1]), pa.int64()),
                                           pa.array(list(columns[2]), pa.string())], ["key", "first", "ids"])

    for rows in batches:
        for s, c in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            if ids and (s != seq or len(ids) == PIECE):
                out.append((seq, ids[0], ",".join(map(str, ids))))
                ids = []
            seq = s
            ids.append(c)
        if len(out) >= 256:
            yield batch()
            out.clear()
    if ids:
        out.append((seq, ids[0], ",".join(map(str, ids))))
    if out:
        yield batch()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (key, first) to one digest per key."""
    key, state, out = None, None, []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(list(columns[0]), pa.binary()), pa.array(list(columns[1]), pa.string())],
                                          ["key", "ends"])

    for rows in batches:
        for i in range(len(rows)):
            k, text = rows.column(0)[i].as_py(), rows.column(2)[i].as_py().encode()
            if k != key:
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(text)
            else:
                state.update(b"," + text)
        if len(out) >= 4096:
            yield batch()
            out.clear()
    if state is not None:
        out.append((key, state.hexdigest()))
    if out:
        yield batch()


def turn_matrix(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, rows: np.ndarray, strip: int) -> np.ndarray:
    """The strip's columns of ``rows`` as a matrix of turn numbers, padded by -1."""
    column = np.arange(strip * STRIP, (strip + 1) * STRIP)
    inside = column[None, :] < lengths[rows, None]
    at = np.minimum(starts[rows, None] + column[None, :], max(len(flat) - 1, 0))
    return np.where(inside, flat[at] if len(flat) else -1, -1)


def ordered_rows(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): rows in lexicographic order and the turns each shares with the row before.

    Row 0 of the order shares 0. Padding sorts first, so a sequence precedes its extensions.
    """
    n = len(lengths)
    order, group, shared = np.argsort(lengths > 0, kind="stable"), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for strip in range(-(-int(lengths.max(initial=0)) // STRIP)):
        active = np.flatnonzero(lengths[order] > strip * STRIP)      # places in the order
        ids = turn_matrix(flat, starts, lengths, order[active], strip)
        longer = lengths[order[active]] > (strip + 1) * STRIP
        by = np.lexsort((longer, *ids.T[::-1], group[active]))       # rows of one group stay on its places
        order[active], ids = order[active][by], ids[by]
        mine = group[active]
        change = np.ones((len(active), STRIP), bool)
        change[1:] = ids[1:] != ids[:-1]
        together = np.zeros(len(active), bool)
        together[1:] = (mine[1:] == mine[:-1]) & (active[1:] == active[:-1] + 1)
        change[~together, 0] = True
        started = np.logical_or.accumulate(change, axis=1)           # a node starts at this depth
        length = np.minimum(lengths[order[active]] - strip * STRIP, STRIP)
        fresh = np.minimum((~started).sum(1), length)
        before = np.concatenate([[0], length[:-1]])
        fresh = np.where(together, np.minimum(fresh, before), 0)
        shared[active[together]] += fresh[together]
        # still equal after this strip: the group goes on; others get a group of their own
        parted = ~(together & (fresh == STRIP))
        group = np.full(n, -1, np.int64)
        group[active] = np.cumsum(parted)
    return order, shared


_NODES = ("key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
          "n_children bigint, n_leaves bigint, saved_tokens bigint, ends string")


def _path_keys(sequence: bytes, depth: int) -> list[bytes]:
    """Keys of the nodes of depth 0 to ``depth`` on the path of a sequence."""
    state, keys = hashlib.sha256(), []
    for d in range(depth + 1):
        keys.append(state.digest())
        state.update(sequence[d * _ID: (d + 1) * _ID])
    return keys


def shard_nodes(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Nodes of one shard: columns seq, words, n, least, ends, before, after (shared turns; -1: no neighbour)."""
    n = len(pdf)
    lengths = np.array([len(s) // _ID for s in pdf["seq"]], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    halves = np.frombuffer(b"".join(pdf["seq"]), ">u8").reshape(-1, 2).astype(np.uint64)
    sort = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(sort), bool)
    new[1:] = (halves[sort][1:] != halves[sort][:-1]).any(1)
    flat = np.empty(len(sort), np.int64)
    flat[sort] = np.cumsum(new) - 1                                   # dense numbers in the order of the digests
    order, shared = ordered_rows(flat, starts, lengths)
    length, begin = lengths[order], starts[order]
    before, after = int(pdf["before"].iloc[0]), int(pdf["after"].iloc[0])
    shared[0] = max(before, 0)
    follows = np.concatenate([shared[1:], [after]])                   # turns shared with the next row
    leaf = follows < length
    leaf[-1] = after < length[-1]
    count, least = pdf["n"].to_numpy()[order], pdf["least"].to_numpy()[order]
    ends = pdf["ends"].to_numpy()[order]
    words = np.concatenate([[0], np.cumsum(np.concatenate([*pdf["words"], np.zeros(0, np.int64)]).astype(np.int64))])
    base = words[begin]
    full, lent = words[begin + length] - base, words[begin + shared] - base
    open_first = _path_keys(pdf["seq"].iloc[order[0]], before) if before >= 0 else []
    open_last = _path_keys(pdf["seq"].iloc[order[-1]], after) if after >= 0 else []
    parents = np.zeros(n, np.int64)                                   # smallest member of the row's node one level up
    held, rows = [], 0

    def table() -> pd.DataFrame:
        out = {c: [v for part in held for v in part[c]] if c in ("key", "parent_key") else
               np.concatenate([part[c] for part in held]) for c in held[0]}
        out["parent_conv_id"] = pd.array(out["parent_conv_id"], "Int64")
        out["parent_conv_id"][out["depth"] == 0] = pd.NA
        return pd.DataFrame(out)

    at = np.arange(n)
    for d in range(int(length.max(initial=0)) + 1):
        at = at[length[at] >= d]
        start = shared[at] < d
        start[0] = True
        first = np.flatnonzero(start)
        above = words[begin[at] + max(d - 1, 0)] - base[at] if d else np.zeros(len(at), np.int64)
        kept = np.where(shared[at] >= max(d, 1), lent[at] - above, 0) + (count[at] - 1) * (full[at] - above)
        sums = lambda x: np.add.reduceat(x.astype(np.int64), first)
        smallest = np.minimum.reduceat(least[at], first)
        deeper = (length[at] > d) & (shared[at] <= d)
        here = length[at[first]] == d                                 # a sequence ends at the node: its first row
        key, parent_key = ([None] * len(first) for _ in range(2))
        if d <= before and at[0] == 0:
            key[0] = open_first[d]
        if d <= after and at[-1] == n - 1:
            key[-1] = open_last[d]
        parent = parents[at[first]]
        if d:
            if d - 1 <= before:
                for i in np.flatnonzero(_inside(at[first], shared, d - 1, True)):
                    parent_key[i] = open_first[d - 1]
            if d - 1 <= after:
                for i in np.flatnonzero(_inside(at[first], shared, d - 1, False)):
                    parent_key[i] = open_last[d - 1]
        node = np.cumsum(start) - 1
        held.append({
            "key": key, "parent_key": parent_key, "conv_id": smallest, "depth": np.full(len(first), d, np.int64),
            "parent_conv_id": parent, "n_convs": sums(count[at]), "n_children": sums(deeper), "n_leaves": sums(leaf[at]),
            "saved_tokens": sums(kept), "ends": np.where(here, ends[at[first]], None)})
        rows += len(first)
        parents[at] = smallest[node]
        if rows >= 20_000:
            yield table()
            held.clear()
            rows = 0
    if held:
        yield table()


def _inside(places: np.ndarray, shared: np.ndarray, depth: int, first: bool) -> np.ndarray:
    """Which of ``places`` lie in the node of ``depth`` that holds the shard's first (last) row."""
    if first:
        cut = np.flatnonzero(shared[1:] < depth)
        return places <= (cut[0] if len(cut) else len(shared) - 1)
    cut = np.flatnonzero(shared < depth)
    cut = cut[cut > 0]
    return places >= (cut[-1] if len(cut) else 0)


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by shard; one shard is held at a time."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        for _, part in pdf.groupby("shard", sort=True):
            if held and held[0]["shard"].iloc[0] != part["shard"].iloc[0]:
                yield from shard_nodes(pd.concat(held, ignore_index=True))
                held = []
            held.append(part)
    if held:
        yield from shard_nodes(pd.concat(held, ignore_index=True))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, ids, words)."""
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = materialise(conversations.select(
        F.unhex(F.array_join("ids", "")).alias("seq"), "words", "conv_id"), "rebuilt")
    hashed = F.unhex(F.sha2("seq", 256))
    ends = (members.select(hashed.alias("key"), "conv_id").repartitionByRange(parts, "key", "conv_id")
            .sortWithinPartitions("key", "conv_id").mapInArrow(_pieces, "key binary, first bigint, ids string")
            .repartition(parts, "key").sortWithinPartitions("key", "first").mapInArrow(_digest, "key binary, ends string"))
    kinds = members.groupBy("seq", "words").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    shards = materialise(
        kinds.withColumn("key", hashed).join(ends, "key").drop("key")
        .repartitionByRange(parts, "seq").withColumn("shard", F.spark_partition_id()), "trie-shards")
    # one row per shard: how many turns it shares with the shards beside it
    edge = shards.groupBy("shard").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    line = Window.orderBy("shard")
    turn = lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) / _ID, F.lit(1)).cast("int")),
                                 lambda i: F.substring(c, (i - 1) * _ID + 1, F.lit(_ID)))
    apart = F.array_position(F.zip_with(turn(F.col("up")), turn(F.col("lo")), lambda a, b: ~a.eqNullSafe(b)), True)
    common = F.when(F.length("up") == 0, 0).when(apart > 0, apart - 1).otherwise(F.length("up") / _ID)
    edge = edge.withColumn("up", F.lag("hi").over(line))
    edge = edge.withColumn("before", F.when(F.col("up").isNull(), -1).otherwise(common).cast("int"))
    edge = edge.select("shard", "before", F.coalesce(F.lead("before").over(line), F.lit(-1)).alias("after"))
    nodes = materialise(
        shards.join(edge, "shard").repartition(parts, "shard").sortWithinPartitions("shard")
        .mapInPandas(_shards, _NODES), "trie-nodes")
    shared = materialise(
        nodes.where(F.col("key").isNotNull()).groupBy("key").agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
            F.max("ends").alias("ends")), "shared-nodes")
    final = ["parent_key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    every = nodes.where(F.col("key").isNull()).select(*final).unionByName(
        shared.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*final))
    above = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    settled = every.where(F.col("parent_key").isNull()).withColumn("above", F.lit(None).cast("long"))
    linked = every.where(F.col("parent_key").isNotNull()).join(above, "parent_key")
    return settled.unionByName(linked).select(
        "conv_id", "depth", F.coalesce("above", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, rebuilt on the heads of every twentieth."""
    return prefix_trie(rebuild(conversations_of(read_table(spark, sf_dir, "conversations"))))


#: DuckDB SQL of the same rows. CRC-32 goes bit by bit over the digits of conv_id.
OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, list({'id': id, 'words': words} ORDER BY turn NULLS FIRST, id) AS t,
    xor(CAST(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
        lambda ch: CAST(ascii(ch) AS BIGINT))),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], list_transform(range(8), lambda k: CAST(k AS BIGINT))),
        lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END))) AS BIGINT),
      CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.t[1:c.h], []), c.t[c.h + 1:]) AS t
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20),
members AS (
  SELECT conv_id, len(t) AS n, unnest(range(0, len(t) + 1)) AS depth, t FROM rebuilt),
prefixes AS (
  SELECT conv_id, n, depth, list_transform(t[1:depth], lambda x: x.id) AS path,
    list_transform(t[1:depth - 1], lambda x: x.id) AS above, CASE WHEN depth > 0 THEN t[depth].words ELSE 0 END AS words
  FROM members),
nodes AS (
  SELECT path, any_value(CASE WHEN depth > 0 THEN above END) AS above, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(words) AS saved,
    sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY path, depth),
children AS (SELECT above AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
full_nodes AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.path = n.path),
spread AS (
  SELECT path[1:d] AS path, saved, n_children FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_nodes)),
subtrees AS (
  SELECT path, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM spread GROUP BY path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  CAST(n.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN subtrees s ON s.path = n.path LEFT JOIN full_nodes p ON n.depth > 0 AND p.path = n.above
"""
