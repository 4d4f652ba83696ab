"""Mixing sources to target weights by pivotal dependent rounding.

Every document starts with a fractional number of copies, target / size of its source.
The whole part is taken outright. The fractions of two documents are then played against
each other: a random transfer of *words* (fraction x size) from one to the other runs
until one of the two is a whole copy or none, which keeps the expected copies of both and
their joint number of words. What is left of a block of documents is one fraction, and the
fractions of all blocks of a source are combined by a reduction tree whose tasks hold
``fan_in`` fractions each. Large documents meet first, so what stays open is small; the
last open document of a source is rounded to the nearer end. A source's words therefore
miss its target by half a document at most.

Defined results:

* null or empty text: size 0, ``taken`` 0; it gets the whole part of its copies only;
* null source: a source of its own, last in the order of sources;
* repeated rows and equal ids: every row is rounded on its own, and equal rows are
  interchangeable, so reruns return the same rows;
* empty table: empty result; a source without words has target 0;
* other columns are ignored, whatever their names.

All random choices are hashes of ``seed``, level and document, so reruns and retried
tasks agree. A source holding most rows is dealt over many blocks by that hash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonepulse.llm.common import materialise, other_columns_aside, read_table, with_positions, word_count


def source_targets(stats: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Targets of sources: ``stats`` (source, source_size, n_rows) plus ``target`` (double).

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times
    all sizes; a target above ``cap`` times its source's size stops there and the rest is
    reshared by weight. The level is found by aggregates over the sources; each round caps
    at least one more source, and the driver sees four numbers a round.
    """
    ranked = with_positions(stats, F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.col("_pos") % len(weights) + 1).cast("int"))
    ranked = materialise(ranked.withColumn("_weight", turn).drop("_pos"), "sources")
    limit = F.col("source_size") * F.lit(float(cap))
    total, weight = ranked.agg(F.sum("source_size"), F.sum("_weight")).first()
    level, n_capped, words = (share * total / weight if weight else 0.0), -1, share * (total or 0)
    while True:
        capped = F.col("_weight") * F.lit(level) >= limit
        n, size, open_weight = ranked.agg(
            F.count(F.when(capped, 1)), F.coalesce(F.sum(F.when(capped, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), F.lit(0.0))).first()
        if n == n_capped or not open_weight:
            break
        n_capped, level = n, (words - size) / open_weight
    target = F.least(F.col("_weight") * F.lit(level), limit)
    return ranked.withColumn("target", target).drop("_weight")


def _unit(h: int) -> float:
    """A 64-bit hash as a number in [0, 1)."""
    return ((int(h) & 0xFFFFFFFFFFFFFFFF) >> 11) / 9007199254740992.0


def transfer(size_a: float, a: float, size_b: float, b: float, u: float) -> tuple[float, float]:
    """Move words between two fractions until one is whole or gone; ``u`` in [0, 1) decides.

    ``a`` of ``size_a`` words and ``b`` of ``size_b`` words are open (0 < words < size).
    The sum stays, and over ``u`` so does the expected value of each.
    """
    up, down = min(size_a - a, b), min(a, size_b - b)
    if u * (up + down) < down:
        return (size_a if up == size_a - a else a + up), (0.0 if up == b else b - up)
    return (0.0 if down == a else a - down), (size_b if down == size_b - b else b + down)


def _round_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pivotal rounding of rows sorted by (_source_no, _block); one open row is carried.

    ``_open`` holds the fraction in words on input; on output it is null once decided.
    """
    group, held = None, None                     # held: the open row as a dict
    for pdf in batches:
        out = []
        for row in pdf.to_dict("records"):
            key = (row["_source_no"], row["_block"])
            if key != group:
                if held is not None:
                    out.append(held)
                group, held = key, None
            size, words = float(row["size"]), row["_open"]
            if not 0.0 < words < size:
                out.append(row | {"_open": None})
                continue
            if held is None:
                held = row
                continue
            mine, other = transfer(float(held["size"]), held["_open"], size, words, _unit(row["_dice"]))
            still = None
            for cand, w in ((held, mine), (row, other)):
                if 0.0 < w < float(cand["size"]):
                    still = cand | {"_open": w}
                else:
                    out.append(cand | {"_copies": cand["_copies"] + int(w > 0.0), "_open": None})
            held = still
        if out:
            yield pd.DataFrame(out, columns=pdf.columns).astype({"_open": "float64"})
    if held is not None:
        yield pd.DataFrame([held], columns=list(held)).astype({"_open": "float64"})


def plan_copies(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                block_rows: int = 1_000, fan_in: int = 256, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, source, text_key, size, source_size, target, copies.

    ``docs`` needs doc_id, text and source. ``text_key`` is a hash of the text that tells
    rows of one doc_id apart. ``copies`` is 0 up to ``ceil(cap)``.
    """
    sized = materialise(docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_key"),
        word_count(F.col("text")).alias("size")), "mix-sizes")
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    targets = source_targets(stats, weights, share, cap)
    targets = with_positions(targets, F.col("source").asc_nulls_last(), name="_source_no")
    targets = targets.withColumn("_blocks", F.ceil(F.col("_rows") / F.lit(block_rows)).cast("long"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = targets.withColumnRenamed("source", "_source").alias("t")
    rows = (
        sized.join(sources, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_rate", rate)
        .withColumn("_copies", F.floor("_rate").cast("long"))
        .withColumn("_open", (F.col("_rate") - F.col("_copies")) * F.col("size"))
        .withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "text_key"))
        .withColumn("_block", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text_key"), F.col("_blocks")))
        .withColumn("_dice", F.xxhash64(F.lit(seed + 2), "doc_id", "text_key"))
        .select("doc_id", "source", "text_key", "size", "source_size", "target", "_source_no", "_blocks",
                "_copies", "_open", "_order", "_block", "_dice"))
    decided, level = [], 0
    while True:
        rounded = materialise(
            rows.repartition("_source_no", "_block")
            .sortWithinPartitions("_source_no", "_block", F.desc("size"), "_order", "doc_id", "text_key")
            .mapInPandas(_round_sorted, rows.schema), f"mix-level{level}")
        decided.append(rounded.where(F.col("_open").isNull()))
        level += 1
        left = rounded.where(F.col("_open").isNotNull())
        most = left.agg(F.max("_blocks")).first()[0]
        if most is None or most <= 1:
            break
        rows = (left.withColumn("_block", F.floor(F.col("_block") / F.lit(fan_in)))
                .withColumn("_blocks", F.ceil(F.col("_blocks") / F.lit(fan_in)))
                .withColumn("_dice", F.xxhash64(F.lit(seed + 2 + level), "_dice")))
    # one open document per source is left: the nearer end keeps the source nearest its target
    last = left.withColumn("_copies", F.col("_copies") + (F.col("_open") * 2 >= F.col("size")).cast("long"))
    result = last
    for part in decided:
        result = result.unionByName(part)
    return result.select("doc_id", "source", "text_key", "size", "source_size", "target",
                         F.col("_copies").alias("copies"))


@other_columns_aside("doc_id", "source", "text")
def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as its copies say.

    Equal rows share their copies, so their sum is laid on one of them.
    """
    key = ["doc_id", "source", "text_key"]
    copies = (plan_copies(docs, **options).groupBy(*key)
              .agg(F.sum("copies").alias("_n"), F.count("*").alias("_same")).where("_n > 0"))
    named = docs.withColumn("text_key", F.xxhash64("text")).alias("d")
    both = named.join(copies.alias("c"), [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key])
    both = both.select("d.*", "c._n", "c._same")
    once = both.where("_same = 1").unionByName(both.where("_same > 1").dropDuplicates(key))
    return (once.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
            .select(*docs.columns))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents: weights 3, 1, 2 in turn, 150 % of all words, at most twice a source."""
    plan = plan_copies(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).alias("taken"), "copies")
