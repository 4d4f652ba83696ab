"""Parallel TTL replay for segments too large for one sequential pass.

Inside a segment the misses that set an expiry ("anchors") form a chain:
the first valid request, then repeatedly the first valid request at least one
TTL later. ``succ(v)`` is that step for every valid request ``v``. The chain is
marked by pointer doubling over ``succ`` (``log2(chain length)`` join rounds,
each written to shared scratch, which cuts lineage), and every request is then labelled from
the anchors of its own and the previous TTL block: it is a hit iff some anchor
before it expires after it. No step needs a whole key in one task:

* ``succ`` is an as-of lookup done by a window per (key, TTL block), plus a
  window over one summary row per (key, block) for lookups that fall past the
  block;
* doubling, marking and labelling are equi-joins on request ids or (key, block).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.session import scratch_table


def _block(c, ttl: float):
    return F.floor(c / F.lit(ttl)).cast("long")


def successors(valid: DataFrame, ttl: float) -> DataFrame:
    """(id, nxt): for each valid request the first valid request of the same key with
    t >= t(id) + ttl in (t, seq, id) order; null when there is none.
    ``valid`` has key, seq, t, blk and a unique id."""
    none = F.lit(None).cast("long")
    q = valid.select("key", (F.col("t") + F.lit(ttl)).alias("time"), F.lit(0).alias("kind"),
                     F.col("id").alias("src"), none.alias("eseq"), none.alias("eid"))
    q = q.withColumn("blk", _block(F.col("time"), ttl))
    e = valid.select("key", F.col("t").alias("time"), F.lit(1).alias("kind"), none.alias("src"),
                     F.col("seq").alias("eseq"), F.col("id").alias("eid"), "blk")
    # descending scan: at equal time requests come before the lookup (t >= q counts),
    # and among equal times the smallest (seq, id) is seen last
    w = (Window.partitionBy("key", "blk")
         .orderBy(F.desc("time"), F.desc("kind"), F.desc("eseq"), F.desc("eid"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inblock = (q.unionByName(e).withColumn("hit", F.last("eid", ignorenulls=True).over(w))
               .where(F.col("kind") == 0).select("key", "blk", "src", "hit"))

    # past the lookup's block: the first valid request of the next non-empty block
    firsts = valid.groupBy("key", "blk").agg(
        F.min_by("id", F.struct("t", "seq", "id")).alias("first_id"))
    wanted = inblock.where(F.col("hit").isNull()).select("key", "blk").distinct()
    lookup = (firsts.select("key", "blk", "first_id", F.lit(1).alias("kind"))
              .unionByName(wanted.select("key", "blk", none.alias("first_id"), F.lit(0).alias("kind"))))
    wb = (Window.partitionBy("key").orderBy(F.desc("blk"), F.asc("kind"))
          .rowsBetween(Window.unboundedPreceding, -1))
    after = (lookup.withColumn("after", F.last("first_id", ignorenulls=True).over(wb))
             .where(F.col("kind") == 0).select("key", "blk", "after"))
    return (inblock.join(after, ["key", "blk"], "left")
            .select(F.col("src").alias("id"), F.coalesce("hit", "after").alias("nxt")))


def replay_by_doubling(ev: DataFrame, ttl: float) -> DataFrame:
    """(id, cached) for every row of ``ev`` (key, segment, seq, t, valid, unique id).
    Each round is written to the shared scratch folder."""
    ttl = float(ttl)
    rows = ev.withColumn("blk", _block(F.col("t"), ttl))
    valid = rows.where(F.col("valid")).select("key", "segment", "seq", "t", "blk", "id")

    # rounds: the chain visits about one block per TTL; bound it by the longest key span
    blocks = valid.groupBy("key").agg(F.countDistinct("blk").alias("nb")).agg(F.max("nb")).first()[0]
    if not blocks:
        return rows.select("id", F.lit(False).alias("cached"))
    rounds = max(1, math.ceil(math.log2(2 * blocks + 2)))

    jumps = [scratch_table(successors(valid, ttl), "ttl-jumps")]
    for _ in range(rounds - 1):
        j = jumps[-1]
        a, b = j.alias("a"), j.alias("b")
        nxt = (a.join(b, F.col("a.nxt") == F.col("b.id"), "left")
               .select(F.col("a.id").alias("id"), F.col("b.nxt").alias("nxt")))
        jumps.append(scratch_table(nxt, "ttl-jumps"))

    # anchors: every segment starts with a certain miss; follow succ from there
    marked = valid.groupBy("key", "segment").agg(
        F.min_by("id", F.struct("t", "seq", "id")).alias("id")).select("id")
    marked = scratch_table(marked, "ttl-marked")
    for j in reversed(jumps):
        step = marked.join(j, "id").select(F.col("nxt").alias("id")).where(F.col("id").isNotNull())
        marked = scratch_table(marked.unionByName(step).distinct(), "ttl-marked")

    anchors = (valid.join(marked, "id")
               .select("key", F.col("blk").alias("ablk"), F.col("t").alias("at"),
                       F.col("seq").alias("aseq"), F.col("id").alias("aid")))
    probe = rows.select("key", "seq", "t", "id",
                        F.explode(F.array(F.col("blk"), F.col("blk") - 1)).alias("ablk"))
    before = F.struct(F.col("at"), F.col("aseq"), F.col("aid")) < F.struct(F.col("t"), F.col("seq"), F.col("id"))
    hits = (probe.join(anchors, ["key", "ablk"])
            .where(before & (F.col("t") < F.col("at") + F.lit(ttl)))
            .select("id").distinct().withColumn("cached", F.lit(True)))
    return (rows.select("id").join(hits, "id", "left")
            .select("id", F.coalesce(F.col("cached"), F.lit(False)).alias("cached")))
