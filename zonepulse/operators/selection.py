"""Exact order statistics per group without sorting a whole group in one task.

``select_ranks`` returns, for every group, the values at given 1-based ranks (ranks are
expressions of the group size ``n``). It reads its input twice:

1. one aggregate gives ``n``, ``min``, ``max`` and a KLL sketch per group. The sketch's
   quantiles at a fixed grid bracket every wanted rank, some cells wide to either side;
2. one aggregate counts, per (group, rank), the rows below the bracket and the copies of
   each value inside it. Both combine before the shuffle.

The counts below are exact, so they tell whether the bracket holds the wanted rank. If a
sketch was wrong by more than its slack, that rank is counted once more on the side where
it must lie. ``rank_counted`` then finds the value among the counted ones by block-wise
prefix sums: no window holds more than one range partition of distinct values.

Nulls and NaN are ignored; infinite values have ranks like others; null groups are groups.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonepulse.session import scratch_table

RankFn = Callable[[Column], Column]

_V, _NAME, _K, _CNT, _BLOCK = "_v", "_rank_name", "_k", "_cnt", "_block"


def _idiv(a: Column, b: int) -> Column:
    """Exact integer division of a non-negative long."""
    return ((a - a % b) / b).cast("long")


def nearest_rank_low(p: int) -> RankFn:
    """Rank of the nearest-rank-low percentile: sorted[max(0, floor(n*p/100) - 1)]."""
    return lambda n: F.greatest(F.lit(1).cast("long"), _idiv(n * p, 100))


def median_ranks() -> dict[str, RankFn]:
    """Lower and upper middle ranks; the median is their mean."""
    return {"_mid_lo": lambda n: _idiv(n + 1, 2), "_mid_hi": lambda n: _idiv(n, 2) + 1}


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null; the key columns are the left ones."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(other, cond, how).drop(*[f"_r_{k}" for k in keys])


def _count_brackets(data: DataFrame, tgt: DataFrame, by: list[str]) -> DataFrame:
    """(by, name, _v, _cnt): copies of each value inside a target's bracket; null _v counts
    the rows below it. ``tgt`` has a row per (group, rank): _k, _lo, _hi."""
    listed = tgt.groupBy(*by).agg(F.collect_list(F.struct(_NAME, "_lo", "_hi")).alias("_t"))
    if by:
        rows = _match(data, listed, by)
    else:
        rows = data.withColumn("_t", listed.select("_t").scalar())
    near = rows.select(*by, _V, F.explode(F.filter("_t", lambda t: F.col(_V) <= t["_hi"])).alias("_t"))
    inside = F.when(F.col(_V) >= F.col("_t._lo"), F.col(_V))
    return (near.select(*by, F.col(f"_t.{_NAME}").alias(_NAME), inside.alias(_V))
            .groupBy(*by, _NAME, _V).agg(F.count(F.lit(1)).alias(_CNT)))


def rank_counted(counted: DataFrame, want: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, _value): per group the value at 1-based rank ``_k`` of ``want`` (by, _k), among
    distinct values ``_v`` that each stand for ``_cnt`` rows.

    The distinct values are range-partitioned, so a group of any size is cut into blocks of
    bounded size; a window over one sum per block finds the block that holds the rank, and
    a window inside that block the value.
    """
    by = list(by)
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = scratch_table(
        counted.select(*by, _V, _CNT).repartitionByRange(parts, *by, _V).withColumn(_BLOCK, F.spark_partition_id()),
        "rank-blocks")
    upto = (Window.unboundedPreceding, Window.currentRow)
    sums = blocks.groupBy(*by, _BLOCK).agg(F.sum(_CNT).alias("_n"))
    sums = sums.withColumn("_cum", F.sum("_n").over(Window.partitionBy(*by, F.lit(0)).orderBy(_BLOCK).rowsBetween(*upto)))
    keyed = _match(sums, want.select(*by, _K), by) if by else sums.withColumn(_K, want.select(_K).scalar())
    hit = (keyed.where((F.col("_cum") - F.col("_n") < F.col(_K)) & (F.col(_K) <= F.col("_cum")))
           .select(*by, _BLOCK, (F.col(_K) - F.col("_cum") + F.col("_n")).alias(_K)))
    inside = _match(blocks, hit, [*by, _BLOCK])
    run = F.sum(_CNT).over(Window.partitionBy(*by, _BLOCK).orderBy(_V).rowsBetween(*upto))
    return (inside.withColumn("_cum", run).where(F.col("_cum") >= F.col(_K))
            .groupBy(*by).agg(F.min(_V).alias("_value")))


def select_ranks(df: DataFrame, value: str, ranks: dict[str, RankFn], by: Sequence[str] = (),
                 sketch: int = 2048, grid: int = 256, slack: int = 2) -> DataFrame:
    """One row per group: ``by`` columns, ``n`` and one column per entry of ``ranks`` (null
    where the rank is not in 1..n).

    ``sketch`` is the size parameter of the KLL sketch (rank error about 2.3 / sketch^0.9),
    ``grid`` the number of cells its quantiles are read at, ``slack`` the cells added on
    both sides of a rank. They set how much of a group the second pass counts, never the result.
    """
    by, names = list(by), list(ranks)
    v = F.col(value).cast("double")
    data = df.select(*by, v.alias(_V)).where(F.col(_V).isNotNull() & ~F.isnan(_V))
    cells = F.array(*[F.lit(i / grid) for i in range(grid + 1)])
    # one row per group, used by the brackets and the result
    stats = scratch_table(
        data.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(_V).alias("_min"), F.max(_V).alias("_max"),
                              F.kll_sketch_agg_double(_V, F.lit(sketch)).alias("_kll"))
        .select(*by, "n", "_min", "_max",
                F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_kll", cells)).alias("_q")), "rank-groups")
    tgt = stats.select(*by, "n", "_min", "_max", "_q", F.explode(F.array(*[
        F.struct(F.lit(name).alias(_NAME), ranks[name](F.col("n")).cast("long").alias(_K))
        for name in names])).alias("_r")).select(*by, "_r.*", "n", "_min", "_max", "_q")
    cell = F.floor(F.col(_K) / F.col("n") * grid).cast("int")
    low, high = cell - slack, cell + (1 + slack)
    tgt = tgt.where((F.col(_K) >= 1) & (F.col(_K) <= F.col("n"))).select(
        *by, _NAME, _K, "_min", "_max",
        F.when(low > 0, F.get("_q", low)).otherwise(F.col("_min")).alias("_lo"),
        F.when(high < grid, F.get("_q", high)).otherwise(F.col("_max")).alias("_hi"))
    tgt = scratch_table(tgt, "rank-brackets")
    seen = scratch_table(_count_brackets(data, tgt, by), "rank-counts")

    keys = [*by, _NAME]
    sums = seen.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col(_V).isNull(), F.col(_CNT))), F.lit(0)).alias("_below"),
        F.coalesce(F.sum(F.when(F.col(_V).isNotNull(), F.col(_CNT))), F.lit(0)).alias("_in"))
    placed = _match(tgt, sums, keys).withColumn("_at", F.col(_K) - F.col("_below"))
    want = placed.where((F.col("_at") >= 1) & (F.col("_at") <= F.col("_in"))).select(*keys, F.col("_at").alias(_K))
    picked = rank_counted(seen.where(F.col(_V).isNotNull()), want, keys)
    missed = placed.where((F.col("_at") < 1) | (F.col("_at") > F.col("_in"))).select(
        *keys, _K, F.when(F.col("_at") < 1, F.col("_min")).otherwise(F.col("_hi")).alias("_lo"),
        F.when(F.col("_at") < 1, F.col("_lo")).otherwise(F.col("_max")).alias("_hi"))
    if not missed.isEmpty():
        side = scratch_table(_count_brackets(data, missed, by), "rank-counts")
        below = side.where(F.col(_V).isNull()).select(*keys, F.col(_CNT).alias("_below"))
        again = _match(missed, below, keys, "left").select(
            *keys, (F.col(_K) - F.coalesce("_below", F.lit(0))).alias(_K))
        picked = picked.unionByName(rank_counted(side.where(F.col(_V).isNotNull()), again, keys))

    out = stats.select(*by, "n")
    if by:
        return _match(out, picked.groupBy(*by).pivot(_NAME, names).agg(F.first("_value")), by, "left")
    row = picked.agg(F.struct(*[F.max(F.when(F.col(_NAME) == c, F.col("_value"))).alias(c) for c in names])).scalar()
    return out.select("n", *[row[c].alias(c) for c in names])
