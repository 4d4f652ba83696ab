"""Building preparation and the five zone questions (Q1-Q5).

Answers are computed once per distinct parameter set, never per request row:
buildings are first reduced to counts and area sums per (zone, confidence value)
with a partial aggregate, and only that small table meets the thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonepulse.functions import hist_bin, point_coordinate, zone_area_km2
from zonepulse.session import scratch_table
from zonepulse.sources.zones import ZONE_ROWS, global_bbox

# Areas are added up as decimals, so a sum does not depend on the order of its rows.
AREA = "decimal(28,9)"

COORDS = ("latitude", "longitude", "area_in_meters", "confidence")


# ------------------------------------------------------------- P3 - P6

def parse_point(df: DataFrame) -> DataFrame:
    """longitude/latitude from a WKT ``POINT (lon lat)`` when the input has a
    geometry column but no latitude column; unmatched text gives nulls."""
    if "latitude" in df.columns or "geometry" not in df.columns:
        return df
    # The coordinates leave through a one-element generator: predicates on them then
    # read its output instead of being inlined (regex and all) into every filter term.
    point = F.struct(point_coordinate(F.col("geometry"), 1).alias("longitude"),
                     point_coordinate(F.col("geometry"), 2).alias("latitude"))
    return df.drop("longitude").select("*", F.inline(F.array(point)))


def filter_global_bbox(df: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Keep points inside the box spanning all zones (inclusive). Literal bounds (of a
    zone table passed in: four numbers from one aggregate), so the predicate reaches the
    Parquet scan. Without any zone no point is kept."""
    if zones is None:
        lat_min, lat_max, lon_min, lon_max = global_bbox()
    else:
        lat_min, lat_max, lon_min, lon_max = zones.agg(
            F.min("lat_min"), F.max("lat_max"), F.min("lon_min"), F.max("lon_max")).first()
        if lat_min is None:
            return df.where(F.lit(False))
    return df.where(F.col("latitude").between(lat_min, lat_max)
                    & F.col("longitude").between(lon_min, lon_max))


def project_complete(df: DataFrame) -> DataFrame:
    """P5: the four building columns, rows with any null or NaN dropped."""
    return df.select(*COORDS).dropna()


def filter_confidence(df: DataFrame, c: float | Column) -> DataFrame:
    """Confidence >= c (inclusive); null and NaN never pass."""
    conf = F.col("confidence")
    c = c if isinstance(c, Column) else F.lit(float(c))
    return df.where((conf >= c) & ~F.isnan(conf))


# ------------------------------------------------------------- J1, P8

def zone_of(lat: Column, lon: Column) -> Column:
    """First of the built-in zones (by priority) whose box contains the point, bounds inclusive."""
    expr = None
    for _, zid, _, a, b, c, d, _ in ZONE_ROWS:
        inside = lat.between(F.lit(a), F.lit(b)) & lon.between(F.lit(c), F.lit(d))
        expr = F.when(inside, F.lit(zid)) if expr is None else expr.when(inside, F.lit(zid))
    return expr


def assign_zone(points: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Point-in-box zone assignment, first match by zone priority, unmatched dropped.

    The built-in zones are literals: a CASE chain inside the scan stage, no shuffle, no
    broadcast. A zone table, of whatever size, goes through ``assign_zone_index``.
    """
    if zones is not None:
        return assign_zone_index(points, zones)
    z = zone_of(F.col("latitude"), F.col("longitude"))
    return points.withColumn("zone_id", z).where(F.col("zone_id").isNotNull())


#: Depth of the finest cells: 2^20 a side of a square of 360 degrees.
DEPTH = 20


def _place(c: Column) -> Column:
    """Index of a coordinate among the finest cells of its axis."""
    return F.floor((c + F.lit(180.0)) * F.lit(2.0 ** DEPTH / 360.0)).cast("long")


def _spread(x: Column) -> Column:
    """The low 21 bits of an index at every other position."""
    x = x.bitwiseAND(0x1FFFFF)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(mask)
    return x


def morton(row: Column, column: Column) -> Column:
    """Position of a cell on the Z-order curve: the bits of both indices in turn."""
    return _spread(row).bitwiseOR(F.shiftleft(_spread(column), 1))


def zone_intervals(zones: DataFrame) -> DataFrame:
    """Intervals of the Z-order curve that cover each box: depth, z and the box (at most 4 rows a zone).

    A box is laid on the cells whose side is the next power of two above its own, so it
    touches two of them an axis at most, be it a street or a country. A cell of depth d is
    the interval [z * 4^k, (z + 1) * 4^k) of the curve with k = ``DEPTH`` - d. Boxes without
    an inside (a null or crossed bound) have none.
    """
    side = F.greatest(F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min"), F.lit(360.0 / 2 ** DEPTH))
    depth = F.greatest(F.lit(0), F.least(F.lit(DEPTH), F.floor(F.log2(F.lit(360.0) / side)))).cast("int")
    boxes = zones.where((F.col("lat_min") <= F.col("lat_max")) & (F.col("lon_min") <= F.col("lon_max"))).select(
        "priority", "zone_id", "lat_min", "lat_max", "lon_min", "lon_max", depth.alias("depth"))
    up = lambda c: F.call_function("shiftright", _place(F.col(c)), F.lit(DEPTH) - F.col("depth"))
    rows = boxes.withColumn("_i", F.explode(F.sequence(up("lat_min"), up("lat_max"))))
    cells = rows.withColumn("_j", F.explode(F.sequence(up("lon_min"), up("lon_max"))))
    return cells.withColumn("z", morton(F.col("_i"), F.col("_j"))).drop("_i", "_j")


def assign_zone_index(points: DataFrame, zones: DataFrame) -> DataFrame:
    """J1 for a zone table of any size: intervals of the Z-order curve.

    Points and boxes meet where a point's position on the curve, cut to the depth of the
    interval, equals the interval: one equi-join per depth that boxes have (their sizes
    differ by a few powers of two; there are ``DEPTH`` + 1 depths at most). Each interval
    keeps its boxes as one array sorted by priority, so a point stays one row in every join
    and needs no key. The first box by priority that contains the point wins. Hot intervals
    are split by AQE's skew handling of the join.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    index = scratch_table(zone_intervals(zones).groupBy("depth", "z").agg(F.array_sort(F.collect_list(F.struct(
        "priority", "zone_id", "lat_min", "lat_max", "lon_min", "lon_max"))).alias("boxes")), "zone-intervals")
    depths = sorted(r[0] for r in index.select("depth").distinct().collect())
    found = points.withColumn("_z", morton(_place(lat), _place(lon)))
    inside = lambda c: lat.between(c["lat_min"], c["lat_max"]) & lon.between(c["lon_min"], c["lon_max"])
    hits = [F.lit(None).cast("struct<priority: int, zone_id: string>")]
    for d in depths:
        cells = index.where(F.col("depth") == d).select(F.col("z").alias(f"_z{d}"), F.col("boxes").alias(f"_boxes{d}"))
        found = found.join(cells, F.shiftright("_z", 2 * (DEPTH - d)) == F.col(f"_z{d}"), "left")
        first = F.try_element_at(F.filter(F.col(f"_boxes{d}"), inside), F.lit(1))
        hits.append(F.struct(first["priority"].cast("int").alias("priority"), first["zone_id"].alias("zone_id")))
    best = F.array_min(F.filter(F.array(*hits), lambda h: h["zone_id"].isNotNull()))
    return (found.withColumn("zone_id", best["zone_id"]).where(F.col("zone_id").isNotNull())
            .drop("_z", *[f"_z{d}" for d in depths], *[f"_boxes{d}" for d in depths]))


def with_zone_area(zones: DataFrame) -> DataFrame:
    """Zone area in km^2 from the box and the zone's reference latitude."""
    return zones.withColumn("area_km2", zone_area_km2(
        F.col("lat_min"), F.col("lat_max"), F.col("lon_min"), F.col("lon_max"), F.col("ref_lat")))


def prepare_buildings(raw: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """P3 -> P4 -> P5 -> J1: tiles to buildings with a zone."""
    return assign_zone(project_complete(filter_global_bbox(parse_point(raw), zones)), zones)


# ------------------------------------------------------------- A13

def zone_inventory(buildings: DataFrame) -> DataFrame:
    """Zones present and their building counts."""
    return buildings.groupBy("zone_id").agg(F.count(F.lit(1)).alias("buildings"))


# ------------------------------------------------------------- A1 - A3, J2

def reduce_by_confidence(buildings: DataFrame) -> DataFrame:
    """Buildings reduced to one row per (zone, confidence value): count and area sum.

    A partial + final aggregate (map-side combined, so a hot zone costs nothing extra).
    Every zone question is answered from this table, whose size is bounded by
    zones x distinct confidence values rather than by the number of buildings.
    """
    if "_n" in buildings.columns:
        return buildings
    conf = F.col("confidence")
    return (buildings.where(conf.isNotNull() & ~F.isnan(conf))
            .groupBy("zone_id", "confidence")
            .agg(F.count(F.lit(1)).alias("_n"),
                 F.sum(F.col("area_in_meters").cast(AREA)).alias("_area")))  # exact: no order of addition


#: Blocks of a unit of confidence in the suffix sums.
BLOCKS = 65_536


def _block(confidence: Column) -> Column:
    """Block of a confidence value; values outside [0, 1] go to the blocks at the ends."""
    at = F.when(F.isnan(confidence) | (confidence > 1), F.lit(float(BLOCKS))).when(
        confidence < 0, F.lit(-1.0)).otherwise(F.floor(confidence * F.lit(float(BLOCKS))))
    return at.cast("int")


def threshold_stats(buildings: DataFrame, params: DataFrame) -> DataFrame:
    """Count and area sum per (zone_id, confidence_min) in ``params``; zones of params
    without qualifying buildings get 0. ``buildings`` may be the reduced table.

    Block-wise suffix sums, no join of thresholds with values: thresholds are laid among the
    values of their zone, a window inside each (zone, block) adds up from the highest value
    down, and a window over one row per block adds what lies in higher blocks. A zone that
    holds most buildings is spread over up to ``BLOCKS`` groups; the window over blocks
    never holds more rows than that. A null threshold or zone matches nothing.
    """
    conf = F.col("confidence") + F.lit(0.0)             # one zero, so -0.0 equals 0.0
    values = reduce_by_confidence(buildings).where(F.col("zone_id").isNotNull()).select(
        "zone_id", conf.alias("at"), F.lit(False).alias("asked"), "_n", F.col("_area").cast("decimal(38,9)").alias("_area"),
        F.lit(None).cast("double").alias("confidence_min"))
    asked = params.select("zone_id", F.col("confidence_min").cast("double").alias("confidence_min")).distinct().select(
        "zone_id", (F.col("confidence_min") + F.lit(0.0)).alias("at"), F.lit(True).alias("asked"), F.lit(0).cast("long").alias("_n"),
        F.lit(None).cast("decimal(38,9)").alias("_area"), "confidence_min")
    both = values.unionByName(asked).withColumn("block", _block(F.col("at")))
    # equal values come before the threshold: the comparison is inclusive
    down = Window.partitionBy("zone_id", "block").orderBy(F.desc("at"), "asked").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.select("zone_id", "block", "asked", "confidence_min", F.sum("_n").over(down).alias("n_in"),
                         F.sum("_area").over(down).alias("area_in")).where("asked")
    higher = Window.partitionBy("zone_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    above = (both.groupBy("zone_id", "block").agg(F.sum("_n").alias("_n"), F.sum("_area").alias("_area"))
             .select("zone_id", "block", F.sum("_n").over(higher).alias("n_up"), F.sum("_area").over(higher).alias("area_up")))
    known = F.col("confidence_min").isNotNull()
    zero = F.lit(0).cast("decimal(38,9)")
    area = F.when(F.col("area_in").isNotNull() | F.col("area_up").isNotNull(),
                  F.coalesce("area_in", zero) + F.coalesce("area_up", zero))
    return (inside.join(above, ["zone_id", "block"], "left")
            .select("zone_id", "confidence_min",
                    F.when(known, F.coalesce("n_in", F.lit(0)) + F.coalesce("n_up", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("count"),
                    F.when(known, area).cast("double").alias("total_area")))


def zone_areas(spark: SparkSession, zones: DataFrame | None = None) -> DataFrame:
    from zonepulse.sources.zones import zones as zone_table
    z = zones if zones is not None else zone_table(spark)
    return with_zone_area(z).select("zone_id", "area_km2")


def zone_answers(buildings: DataFrame, params: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Q1-Q3 answers per (zone_id, confidence_min) in ``params``, from one threshold pass:
    count; avg_area, total_area, n (0 when empty); density_per_km2 = count / area (round 4)
    and area_km2 (round 4), area 1.0 for a zone without a box."""
    s = threshold_stats(buildings, params)
    areas = zone_areas(buildings.sparkSession, zones)      # broadcast by Spark where its size allows
    area = F.coalesce(F.col("area_km2"), F.lit(1.0))
    return (s.join(areas, "zone_id", "left")
            .select("zone_id", "confidence_min", "count",
                    F.when(F.col("count") > 0, F.col("total_area") / F.col("count"))
                    .otherwise(F.lit(0.0)).alias("avg_area"),
                    F.coalesce(F.col("total_area"), F.lit(0.0)).alias("total_area"),
                    F.col("count").alias("n"),
                    F.round(F.col("count") / area, 4).alias("density_per_km2"),
                    F.round(area, 4).alias("area_km2")))


def q1_count(buildings: DataFrame, params: DataFrame) -> DataFrame:
    """A1: buildings per zone with confidence >= confidence_min (0 when none)."""
    return threshold_stats(buildings, params).select("zone_id", "confidence_min", "count")


def q2_area(buildings: DataFrame, params: DataFrame) -> DataFrame:
    """A2: mean, sum and number of building areas at the threshold; empty gives 0."""
    return zone_answers(buildings, params).select("zone_id", "confidence_min", "avg_area",
                                                   "total_area", "n")


def q3_density(buildings: DataFrame, params: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """A3: count / zone area (km^2) rounded to 4; unknown zones use area 1.0."""
    return zone_answers(buildings, params, zones).select("zone_id", "confidence_min",
                                                          "density_per_km2", "area_km2")


def compare_pairs(pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """J2 from per-zone answers: densities of A and B; winner A only if strictly denser."""
    d = answers.select("zone_id", "confidence_min", "density_per_km2")
    da = d.withColumnRenamed("density_per_km2", "density_a")
    db = d.select(F.col("zone_id").alias("zone_id_b"), "confidence_min",
                  F.col("density_per_km2").alias("density_b"))
    out = pairs.join(da, ["zone_id", "confidence_min"]).join(db, ["zone_id_b", "confidence_min"])
    return out.select(
        F.col("zone_id").alias("zone_a"), F.col("zone_id_b").alias("zone_b"), "confidence_min",
        "density_a", "density_b",
        F.when(F.col("density_a") > F.col("density_b"), F.col("zone_id"))
        .otherwise(F.col("zone_id_b")).alias("winner"))


def q4_compare(buildings: DataFrame, pairs: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Densities of zone A and zone B at a threshold; winner A only if strictly denser."""
    p = pairs.select("zone_id", "zone_id_b", "confidence_min").distinct()
    params = p.select("zone_id", "confidence_min").unionByName(
        p.select(F.col("zone_id_b").alias("zone_id"), "confidence_min"))
    return compare_pairs(p, zone_answers(buildings, params, zones))


# ------------------------------------------------------------- A4

def q5_histogram(buildings: DataFrame, params: DataFrame) -> DataFrame:
    """A4: per (zone, bins) equal-width confidence histogram over [0, 1], numpy edge rule,
    last bin closed, empty bins as 0, edges rounded to 4. One row per bucket."""
    p = params.select("zone_id", F.col("bins").cast("int").alias("bins")) \
        .where(F.col("bins") >= 1).distinct()
    conf = F.col("confidence")
    reduced = reduce_by_confidence(buildings).where(conf.between(0.0, 1.0))
    binned = (reduced.join(p, "zone_id")
              .select("zone_id", "bins", "_n",
                      hist_bin(conf, F.lit(0.0), F.lit(1.0), F.col("bins")).alias("bucket"))
              .groupBy("zone_id", "bins", "bucket").agg(F.sum("_n").alias("counts")))
    grid = p.select("zone_id", "bins", F.explode(F.sequence(F.lit(0).cast("long"),
                                                            (F.col("bins") - 1).cast("long")))
                    .alias("bucket"))
    step = F.lit(1.0) / F.col("bins").cast("double")
    return (grid.join(binned, ["zone_id", "bins", "bucket"], "left")
            .select("zone_id", "bins", "bucket",
                    F.round(F.col("bucket") * step, 4).alias("min"),
                    F.round(F.when(F.col("bucket") == F.col("bins") - 1, F.lit(1.0))
                            .otherwise((F.col("bucket") + 1) * step), 4).alias("max"),
                    F.coalesce(F.col("counts"), F.lit(0)).cast("long").alias("counts")))


def q5_nested(hist: DataFrame) -> DataFrame:
    """A4 nested form: one row per (zone, bins) with the buckets as an ordered array."""
    return hist.groupBy("zone_id", "bins").agg(F.array_sort(F.collect_list(
        F.struct("bucket", "min", "max", "counts"))).alias("buckets"))
