"""Column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``; nothing
leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WKT point pattern of the tile files (longitude first, then latitude).
POINT_PATTERN = r"POINT \(([^ ]+) ([^ )]+)\)"

# Fixed value: kilometres per degree used for zone areas.
KM_PER_DEGREE = 111.0


# Epoch seconds of the years 1 to 9999; anything else is no event time.
MIN_EPOCH, MAX_EPOCH = -62_135_596_800.0, 253_402_300_799.0


def event_time_from_epoch(epoch_seconds: Column) -> Column:
    """Epoch seconds (double) -> TIMESTAMP truncated toward zero to whole seconds.

    Null for values outside the years 1 to 9999, NaN included: one bad message must not
    fail the job, and rows without an event time are dropped by ``drop_invalid``.
    """
    inside = epoch_seconds.between(F.lit(MIN_EPOCH), F.lit(MAX_EPOCH)) & ~F.isnan(epoch_seconds)
    return F.when(inside, F.timestamp_seconds(epoch_seconds.try_cast("bigint")))


def float_text(c: Column) -> Column:
    """A double as the shortest decimal text, plain between 1e-4 and 1e16, else ``1e-05`` style.

    The engine's own text switches to an exponent at 1e-3 and 1e7 and writes it as
    ``1.0E-5``; digits and exponent are taken from it and laid out anew.
    """
    s = c.cast("double").cast("string")

    def parts(text: Column) -> Column:
        part = lambda i: F.regexp_extract(text, r"^(-?)(\d)\.(\d+)E(-?\d+)$", i)
        return F.struct(part(1).alias("sign"), F.concat(part(2), F.when(part(3) == "0", F.lit("")).otherwise(part(3))).alias("d"),
                        part(4).try_cast("int").alias("e"))

    def laid_out(p: Column) -> Column:
        sign, d, e, n = p["sign"], p["d"], p["e"], F.length(p["d"])
        tail = F.substring(d, F.lit(2), n)
        wide = F.concat(sign, F.left(d, F.lit(1)), F.when(n > 1, F.concat(F.lit("."), tail)).otherwise(F.lit("")), F.lit("e"),
                        F.when(e < 0, F.lit("-")).otherwise(F.lit("+")), F.when(F.abs(e) < 10, F.lit("0")).otherwise(F.lit("")),
                        F.abs(e).cast("string"))
        return (F.when((e < 0) & (e >= -4), F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -e - 1), d))
                .when((e >= 0) & (e < 16) & (n <= e + 1), F.concat(sign, F.rpad(d, e + 1, "0"), F.lit(".0")))
                .when((e >= 0) & (e < 16), F.concat(sign, F.substring(d, F.lit(1), e + 1), F.lit("."), F.substring(d, e + 2, n)))
                .otherwise(wide))

    # arrays of one bind what is used several times, so it is computed (and compiled) once
    laid = F.transform(F.transform(F.array(s), parts), laid_out)[0]
    return (F.when(F.isnan(c), F.lit("nan")).when(s == "Infinity", F.lit("inf")).when(s == "-Infinity", F.lit("-inf"))
            .when(s.contains("E"), laid).otherwise(s))


def _text(c: Column) -> Column:
    """Python's str() of an optional value: null renders as 'None'."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def cache_key(query_type: Column, zone_id: Column, zone_id_b: Column,
              confidence_min: Column, bins: Column) -> Column:
    """Canonical cache key of a request; unknown query types hash all parameters."""
    z, zb, b = _text(zone_id), _text(zone_id_b), _text(bins)
    c = F.coalesce(float_text(confidence_min), F.lit("None"))
    conf = F.concat(F.lit(":conf="), c)
    return (F.when(query_type == "Q1", F.concat(F.lit("count:"), z, conf))
            .when(query_type == "Q2", F.concat(F.lit("area:"), z, conf))
            .when(query_type == "Q3", F.concat(F.lit("density:"), z, conf))
            .when(query_type == "Q4", F.concat(F.lit("compare:density:"), z, F.lit(":"), zb, conf))
            .when(query_type == "Q5", F.concat(F.lit("confidence_dist:"), z, F.lit(":bins="), b))
            .otherwise(F.md5(F.concat_ws(":", _text(query_type), z, zb, c, b))))


def hist_bin(x: Column, lo: Column, width: Column, bins: Column) -> Column:
    """Equal-width bin index with the edge rule of a numpy histogram.

    ``i = floor((x - lo) / width * bins)`` capped at the last bin, then corrected by one
    in either direction when floating error puts ``x`` across the edge ``lo + i*step``
    (``step = width / bins``). The last bin is closed on the right. ``x`` outside
    ``[lo, lo + width]`` must be filtered by the caller.
    """
    b = bins.cast("double")
    step = width / b
    i0 = F.least(F.floor((x - lo) / width * b), bins.cast("long") - 1)
    return (F.when(x < lo + i0 * step, i0 - 1)
            .when((i0 != bins.cast("long") - 1) & (x >= lo + (i0 + 1) * step), i0 + 1)
            .otherwise(i0))


def point_coordinate(geometry: Column, group: int) -> Column:
    """Coordinate ``group`` (1 = longitude, 2 = latitude) of a WKT point; null if no match."""
    text = F.regexp_extract(geometry, POINT_PATTERN, group)
    return F.nullif(text, F.lit("")).try_cast("double")


def zone_area_km2(lat_min: Column, lat_max: Column, lon_min: Column, lon_max: Column,
                  ref_lat: Column) -> Column:
    """Box area in km^2: dLat * dLon * 111^2 * cos(ref_lat)."""
    return ((F.abs(lat_max - lat_min)) * (F.abs(lon_max - lon_min))
            * F.lit(KM_PER_DEGREE) * F.lit(KM_PER_DEGREE) * F.cos(F.radians(ref_lat)))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """Rounded percentage, 0 when the denominator is 0 (never divides by zero)."""
    return F.when(den > 0, F.round(num.cast("double") / den.cast("double") * 100.0, digits)) \
        .otherwise(F.lit(0.0))


def hilbert_key(x: Column, y: Column, bits: int) -> Column:
    """Position on the Hilbert curve of the cell (x, y), both in [0, 2^bits), ``bits`` <= 31.

    One quadrant a step, from the coarsest: its number is appended to the key, and the
    quarter is turned so that the curve enters and leaves it where its neighbours expect.
    """
    top = F.lit(2 ** bits - 1).cast("long")

    def step(acc: Column, i: Column) -> Column:
        bit = lambda c: F.call_function("shiftright", c, i).bitwiseAND(1)
        right, upper = bit(acc["x"]) == 1, bit(acc["y"]) == 1
        quadrant = F.when(right, F.when(upper, 2).otherwise(3)).otherwise(F.when(upper, 1).otherwise(0))
        turned_x = F.when(upper, acc["x"]).when(right, top - acc["y"]).otherwise(acc["y"])
        turned_y = F.when(upper, acc["y"]).when(right, top - acc["x"]).otherwise(acc["x"])
        return F.struct((acc["key"] * 4 + quadrant).cast("long").alias("key"), turned_x.alias("x"), turned_y.alias("y"))

    start = F.struct(F.lit(0).cast("long").alias("key"), x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda acc: acc["key"])
