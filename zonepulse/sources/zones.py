"""Zone dimension: five named bounding boxes in priority order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Priority, zone id, name, lat_min, lat_max, lon_min, lon_max, and the
# latitude used for the zone's area (33.43 for Z1 is a given value, not the box
# midpoint). Listed in priority order.
ZONE_ROWS = [
    (1, "Z1", "Providencia", -33.445, -33.420, -70.640, -70.600, 33.43),
    (2, "Z2", "Las Condes", -33.420, -33.390, -70.600, -70.550, 33.405),
    (3, "Z3", "Maipu", -33.530, -33.490, -70.790, -70.740, 33.51),
    (4, "Z4", "Santiago Centro", -33.460, -33.430, -70.670, -70.630, 33.445),
    (5, "Z5", "Pudahuel", -33.470, -33.430, -70.810, -70.760, 33.45),
]

ZONE_SCHEMA = T.StructType([
    T.StructField("priority", T.IntegerType(), False),
    T.StructField("zone_id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("lat_min", T.DoubleType(), False),
    T.StructField("lat_max", T.DoubleType(), False),
    T.StructField("lon_min", T.DoubleType(), False),
    T.StructField("lon_max", T.DoubleType(), False),
    T.StructField("ref_lat", T.DoubleType(), False),
])


def zones(spark: SparkSession) -> DataFrame:
    """The zone table (5 rows; safe to broadcast by construction)."""
    return spark.createDataFrame(ZONE_ROWS, ZONE_SCHEMA)


def global_bbox() -> tuple[float, float, float, float]:
    """(lat_min, lat_max, lon_min, lon_max) over all zones, as literals for pushdown."""
    return (min(r[3] for r in ZONE_ROWS), max(r[4] for r in ZONE_ROWS),
            min(r[5] for r in ZONE_ROWS), max(r[6] for r in ZONE_ROWS))
