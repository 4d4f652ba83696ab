"""Building tiles (gzip CSV) and the prepared building table (Parquet + CSV)."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.functions import hilbert_key
from zonepulse.operators.buildings import COORDS, parse_point
from zonepulse.schemas import BUILDINGS, RAW_TILE
from zonepulse.sources.files import data_files, exists, first_line


def scan_tiles(spark: SparkSession, paths: list[str] | str, partitions: int | None = None) -> DataFrame:
    """Tile CSV files (gzip by extension), each with a header row of its own.

    Files are grouped by their header line (only that line is read for it), every group is
    read with its own column order and the groups are united by name. Unknown columns are
    left out, a text that is no number is null, and tiles without coordinates take them
    from their WKT ``geometry`` (P3). Gzip is not splittable (one task per file);
    ``partitions`` spreads the rows afterwards.
    """
    groups: dict[str, list[str]] = {}
    for path in data_files(spark, paths):
        header = first_line(spark, path)
        if header:
            groups.setdefault(header.removeprefix("\ufeff"), []).append(path)
    tiles = spark.createDataFrame([], RAW_TILE)
    for header, files in groups.items():
        names = [n.strip() for n in next(csv.reader([header]))]
        raw = (spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
               .option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").csv(files))
        known = parse_point(raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                                         for f in RAW_TILE.fields if f.name in names]))
        tiles = tiles.unionByName(known, allowMissingColumns=True)
    return tiles.repartition(partitions) if partitions else tiles


def write_buildings(df: DataFrame, base: str, formats: tuple[str, ...] = ("parquet", "csv")) -> None:
    """Buildings as Parquet partitioned by zone (partition pruning per zone) and CSV."""
    out = df.select(*[f.name for f in BUILDINGS.fields])
    if "parquet" in formats:
        out.write.mode("overwrite").partitionBy("zone_id").parquet(f"{base}/parquet")
    if "csv" in formats:
        out.write.mode("overwrite").option("header", True).csv(f"{base}/csv")


#: Bits an axis of the Hilbert key: cells of 360 / 2^24 degrees, about 2 m.
CLUSTER_BITS = 24


def write_clustered(df: DataFrame, base: str, row_group_bytes: int = 16 << 20, rows_per_file: int = 0) -> None:
    """S12 with a layout for P4: Parquet by zone, rows along the Hilbert curve inside a zone.

    Rows are range-partitioned by (zone, Hilbert key, a hash of the row) and sorted inside a
    task, so every row group covers a small patch and a box filter skips the others by their
    least and greatest coordinates. A hot zone falls into many ranges, and so does a hot point
    by the hash; rows equal in every column share a task, whose sort spills. Points outside
    the globe count as on its edge; those without coordinates come first. ``rows_per_file``
    cuts files (0: one per task and zone).
    """
    side = 360.0 / 2 ** CLUSTER_BITS
    cell = lambda c: F.floor((F.greatest(F.lit(-180.0), F.least(F.col(c), F.lit(180.0 - side))) + F.lit(180.0)) / F.lit(side))
    out = df.select(*[f.name for f in BUILDINGS.fields])
    placed = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
                    hilbert_key(cell("longitude"), cell("latitude"), CLUSTER_BITS))
    keyed = out.withColumns({"_place": placed, "_spread": F.xxhash64(*COORDS)})
    order = ("zone_id", "_place", "_spread")
    (keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_place", "_spread").write.mode("overwrite")
     .option("parquet.block.size", row_group_bytes).option("maxRecordsPerFile", rows_per_file)
     .partitionBy("zone_id").parquet(f"{base}/parquet"))


def load_buildings(spark: SparkSession, base: str) -> DataFrame:
    """The Parquet copy if there is one, else the CSV copy, else an error. A copy that
    exists but cannot be read is an error too, never a reason to take the other."""
    if exists(spark, f"{base}/parquet"):
        return spark.read.parquet(f"{base}/parquet").select(*[f.name for f in BUILDINGS.fields])
    if exists(spark, f"{base}/csv"):
        return spark.read.schema(BUILDINGS).option("header", True).csv(f"{base}/csv")
    raise FileNotFoundError(f"no building table under {base}")
