"""The clustered copy of the buildings and what a box filter reads of it."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zonepulse.functions import hilbert_key
from zonepulse.operators.buildings import prepare_buildings
from zonepulse.sources import buildings_io as bio
from zonepulse.sources import fixtures as fx


def _cells(spark, bits):
    n = 2 ** bits
    df = spark.range(n * n).select((F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("y"))
    return {r.k: (r.x, r.y) for r in df.select("x", "y", hilbert_key(F.col("x"), F.col("y"), bits).alias("k")).collect()}


def test_hilbert_visits_every_cell_by_single_steps(spark):
    for bits in (1, 2, 5):
        cells = _cells(spark, bits)
        path = [cells[k] for k in range(4 ** bits)]
        assert len(set(path)) == 4 ** bits
        assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(path, path[1:]))


def test_hilbert_of_the_widest_index(spark):
    top = 2 ** 31 - 1
    got = spark.createDataFrame([(0, 0), (top, 0), (top, top)], "x long, y long").select(
        hilbert_key(F.col("x"), F.col("y"), 31).alias("k")).collect()
    assert [r.k for r in got] == [0, 4 ** 31 - 1, 2 * 4 ** 30 + (4 ** 30 - 1) // 3 * 2]


def _scan(df):
    """Metrics of the Parquet scan of a collected DataFrame: files selected and rows that left it."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, found = [plan], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.startswith("Scan parquet"):
            found.append(node)
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.size())]
    assert len(found) == 1
    metric = lambda n: found[0].metrics().apply(n).value()
    return metric("numFiles"), metric("numOutputRows")


def test_box_filter_skips_row_groups_and_zones(spark, tmp_dir):
    n = 200_000
    u = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1_000_000)) / F.lit(1e6)
    b = spark.range(n).select((F.lit(-34.0) + u(1)).alias("latitude"), (F.lit(-71.0) + u(2)).alias("longitude"),
                              u(3).alias("area_in_meters"), u(4).alias("confidence"),
                              F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("zone_id"))
    bio.write_clustered(b, f"{tmp_dir}/clustered", row_group_bytes=64 << 10, rows_per_file=40_000)
    box = F.col("latitude").between(-33.55, -33.5) & F.col("longitude").between(-70.55, -70.5) & (F.col("zone_id") == "hot")
    want = b.where(box).count()
    got = bio.load_buildings(spark, f"{tmp_dir}/clustered").where(box).select("latitude", "longitude", "confidence")
    assert len(got.collect()) == want > 300
    files, rows = _scan(got)
    everything = bio.load_buildings(spark, f"{tmp_dir}/clustered").select("latitude", "zone_id")
    assert len(everything.collect()) == n
    assert files < _scan(everything)[0]                    # files of the other zone are not listed
    assert want <= rows < n // 10, rows                    # most row groups of the hot zone are skipped


def test_clustered_copy_keeps_every_row(spark, tmp_dir):
    b = prepare_buildings(fx.buildings_raw(spark, SF_SMALL))
    odd = spark.createDataFrame([(None, 1.0, 2.0, 0.5, "Z1"), (float("nan"), 1.0, None, 0.5, "Z1"), (95.0, 400.0, 1.0, None, "Z2"),
                                 (-33.43, -70.62, 1.0, 0.5, None)], b.schema)
    same = spark.range(500).select(F.lit(-33.43).alias("latitude"), F.lit(-70.62).alias("longitude"), F.lit(1.0).alias("area_in_meters"),
                                   F.lit(0.5).alias("confidence"), F.lit("Z1").alias("zone_id"))
    rows = b.unionByName(odd).unionByName(same)
    bio.write_clustered(rows, tmp_dir)
    key = lambda df: sorted(map(repr, (tuple(r) for r in df.collect())))
    assert key(bio.load_buildings(spark, tmp_dir)) == key(rows)
    bio.write_clustered(rows.limit(0), f"{tmp_dir}/none")
