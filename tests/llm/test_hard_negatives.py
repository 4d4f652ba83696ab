"""Hard negatives: exact scores, brute force over odd rows, DuckDB SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, uid int, _block string, s double"


def brute(rows, n_pos=5, n_neg=10, every=10):
    kept = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, (anchor, label, v) in enumerate(kept):
        if anchor % every:
            continue
        scored = sorted((-dot(v, w), other, lab) for j, (other, lab, w) in enumerate(kept) if j != i)
        for s, pos, _ in [x for x in scored if x[2] == label][:n_pos]:
            good = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:n_neg]
            out += [(anchor, pos, k + 1, other, -s, -t) for k, (t, other, _) in enumerate(good)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = H.mine_hard_negatives(df, F.col("vec_id") % 10 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("bound", [1, 70_000, 2 ** 40, 2 ** 62])
def test_exact_scores(bound):
    primes = H.primes_for(bound)
    rng = np.random.default_rng(bound % 97)
    for dims in (1, 64, 65, 300):
        top = max(1, int((bound / dims) ** 0.5) - 1)
        a, b = (rng.integers(-top, top + 1, (7, dims)).astype(np.float64) for _ in range(2))
        a[0], b[0] = top, -top
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert H.exact_scores(H.residues(a, primes), H.residues(b, primes), primes).tolist() == want


def test_window_bounds():
    for p in [*range(-50, 51), 2 ** 62, -2 ** 62]:
        lo, hi = H.window_bounds(np.array([p]), 30, 90, 100)
        assert lo[0] == -((-30 * p) // 100) and hi[0] == (90 * p) // 100


def odd_rows():
    rnd = random.Random(3)
    rows = []
    for i in range(240):
        vector = [rnd.uniform(-0.2, 0.4) for _ in range(9)]
        if i % 3 == 0:
            vector = [0.25] * 9                            # one vector holds a third of all rows
        rows.append((i, vector, rnd.randint(0, 3), "x", 1, "b", 0.5))
    rows += [rows[10], rows[10], rows[20], rows[33]]           # repeated rows, anchors too
    rows += [(300, None, 1, None, None, None, None), (301, [None] * 9, 1, None, None, None, None), (None, [0.1] * 9, 1, None, 1, None, 1.0),
             (310, [float("nan")] * 9, 0, "", 0, "", 0.0), (311, [float("inf")] * 9, 0, "", 0, "", 0.0),
             (320, [0.3] * 9, None, "", 0, "", 0.0), (330, [], 1, "", 0, "", 0.0), (331, [0.5, 0.5], 1, "", 0, "", 0.0),
             (340, [-3000.0] * 9, 2, "", 0, "", 0.0), (341, [2500.0] * 9, 2, "", 0, "", 0.0), (10, [0.2] * 9, 1, "", 0, "", 0.0)]
    return rows


@pytest.mark.parametrize("anchor_block", [4096, 7])
def test_brute_force(spark, anchor_block):
    rows = odd_rows()
    assert mined(spark, rows, anchor_block=anchor_block) == brute(rows)


def test_large_norms_raise(spark):
    with pytest.raises(ValueError):
        mined(spark, [(0, [1e30], 1, "", 0, "", 0.0), (1, [1.0], 1, "", 0, "", 0.0)])


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5], 1, "", 0, "", 0.0), (2, [0.5], 1, "", 0, "", 0.0)]) == []
    assert mined(spark, [(10, [], 1, "", 0, "", 0.0), (2, [], 2, "", 0, "", 0.0)]) == []


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
    want = sorted(con.execute(H.OP12_SQL).fetchall())
    got = sorted(tuple(r) for r in H.op12_hard_negatives(spark, folder).collect())
    assert got == want and got
