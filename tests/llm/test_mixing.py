"""Mixing: targets against a literal reshare loop, totals, bounds, odd rows, reruns."""

import random
import re

import pytest

from zonepulse.llm import mixing

SCHEMA = "doc_id bigint, text string, lang string, source string, target double"


def reshare(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] >= cap * sizes[s]]
        if not over:
            return fixed | {s: level * w[s] for s in open_}
        fixed |= {s: cap * sizes[s] for s in over}


def test_transfer_keeps_sum_and_expectation():
    rnd = random.Random(5)
    for _ in range(200):
        sa, sb = rnd.randint(1, 50), rnd.randint(1, 50)
        a, b = rnd.uniform(0.01, 0.99) * sa, rnd.uniform(0.01, 0.99) * sb
        up, down = min(sa - a, b), min(a, sb - b)
        hi, lo = mixing.transfer(sa, a, sb, b, 0.0), mixing.transfer(sa, a, sb, b, 1 - 1e-12)
        for x, y in (hi, lo):
            assert x + y == pytest.approx(a + b)
            assert x in (0.0, float(sa)) or y in (0.0, float(sb))
        p = down / (up + down)
        assert p * hi[0] + (1 - p) * lo[0] == pytest.approx(a)


@pytest.mark.parametrize("block_rows,fan_in", [(20_000, 256), (3, 2)])
def test_mix(spark, block_rows, fan_in):
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        source = "big" if i % 3 else rnd.choice(["a", "é", None, "z"])
        rows.append((i, " \t".join("w" for _ in range(rnd.randint(0, 40))), "en", source, 9.0))
    rows += [(7, None, None, "nulls", None), (None, "x y", None, "a", None), (5, "d e f", "en", "a", None),
             (5, "d e f", "en", "a", None), (8, "", "en", "void", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.plan_copies(docs, block_rows=block_rows, fan_in=fan_in).toPandas()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = reshare(sizes)
    got["source"] = got["source"].where(got["source"].notna(), None)
    for source, part in got.groupby("source", dropna=False):
        source = source if isinstance(source, str) else None
        assert part["target"].iloc[0] == pytest.approx(want[source])
        assert part["source_size"].iloc[0] == sizes[source]
        taken = (part["copies"] * part["size"]).sum()
        assert abs(taken - want[source]) <= part["size"].max() / 2 + 1e-6
    assert got["copies"].between(0, 2).all()
    again = mixing.plan_copies(docs.repartition(5), block_rows=block_rows, fan_in=fan_in).toPandas()
    key = ["doc_id", "text_key", "copies"]
    assert got.sort_values(key)[key].values.tolist().__repr__() == again.sort_values(key)[key].values.tolist().__repr__()


def test_mixed_rows(spark):
    docs = spark.createDataFrame([(i % 40, f"w{i % 40} b c", "en", f"s{i % 4}", 1.0) for i in range(80)], SCHEMA)
    plan = mixing.plan_copies(docs)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == plan.agg({"copies": "sum"}).first()[0]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.plan_copies(docs).count() == 0
    assert mixing.mix_documents(docs).count() == 0
