"""Prefix trie: brute force over odd conversations and many shards, long rows, DuckDB SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

from zonepulse.llm import prefix_trie as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string, ids string, words double, seq binary, key int, shard int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def brute(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0, turn_key(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append((c, len(seq) == d))
    saved = {p: (len(m) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0) for p, m in nodes.items()}
    children, leaves, below = ({p: 0 for p in nodes} for _ in range(3))
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p in nodes:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            below[p[:d]] += saved[p]
    low = {p: min(c for c, _ in m) for p, m in nodes.items()}
    return sorted(
        ((low[p], len(p), low[p[:-1]] if p else None, len(m), children[p], leaves[p], below[p],
          hashlib.sha256(",".join(str(c) for c, e in sorted(m) if e).encode()).hexdigest()) for p, m in nodes.items()), key=str)


def trie(spark, rows):
    df = spark.createDataFrame([(*r, *[None] * 5) for r in rows], SCHEMA).repartition(3)
    got = P.prefix_trie(P.rebuild(P.conversations_of(df)))
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


def many(rnd, n):
    rows = []
    for c in range(n):
        if c % 3 == 0:
            rows += [(c, 0, "user", "same first turn"), (c, 1, "assistant", "and the same end")]      # copies
            continue
        if c % 7 == 0:
            continue
        for t in range(rnd.randint(0, 5)):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a b", "", None, "x y z", "q"])))
    return rows


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_brute_force(spark, parts):
    rnd = random.Random(parts)
    rows = many(rnd, 400)
    rows += [(5, None, "user", "null first"), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (5, 1, "a", "tie two"),
             (None, 1, "user", "nobody"), (-7, 0, "user", "minus"), (-40, 2, "system", "base of minus"), (-41, 2, "x", "y"),
             (1000, 0, "user", "w " * 5000)]
    rows += [(1001, t, "user", f"long {t % 50}") for t in range(150)] + [(1002, t, "user", f"long {t % 50}") for t in range(151)]
    rows += [(1009, t, "user", f"long {t % 50}") for t in range(64)] + [(1010, t, "user", f"long {t % 50}") for t in range(32)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert trie(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_empty_and_turnless(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "user", "x")]) == []
    rows = [(c, 0, "user", "x") for c in range(1, 20)]        # the base is absent: those with h > 0 lose their turn
    assert trie(spark, rows) == brute(rows)


def test_pieces_and_digest(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(P, "PIECE", 3)
    keys, ids = [b"a"] * 7 + [b"b"] + [b"c"] * 3, [*range(7), -1, 5, 6, 7]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i: i + 4], pa.binary()), pa.array(ids[i: i + 4], pa.int64())], ["k", "c"])
               for i in range(0, len(keys), 4)]
    pieces = list(P._pieces(iter(batches)))
    assert [len(x.split(",")) for b in pieces for x in b.column(2).to_pylist()] == [3, 3, 1, 1, 3]
    got = dict(zip(*(sum((b.column(i).to_pylist() for b in P._digest(iter(pieces))), []) for i in (0, 1))))
    assert got == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in ((b"a", "0,1,2,3,4,5,6"), (b"b", "-1"), (b"c", "5,6,7"))}


def test_matrix_order():
    """Rows of many lengths against Python's order of tuples and shared prefixes."""
    rnd = random.Random(2)
    for top in (1, 2, 5):
        rows = list({tuple(rnd.randint(0, top) for _ in range(rnd.choice([0, 1, 31, 32, 33, 64, 65, 100]))) for _ in range(60)}
                    | {(1,) * k for k in range(0, 130)})
        rnd.shuffle(rows)
        lengths = np.array([len(r) for r in rows])
        flat = np.array([x for r in rows for x in r], np.int64)
        order, shared = P.ordered_rows(flat, np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        want = sorted(rows)
        assert [rows[i] for i in order] == want
        for i in range(1, len(want)):
            k = next((j for j, (a, b) in enumerate(zip(want[i - 1], want[i])) if a != b), min(len(want[i - 1]), len(want[i])))
            assert shared[i] == k
        assert shared[0] == 0


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet')")
    got = P.op13_prefix_trie(spark, folder)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({P.OP13_SQL})").fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert pd.Series([r.n_convs for r in got.where("depth = 0").collect()]).sum() > 0
