"""Merkle fingerprints: neighbours, edits, equality and located branches against Python."""

import hashlib
import random
import re

import pytest

from zonepulse.llm import merkle as M

SCHEMA = "doc_id bigint, text string, fingerprint string, _next int"


def rows():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdé😀") for _ in range(rnd.randint(1, 9)))
    text = lambda: "".join(word() + rnd.choice([" ", ". ", "\n", "\n\n", "! "]) for _ in range(rnd.randint(0, 80)))
    ids = rnd.sample(range(-500, 5000), 120)
    out = [(i, text(), "x", 1) for i in ids]
    return out + [(7777, None, None, None), (9000, "", "x", 1), (ids[5], out[5][1], "x", 1), (8000, "one", "x", 1)]


def key(r):
    return (r[0] is None, -(r[0] or 0))


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_edited_texts(spark, buckets):
    docs = spark.createDataFrame(rows(), SCHEMA)
    order = sorted(rows(), key=key)
    want = []
    for k, r in enumerate(order):
        text, nxt = r[1] or "", order[(k + 1) % len(order)][1] or ""
        n = len(text)
        want.append((r[0], n, text, nxt, text[: n - n // 3] + nxt[: n // 3]))
    got = [tuple(r) for r in M.edited_pairs(docs, buckets).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_null_ids_and_single_row(spark):
    some = spark.createDataFrame([(None, "n", "", 1), (3, "c", "", 1), (5, "e", "", 1)], SCHEMA)
    got = {r._id: r._next for r in M.with_next(some, 4).collect()}
    assert got == {5: "c", 3: "n", None: "e"}
    one = spark.createDataFrame([(1, "abc", "", 1)], SCHEMA)
    assert [(r._id, r._next) for r in M.with_next(one, 4).collect()] == [(1, "abc")]
    assert M.edited_pairs(some.limit(0), 4).count() == 0


def test_extreme_and_hot_ids(spark):
    """The least and greatest long, rows that share one id, and rows without an id."""
    lo, hi = -2**63, 2**63 - 1
    rows = [(lo, "low", "", 1), (hi, "high", "", 1)] + [(5, f"five {i}", "", 1) for i in range(40)]
    rows += [(None, f"none {i}", "", 1) for i in range(40)] + [(5, "same", "", 1)] * 10
    got = M.with_next(spark.createDataFrame(rows, SCHEMA), 8).collect()
    assert sorted((str(r._id), r._text) for r in got) == sorted((str(r[0]), r[1]) for r in rows)
    assert sorted(r._next for r in got) == sorted(r[1] for r in rows)      # one round through all rows
    kind = {r._text: (r._id, r._next) for r in got if r._text != "same"}
    assert kind["high"][1].startswith(("five", "same")) and kind["low"][1].startswith("none")
    assert sum(r._next == "low" for r in got) == sum(r._next == "high" for r in got) == 1


def test_plan_does_not_grow_with_ranges(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    size = lambda n: len(M.with_next(docs, n)._jdf.queryExecution().analyzed().toString())
    assert abs(size(100) - size(2)) < 100


def test_inserted_and_moved_branches(spark):
    """Against sets in Python: insertions at the front, moves, edits inside a section."""
    rnd = random.Random(9)
    cases = []
    for _ in range(40):
        secs = [[f"s{rnd.randint(0, 30)} p{rnd.randint(0, 9)}.\n" for _ in range(rnd.randint(1, 4))] for _ in range(rnd.randint(1, 6))]
        other = [list(x) for x in secs]
        if rnd.random() < 0.6:
            other.insert(rnd.randint(0, len(other)), ["New one.\n", "And more.\n"])
        if rnd.random() < 0.5:
            rnd.shuffle(other)
        if rnd.random() < 0.6:
            other[rnd.randrange(len(other))].insert(0, "Put in.\n")
        text = lambda t: "\n".join("".join(x) for x in t)
        cases.append((text(secs), text(other)))
    cases.append(("A.\n\nB.\n", "New.\n\nA.\n\nB.\n"))
    df = spark.createDataFrame(cases, "a string, b string").select(
        "*", M.fingerprint("a").alias("fingerprint"), M.fingerprint("b").alias("edited_fingerprint"))
    tree = lambda t: [list(filter(None, re.split(r"(?<=\n)", s)))
                      for s in filter(None, re.split(r"(?<=\n\n)(?!\n)", t))]

    def only(x, y):
        mine = [i for i, s in enumerate(x) if s not in y]
        theirs = {p for s in y if s not in x for p in s}
        return mine, [(i, j) for i in mine for j, p in enumerate(x[i]) if p not in theirs]

    got = M.differing_branches(df).collect()
    for r in got:
        x, y = tree(r.a), tree(r.b)
        assert (r.sections, [tuple(p) for p in r.paragraphs]) == only(x, y), r.a
        assert (r.other_sections, [tuple(p) for p in r.other_paragraphs]) == only(y, x), r.b
    last = next(r for r in got if r.a == "A.\n\nB.\n")
    assert last.sections == [] and last.other_sections == [0]


def plain(text):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out, hs = "", []
    for s in filter(None, re.split(r"(?<=\n\n)(?!\n)", text)):
        ps, ph = [], []
        for p in filter(None, re.split(r"(?<=\n)", s)):
            leaves = [sha(x) for x in re.findall(r"[^.!?]{1,64}[.!?]*|[.!?]+", p)]
            ph.append(sha("".join(leaves)))
            ps.append(ph[-1][:12] + ":" + ",".join(x[:12] for x in leaves))
        hs.append(sha("".join(ph)))
        out += "|" + hs[-1][:12] + ";" + ";".join(ps)
    return sha("".join(hs)) + out


def test_query(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op5_merkle_fingerprint(spark, str(tmp_path)).collect()
    assert len(got) == len(rows())
    by_text = {}
    texts = {}
    for r in rows():
        texts.setdefault(r[0], r[1] or "")
    for r in got:
        text = texts[r.doc_id]
        assert r.n_chars == len(text)
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0
        if len(text) > 200:
            assert r.near_edited > 0.4 > r.near_next
    assert len(set(by_text.values())) == len(by_text)


def test_branches_locate_edits(spark):
    base = "Head line.\nFirst one. Second one.\n\nNext part.\nIts end.\n"
    edit = base.replace("Its end.", "Another end.")
    df = spark.createDataFrame([(base, edit), (base, base), (base, "")], "a string, b string")
    df = df.select(M.fingerprint("a").alias("fingerprint"), M.fingerprint("b").alias("edited_fingerprint"))
    got = M.differing_branches(df).select("sections", "paragraphs").collect()
    assert got[0].sections == [1] and [tuple(p) for p in got[0].paragraphs] == [(1, 1)]
    assert got[1].sections == [] and got[2].sections == [0, 1]


def test_tree_matches_plain(spark):
    texts = [r[1] or "" for r in rows()]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", M.fingerprint("t").alias("f"))
    for r in df.collect():
        assert r.f == plain(r.t), r.t
