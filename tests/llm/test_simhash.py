"""SimHash: fingerprints bit by bit, components against brute force over all pairs."""

import random
import re

import pytest
import xxhash

from zonepulse.llm import simhash as S

SCHEMA = "doc_id bigint, text string, lang string, fp string, u string"


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, max_bits):
    ids, comp = sorted(fps), {f: f for f in fps}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (a ^ b).bit_count() <= max_bits:
                comp[find(a)] = find(b)
    return {f: find(f) for f in ids}


def test_fingerprint_matches_plain():
    rnd = random.Random(2)
    for n in (0, 1, 2, 3, 4, 50, 400):
        text = "".join(rnd.choice(["Ab", "é", "x", "ÀB"]) + rnd.choice([" ", "\n", " ", " \t"]) for _ in range(n))
        assert S.simhash(text.encode()) == plain_fingerprint(text)
    long = " ".join(str(rnd.random()) for _ in range(3000))
    whole = S.simhash(long.encode())
    old, S._PIECE = S._PIECE, 100
    try:
        assert list(w for p in S.word_lists(long.encode(), 100) for w in p) == long.encode().split()
    finally:
        S._PIECE = old
    assert whole == plain_fingerprint(long)


@pytest.mark.parametrize("pair_limit,max_bits", [(100_000, 3), (20, 3), (5, 2)])
def test_components_match_brute_force(spark, pair_limit, max_bits):
    rnd = random.Random(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):
        seed = rnd.getrandbits(64)
        for _ in range(16):
            f = seed
            for _ in range(rnd.randint(0, 4)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    want = plain_components(fps, max_bits)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    df = spark.createDataFrame([(v,) for v in signed.values()], "fp bigint")
    got = {r.node: r.root for r in S.components(S.near_links(df, max_bits, pair_limit)).collect()}
    groups = {}
    for f, c in want.items():
        groups.setdefault(c, set()).add(signed[f])
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_rows(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(9, base, "en", "a", "b"), (4, base, "en", "a", "b"), (4, base, "en", "a", "b"), (None, base, "x", "", ""),
            (7, "", "en", "", ""), (3, None, "en", "", ""), (6, " \n", "en", "", ""), (5, "One", "en", "", ""),
            (5, "totally different words here", "en", "", ""), (12, "one", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.doc_id, r.component_id) for r in S.simhash_components(docs).collect()), key=str)
    assert got == sorted([(9, 4), (4, 4), (4, 4), (None, 4), (7, 3), (3, 3), (6, 3), (5, 5), (5, 5), (12, 5)], key=str)
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        [(4, base), (3, None), (5, "One"), (5, "totally different words here")], key=lambda r: (r[0], str(r[1])))


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert S.simhash_components(docs).count() == 0
    assert S.drop_near_duplicates(docs).count() == 0
