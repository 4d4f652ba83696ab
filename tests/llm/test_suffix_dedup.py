"""Suffix dedup: suffix order, repeated windows and whole results against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from zonepulse.llm import suffix_dedup as S


def test_two_stage_order():
    rnd = random.Random(1)
    for alpha in ("a", "ab", "abc", "abcdefgh"):
        for n in (1, 2, 3, 30, 300):
            raw = bytes(ord(rnd.choice(alpha)) for _ in range(n)) + b"\0"
            order = S.two_stage_order(np.frombuffer(raw, np.uint8), raw, len(raw))
            assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def brute_starts(strings, w):
    seen = Counter(s[i:i + w] for s in strings for i in range(len(s) - w + 1))
    return [[i for i in range(len(s) - w + 1) if seen[s[i:i + w]] > 1] for s in strings]


@pytest.mark.parametrize("w", [8, 9, 13, 16, 20])
def test_repeated_starts(w):
    rnd = random.Random(w)
    for _ in range(60):
        strings = ["".join(rnd.choice("abé😀"[: rnd.randint(1, 4)]) for _ in range(rnd.randint(0, 40))).encode() for _ in range(6)]
        strings.append(strings[0][3:] + strings[1])
        assert [x.tolist() for x in S.repeated_starts(strings, w)] == brute_starts(strings, w)


def brute(texts, w):
    data = [(t or "").encode() for t in texts]
    out = []
    for d, starts in zip(data, brute_starts(data, w)):
        gone = np.zeros(len(d) + 1, bool)
        for i in starts:
            gone[i:i + w] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(d) else 0
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone[:len(d)].sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefé") for _ in range(rnd.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(30) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(rnd.randint(0, 40)) for _ in range(3)]
        if rnd.random() < 0.6:
            s = rnd.choice(shared)
            parts.insert(1, s[rnd.randint(0, 60): len(s) - rnd.randint(0, 40)])
        rows.append((i, " ".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1] + "!"), (3, rows[3][1]), (3, rows[3][1]), (102, None), (None, ""), (None, rows[7][1]),
             (103, "a" * 500), (104, "ab" * 300), (105, "short"), (106, rows[9][1][:-7] + "changed" + rows[10][1])]
    return rows


@pytest.mark.parametrize("window,limit,batch", [(60, 3000, 1 << 20), (40, 3000, 500), (40, 1, 1 << 20), (40, 2, 400), (60, 5, 1 << 20), (400, 3000, 1 << 20)])
def test_against_brute_force(spark, window, limit, batch):
    rows = corpus(window)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, k1 string, anchor int")
    got = S.remove_repeats(docs, window, bucket_limit=limit, batch_bytes=batch).collect()
    want = [(i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], window))]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    texts = {hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got if "\ufffd" not in r.text}
    assert texts == {True}


def test_pieces_of_a_long_text():
    rnd = random.Random(4)
    text = "".join(rnd.choice("abcd") for _ in range(5000)).encode()
    cutter = S.Cutter(50, 12, piece=700)
    covered = np.zeros(len(text) - 49, int)
    for _, start, count, anchor, stretch, lead in cutter.stretches([b"x", text, text[:49]]):
        covered[start:start + count] += 1
        assert stretch == S._digest(text[start:start + count + 49])
        assert anchor == S._digest(text[start + lead:start + lead + 12]) and 0 <= lead - count + 1 and lead <= 38
    assert (covered == 1).all()
    assert covered.sum() / len(list(cutter.stretches([text]))) > 10      # a stretch holds many windows
    # the anchor of a window depends on its content alone
    by_window = {}
    for _, start, count, anchor, _, _ in cutter.stretches([text[13:2000] + text[100:900]]):
        for i in range(start, start + count):
            by_window.setdefault((text[13:2000] + text[100:900])[i:i + 50], set()).add(anchor)
    assert all(len(a) == 1 for a in by_window.values())


@pytest.mark.parametrize("width", [50, 12, 3, 1])
def test_cut_again(width):
    """Pieces cover every window once, and equal windows of one anchor meet in one group."""
    rnd = random.Random(width)
    text = "".join(rnd.choice("ab") for _ in range(900)).encode() + b"x" * 120
    cutter, groups = S.Cutter(50, 12), {}
    texts = [text, text[200:700] + text[:300]]
    for k, start, count, anchor, _, lead in cutter.stretches(texts):
        data = texts[k][start: start + count + 49]
        seen = []
        for key, begin, place, piece in S.cut_again(anchor, 0, lead, data, 50, width):
            assert piece == data[begin: begin + len(piece)] and place == lead - begin
            for i in range(len(piece) - 49):
                seen.append(begin + i)
                groups.setdefault((anchor, piece[i: i + 50]), set()).add(key)
                if width == 1:
                    assert len(piece) == 50
        assert seen == list(range(count))
    assert groups and all(len(k) == 1 for k in groups.values())


def test_hot_passage(spark):
    """Hundreds of different stretches around one passage, cut down to one place if need be."""
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcd ") for _ in range(39))
    rows = [(i, "".join(rnd.choice("xyz") for _ in range(30)) + passage + "".join(rnd.choice("xyz") for _ in range(30))) for i in range(150)]
    rows += [(500 + i, "q" * i + passage + "zz") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted((i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows], 40)))
    for limit in (1, 20):
        assert sorted(tuple(r)[:5] for r in S.remove_repeats(docs, 40, bucket_limit=limit).collect()) == want


def test_empty(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
