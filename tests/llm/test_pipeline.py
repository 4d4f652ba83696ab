"""The pipeline stage by stage against plain versions, on sf0.001 with odd rows added."""

import hashlib
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from test_secret_scan import brute as plain_secrets
from test_simhash import plain_components, plain_fingerprint
from zonepulse.llm import bpe, langid

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows (dicts) before the first and after each stage."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(900, None, "en", "s", 0), (901, "12 !!", "en", "s", 5), (902, "", "en", None, 0), (3, "你好世界", "en", "src1", 4),
         (905, "the token = 'abcdefgh12345678' of and that the in", "en", None, 40)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id < 3"))
    out = [[r.asDict() for r in docs.collect()]]
    columns = docs.columns
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append([r.asDict() for r in docs.collect()])
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    return out


def bag(rows):
    return Counter(tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows)


def test_language_id(spark, steps):
    docs = spark.createDataFrame([tuple(r.values()) for r in steps[0]], spark.read.parquet(f"{SF}/documents.parquet").schema)
    model = langid.fit(docs)
    keep = [r for r in steps[0] if (g := model.predict(r["text"]))[0] != "und" and g[1] >= langid.MIN_SCORE]
    assert bag(keep) == bag(steps[1])
    assert {r["doc_id"] for r in steps[0]} - {r["doc_id"] for r in steps[1]} == {900, 901, 902}


def test_one_document_of_each_group(steps):
    prints = {r["text"]: plain_fingerprint(r["text"]) for r in steps[1]}
    component = plain_components(set(prints.values()), 3)
    best = {}
    for r in steps[1]:
        c = component[prints[r["text"]]]
        best[c] = min(best.get(c, r["doc_id"]), r["doc_id"])
    got = Counter(component[prints[r["text"]]] for r in steps[2])
    assert got == Counter(best.keys())
    assert all(best[component[prints[r["text"]]]] == r["doc_id"] for r in steps[2])
    assert not bag(steps[2]) - bag(steps[1])


def test_secrets_hidden(steps):
    want = []
    for r in steps[2]:
        text, at, out = r["text"], 0, ""
        for span in filter(None, plain_secrets(text)[2].split(",")):
            _, s, e = span.split(":")
            if int(s) >= at:
                out += text[at:int(s)] + "[SECRET]"
            at = max(at, int(e))
        new = out + text[at:]
        want.append(r | {"text": new, "n_chars": len(new) if out else r["n_chars"]})
    assert bag(want) == bag(steps[3]) and bag(steps[2]) != bag(steps[3])


def test_mix(steps):
    before, after = bag(steps[3]), bag(steps[4])
    assert all(after[k] <= 2 * before[k] for k in after)
    words = lambda b: {s: sum(n * len(re.findall(r"[^\x20\x09-\x0D]+", k[1])) for k, n in b.items() if k[3] == s)
                       for s in {k[3] for k in before}}
    sizes, taken = words(before), words(after)
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight, fixed, total = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, {}, 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if level * weight[s] >= 2 * sizes[s]]
        if not over:
            break
        fixed |= {s: 2 * sizes[s] for s in over}
    longest = max(len(k[1].split()) for k in before)
    for s in order:
        assert abs(taken[s] - fixed.get(s, level * weight[s])) <= longest / 2 + 1


def test_tokens(steps):
    lib = Tokenizer.from_file(bpe.default_path())
    want = Counter()
    for r in steps[4]:
        ids = lib.encode(r["text"], add_special_tokens=False).ids
        want[(r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in steps[5]) == want


def test_run(spark):
    assert P.run(spark, SF).count() > 150


CLASHING = ("_text _a _k _h _c _base _p _spans text_key _n _same _copy _copies _open _lang _score _at _unit _simhash _id _fp _rows _first "
            "fp node root component_id component_fp size target b h x k1 words TEXT").split()


@pytest.mark.parametrize("stage", [s for s in P.STAGES[:-1]], ids=lambda s: s[0])
def test_clashing_names(spark, stage):
    """Extra columns with the operators' own names pass through unchanged and change nothing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(7, "the token = 'abcdefgh12345678' of and that", "en", "s", 40)] * 2, docs.schema))
    more = docs.select("*", *[docs.doc_id.cast("string").alias(c) for c in CLASHING])
    plain = Counter(tuple(r) for r in stage[1](spark, docs, SF).collect())
    out = stage[1](spark, more, SF)
    assert out.columns == more.columns
    rows = [tuple(r) for r in out.collect()]
    n = len(docs.columns)
    assert Counter(r[:n] for r in rows) == plain
    assert all(v == str(r[0]) for r in rows for v in r[n:])
