"""URL filters: rules against a literal reading, mined rules against all token subsets."""

import random
import re
from itertools import combinations

import pytest

from zonepulse.llm import url_filter as U

SCHEMA = "page_id bigint, url string, html string, host int, token string, r string, key string, b int"


def literal(url):
    """host, path, rule, verdict by the words of the contract."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in U.RULES:
        if ("." + host).endswith("." + rule.host) and path.startswith(rule.path):
            best = max(best or rule, rule, key=lambda r: len(r.name))
    return host, path, best.name if best else None, best.verdict if best else None


def tokens(url):
    if url is None or "://" not in url:
        return set()
    host, path, _, _ = literal(url)
    rest = url.split("://", 1)[1][len(host) + len(path):]
    query, _, fragment = rest.partition("#")
    return {f"{p}:{w}" for p, part in (("h", host), ("p", path), ("q", query), ("f", fragment))
            for w in re.split(r"[^\w]+", part.lower()) if w}


def brute_rules(rows, least, min_confidence):
    """All token sets with ``least`` bad rows and the confidence, by trying every subset."""
    uses = {}
    for url, bad in rows:
        t = sorted(tokens(url))
        for k in range(1, len(t) + 1):
            for c in combinations(t, k):
                n, b = uses.get(c, (0, 0))
                uses[c] = (n + 1, b + bad)
    return {c: (b, b / n) for c, (n, b) in uses.items() if b >= least and b / n >= min_confidence}


def odd_urls():
    return [None, "", "no scheme", "://", "http://", "https://A.Example.ORG/ES/x", "https://a.example.org/es/1?x=1#y", "http://org/", "http://org",
            "http://x.org?q=/es/", "http://example.org/en/1", "http://example.org/en/17", "http://badexample.org/en/1", "http://a.com/de/1",
            "http://a.com/fr/", "http://com/fr/1", "http://telecom/de/", "http://x.com:80/de/1", "http://u@x.com/de/1", "HTTP://X.COM/de/?#",
            "http://a.net/x://b.org/es/", "http://é.org/ü\n/x", "http://x.org#/es/", "x://y.com/\nde/"]


def test_rules(spark):
    rows = [(i, u, None, 1, "t", "r", "k", 2) for i, u in enumerate(odd_urls() * 2)] + [(None, "http://a.com/de/", *[None] * 6)]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = U.judge_urls(pages, spark.createDataFrame([], "url string, bad boolean")).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for page_id, url, *_ in rows:
        host, path, rule, verdict = literal(url)
        r = by_id[page_id]
        assert (r.host, r.path, r.rule, r.verdict, r.pattern) == (host, path, rule, verdict or "allow", None), url


@pytest.fixture(scope="module")
def labelled():
    rnd = random.Random(4)
    rows = []
    for i in range(600):
        host = rnd.choice(["hot", "hot", "blog", "shop", "casino"])
        path = rnd.choice(["win", "news", "play/win", "a"])
        url = f"http://{host}.net/{path}/{i}"
        bad = host == "casino" and "win" in path or rnd.random() < 0.1
        rows.append((url, bad))
    rows += [(rows[0][0], False)] * 50 + [(None, True)] * 3 + [("none", False)]
    return rows


def test_mined_rules(spark, labelled):
    want = brute_rules(labelled, 10, 0.7)
    got = U.mine_rules(spark.createDataFrame([*labelled, ("http://casino.net/win", None)], "url string, bad boolean"), max_tokens=20).collect()
    mined = {tuple(r.tokens): (r.support, r.confidence) for r in got}
    assert mined and set(mined) <= set(want)
    for t, (support, confidence) in mined.items():
        assert support == want[t][0] and confidence == pytest.approx(want[t][1])
    for t, (_, confidence) in want.items():                 # what is left out has a part that says as much
        assert any(set(m) <= set(t) and c >= confidence - 1e-9 for m, (_, c) in mined.items())
    uses = lambda t: sum(t in tokens(u) for u, _ in labelled)
    assert all(r.key == min(r.tokens, key=lambda t: (uses(t), t)) for r in got)


def test_verdicts(spark, labelled):
    want = brute_rules(labelled, 10, 0.7)
    urls = [u for u, _ in labelled] + odd_urls() + ["http://new.casino.net/x/win?y#z", "http://casino.net/" + "word/" * 3000 + "win",
                                                   "http://casino.net/news", "http://win.net/casino", "http://casino.com/fr/win"]
    pages = spark.createDataFrame([(i, u, *[None] * 6) for i, u in enumerate(urls)], SCHEMA)
    got = {r.page_id: r for r in U.judge_urls(pages, spark.createDataFrame(labelled, "url string, bad boolean"), max_tokens=20).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        rule, verdict = literal(url)[2:]
        hit = [c for c in want if rule is None and set(c) <= tokens(url)]
        assert got[i].verdict == (verdict or ("block" if hit else "allow")), url
        if hit:
            assert got[i].confidence == pytest.approx(max(want[c][1] for c in hit))
            assert set(got[i].pattern.split(" ")) <= tokens(url)
    assert sum(r.pattern is not None for r in got.values()) > 50


def test_long_baskets(spark):
    """A long URL that many rows repeat is mined in time, since baskets keep the telling tokens."""
    long = "http://spam.net/" + "/".join(f"w{i}" for i in range(300))
    rows = [(long, True)] * 30 + [(f"http://a.net/{i}", False) for i in range(60)]
    got = U.mine_rules(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert got and all(r.support == 30 and r.confidence == 1.0 and len(r.tokens) == 1 for r in got)


@pytest.mark.parametrize("limit", [0, 1, 3])
def test_no_token_is_left_out(spark, labelled, limit):
    """Baskets longer than the limit of FP-growth lose no token: the rules are the same."""
    df = spark.createDataFrame([*labelled, ("http://casino.net/win", None)], "url string, bad boolean")
    rules = lambda k: sorted((r.tokens, r.key, r.confidence, r.support) for r in U.mine_rules(df, max_tokens=k).collect())
    want = rules(20)
    assert any(len(t) > 1 for t, *_ in want) and rules(limit) == want


def test_weak_tokens_of_long_baskets(spark):
    """Two tokens that tell only together are found beside many that tell more alone."""
    rnd = random.Random(5)
    rows = []
    for _ in range(240):
        x, y = rnd.random() < 0.5, rnd.random() < 0.5
        bad = x and y or rnd.random() < 0.3
        words = [f"d{i}" for i in range(10) if rnd.random() < (0.7 if bad else 0.5)] + ["same", "all"]
        words += ["x"] * x + ["y"] * y + ["no"] * (not bad and rnd.random() < 0.5)
        rows.append(("http://a.net/" + "/".join(words), bad))
    want = {c: v for c, v in brute_rules(rows, 24, 0.8).items()}
    want = {c: v for c, v in want.items() if not any(want.get(tuple(t for t in c if t != d), (0, 0))[1] >= v[1] for d in c)}
    assert ("p:x", "p:y") in want and max(len(tokens(u)) for u, _ in rows) > 12
    got = U.mine_rules(spark.createDataFrame(rows, "url string, bad boolean"), min_support=0.1, min_confidence=0.8).collect()
    assert {tuple(r.tokens): (r.support, r.confidence) for r in got} == want


def test_long_baskets_of_mixed_labels(spark):
    """Tokens that always come together, or one inside the other, make no combinations."""
    words = [f"w{i:02}" for i in range(40)]
    rows = [("http://spam.net/" + "/".join(words[:k]), j < 8) for k in range(10, 41) for j in range(10)]
    rows += [(f"http://a.net/{i}", False) for i in range(60)]
    got = U.mine_rules(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert got and all(len(r.tokens) == 1 and r.confidence == pytest.approx(0.8) for r in got)
    assert {r.tokens[0] for r in got} == {"h:spam", *(f"p:{w}" for w in words[:31] + words[31:])} - {
        f"p:{w}" for w in words if 8 * sum(len(words[:k]) > words.index(w) for k in range(10, 41)) < 10}


def test_nothing_to_learn(spark):
    for rows in ([], [("http://a.net/x", False)] * 20, [("http://a.net/x", True)] * 9, [(None, True)] * 30):
        assert U.mine_rules(spark.createDataFrame(rows, "url string, bad boolean")).count() == 0


def test_labelled_urls(spark):
    pages = spark.createDataFrame([(1, "a", *[None] * 6), (1, "b", *[None] * 6), (2, "c", *[None] * 6), (3, None, *[None] * 6),
                                   (None, "d", *[None] * 6), (4, "e", *[None] * 6), (5, "f", *[None] * 6)], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 0, "x"), (2, 1, 0, "x"), (3, 1, 1, "x"), (None, 0, 0, "x"), (5, None, None, "x")],
                                   "doc_id bigint, quality int, toxic int, url string")
    got = sorted((tuple(r) for r in U.labelled_urls(pages, labels).collect()), key=str)
    assert got == sorted([("a", True), ("b", True), ("c", False), (None, True), ("f", None)], key=str)


def test_query_by_brute_force(spark):
    import duckdb
    folder = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT page_id, url FROM '{folder}/pages.parquet'").fetchall()
    known = dict(duckdb.sql(f"SELECT doc_id, bool_or(quality = 0 OR toxic = 1) FROM '{folder}/labels.parquet' GROUP BY 1").fetchall())
    want = brute_rules([(u, known[p]) for p, u in rows if p in known], 10, 0.7)
    got = {r.page_id: r for r in U.op11_url_filter(spark, folder).collect()}
    assert len(got) == len(rows)
    for page_id, url in rows:
        host, path, rule, verdict = literal(url)
        r = got[page_id]
        hit = any(set(c) <= tokens(url) for c in want)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or ("block" if hit else "allow"))


def test_empty(spark):
    assert U.judge_urls(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "url string, bad boolean")).count() == 0
