"""HTML extraction: block rules on literal pages, the tree on its table, whole pages against their article."""

import html
import random
import re

import numpy as np

from zonepulse.llm import html_text as H

SF = "/root/testdata/sf0.01"


def test_tree_learns_its_table():
    model = H.train()
    found = [H.blocks(p, model.odds) for p in H.training_pages()]
    x = np.concatenate([H.block_features(b) for b in found])
    y = np.array([b[0].startswith("good") for page in found for b in page])
    assert len(y) < 5000 and (model.tree.predict(x) == y).mean() > 0.99
    used = {H.FEATURES[f] for f in model.tree.feature if f >= 0}
    assert {"words before", "words after", "density before", "density after"} <= used


def test_held_out_blocks():
    """Real blocks, none of them in the table: by all features, and with every telling element and name taken away."""
    import pyarrow.parquet as pq
    model, whole, bare = H.train(), [], []
    for page in pq.read_table(f"{SF}/pages.parquet")["html"].to_pylist():
        truth = [b[3] == 1.0 for b in H.blocks(page)]
        whole += [keep == t for (_, keep), t in zip(model.judge(page), truth)]
        plain = re.sub(r"<(/?)(article|nav|footer)>", r"<\1div>", page).replace(' class="ad"', "")
        judged = model.judge(plain)
        assert len(judged) == len(truth)
        bare += [keep == t for (_, keep), t in zip(judged, truth)]
    assert np.mean(whole) == 1.0 and np.mean(bare) > 0.88


def test_block_features():
    found = H.blocks("<nav><a>x y</a> z</nav><article><h1>a</h1><p>b <i>c</i> d</p></article>")
    x = H.block_features(found)
    at = {f: x[:, i].tolist() for i, f in enumerate(H.FEATURES)}
    assert at["words"] == [3, 1, 3] and at["density"] == [2 / 3, 0, 0]
    assert at["words before"] == [0, 3, 1] and at["words after"] == [1, 3, 0] and at["words 2 after"] == [3, 0, 0]
    assert at["density before"] == [0, 2 / 3, 0] and at["density 2 before"] == [0, 0, 2 / 3]
    assert at["element"] == [-1, 1, 1] and at["heading"] == [0, 1, 0] and at["page has article"] == [1, 1, 1]


def test_literal_pages():
    model = H.train()
    para = "A long enough paragraph of plain words that goes on and on and says something with &eacute; &lt;b&gt; &amp;amp; in it."
    text = "A long enough paragraph of plain words that goes on and on and says something with é <b> &amp; in it."
    cases = {
        f"<p>{para}</p>": text,
        f"<nav>x<article><p>{para}</p></article>": text,
        f'<article><p>One <a href="x>y">two</a> th<b>r</b>ee<!-- c --><br>x\n \ty</p><script>v="</article>";</script>'
        f'<section class="comments"><p>{para}</p></section><p>four</article><footer>{para}': "One two three x y four",
        f'<div id="main"><p>{para}</p><div class="site-ad">buy</div><div class="sidebar"><p>{para}</p></div></div>': text,
        f"<article><p>in</p><p hidden>{para}</p><div style='display: none'>{para}</div><form>{para}</form>"
        f"<aside>{para}</aside><p>out": "in out",
        "": "", "<p": "", "<!-- open " + para: "", "<style>" + para: "",
    }
    for page, want in cases.items():
        assert H.main_text(page, model) == want, page


def test_no_crash_on_cut_pages():
    rnd, model = random.Random(1), H.train()
    page = H.training_pages()[0] + "<a b='c\"><p x=\"'>&#0;&#x110000;&bogus; </ p><//><>"
    for _ in range(300):
        i, j = sorted(rnd.sample(range(len(page)), 2))
        assert isinstance(H.main_text(page[:i] + page[j:], model), str)


def test_whole_pages(spark):
    rows = H.op8_html_extraction(spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(?=</article>|<footer|\Z)", pages[r.page_id], re.S)[1]
        plain = html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", article)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (1, "u", None, 1), (None, None, "", 2), (3, "u", "<article><p>x " * 20_000, 3)],
                                  "page_id bigint, url string, html string, text int")
    got = H.extract_text(pages).collect()
    assert sorted((r.n_chars for r in got)) == [0, 0, 0, 2 * 20_000 - 1]
    assert H.extract_text(pages.limit(0)).count() == 0
