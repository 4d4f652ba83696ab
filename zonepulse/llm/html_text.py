"""Main text of web pages: flat text blocks judged by a small decision tree.

A page is read once from left to right into flat blocks: runs of text between block-level
tags, without markup, comments, scripts and styles. The features of a block are its words
and link density, the words and densities of the two blocks before and the two after it,
whether it is a heading, the HTML element it lies in (article or main; nav, aside, footer,
form and the like; neither), whether the page has an article or main element at all, and what
the class, id and role names around it have meant in the labelled table: the log odds of
main text for the names of the nearest element whose names the table knows.

A decision tree (Gini, at most ``DEPTH`` levels) and the log odds are trained on a small
labelled table of blocks, made by ``training_pages``: layouts in which the text of main
blocks says ``good`` and that of the rest ``bad``, half of them without any telling element or
name, so that there words, densities and neighbours have to decide.

Defined results:

* null or empty html, or no block kept: empty text, 0 characters;
* unclosed and stray tags: an end tag closes the nearest open element of its name, or is
  ignored; an unclosed comment, tag, script or style ends with the page;
* elements that the page hides (``hidden``, ``aria-hidden``, style) have no text;
* repeated rows: each is returned; null page_id or url: passed on; empty table: empty result;
* other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from zonepulse.llm.common import read_table, small_batches

DEPTH = 12

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|</?[A-Za-z][^>]*+\Z", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose content is no text of the page.
RAW = frozenset("script style textarea title noscript template iframe object svg xmp noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img".split())
DROPPED = frozenset("nav footer aside form button select option label fieldset dialog menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that close an open paragraph or list item of the same kind.
SELF_CLOSING = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                "td": ("td", "th"), "th": ("td", "th")}
#: Names of page parts in the labelled table.
PART_NAMES = (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side menu "
    "submenu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr "
    "notice notices alert disclaimer popup modal overlay newsletter subscribe subscription signup login search share "
    "sharing social related recommended recommendations comment comments reply replies disqus respond widget pager "
    "pagination copyright legal skip contentinfo complementary form header").split()
MAIN_NAMES = "article main content post entry story text body page".split()

#: Kinds of the nearest telling element.
_MAIN, _HEAD, _NONE, _PART = 1.0, 0.5, 0.0, -1.0
_HIDDEN = -9.0

#: A block: text, words, link density, kind of element, heading, log odds of names, the names.
Block = tuple[str, int, float, float, bool, float, tuple[str, ...]]


def _kind(tag: str, outer: float) -> float | None:
    """Kind that an element opens by its HTML name, or None."""
    if tag in ("article", "main"):
        return _MAIN
    if tag in DROPPED:
        return _PART
    if tag == "header":
        return _HEAD if outer == _MAIN else _PART
    return None


def _names(attributes: str) -> tuple[bool, tuple[str, ...]]:
    """Whether an element is hidden, and the words of its class, id and role."""
    if not attributes:
        return False, ()
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), a or b or c)
    hidden = (HIDDEN.search(found.get("style", "")) is not None or found.get("aria-hidden", "").lower() == "true"
              or re.search(r"(?<![\w-])hidden(?![\w-])", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)) is not None)
    return hidden, tuple(sorted({p.lower() for k in ("class", "id", "role") for p in NAME_PART.findall(found.get(k, ""))}))


def blocks(page: str, odds: dict[str, float] | None = None) -> list[Block]:
    """Text blocks in page order; ``odds`` are the log odds of names."""
    odds = odds or {}
    out: list[Block] = []
    # open elements with what holds inside them: kind, log odds, names
    stack: list[tuple[str, float, float, tuple[str, ...]]] = []
    kind, said, names, links, headings = _NONE, 0.0, (), 0, 0
    parts: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text and kind != _HIDDEN:
            words = text.count(" ") + 1
            inside = len(" ".join(linked).split())
            out.append((text, words, min(1.0, inside / words), kind, headings > 0, said, names))
        parts.clear()
        linked.clear()

    def close(k: int) -> None:
        nonlocal kind, said, names, links, headings
        for name, *_ in stack[k:]:
            links -= name == "a"
            headings -= name in HEADINGS
        del stack[k:]
        kind, said, names = stack[-1][1:] if stack else (_NONE, 0.0, ())

    def say(raw: str) -> None:
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked.append(text)

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at: m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:                          # end tag
            if tag not in INLINE:
                flush()
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if k is not None:
                if tag in INLINE and any(e[0] not in INLINE for e in stack[k + 1:]):
                    continue                      # a stray inline end tag does not close blocks
                if tag in INLINE and stack[k][1:] != (stack[k - 1][1:] if k else (_NONE, 0.0, ())):
                    flush()
                close(k)
            elif tag == "p":
                flush()
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag not in INLINE:
            flush()
            for k in range(len(stack) - 1, -1, -1):
                name = stack[k][0]
                if name in SELF_CLOSING.get(tag, ()):
                    close(k)
                    break
                if name not in INLINE and name != "p" or name == "p" and tag in INLINE:
                    break
            if tag != "p":                        # a block inside a paragraph ends it
                k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), None)
                if k is not None and stack[k][0] == "p" and tag not in VOID:
                    close(k)
        if tag in VOID:
            continue
        hidden, own = _names(attributes) if tag not in ("html", "body") else (False, ())
        opened = _HIDDEN if hidden or kind == _HIDDEN else _kind(tag, kind)
        score, called = said, names
        if opened == _MAIN and kind != _MAIN:
            score, called = 0.0, ()               # names around the article say nothing of its text
        if own:
            called = own
            known = [odds[n] for n in own if n in odds]
            if known:
                score = min(known) if min(known) < 0 else max(known)
        if tag in INLINE and (opened is not None and opened != kind or score != said):
            flush()
        stack.append((tag, kind if opened is None else opened, score, called))
        kind, said, names = stack[-1][1:]
        links += tag == "a"
        headings += tag in HEADINGS
    flush()
    return out


FEATURES = ("words", "density", "words before", "density before", "words after", "density after", "words 2 before",
            "density 2 before", "words 2 after", "density 2 after", "element", "page has article", "heading", "names")


def block_features(found: list[Block]) -> np.ndarray:
    """A row of ``FEATURES`` per block."""
    if not found:
        return np.zeros((0, len(FEATURES)))
    words, density, kind, heading, said = (np.array([b[i] for b in found], float) for i in (1, 2, 3, 4, 5))
    near = lambda v, k: np.concatenate([np.zeros(min(k, len(v))), v[:-k]]) if k > 0 else np.concatenate([v[-k:], np.zeros(min(-k, len(v)))])
    main = np.full(len(found), float((kind >= _HEAD).any()))
    around = [near(v, k) for k in (1, -1, 2, -2) for v in (words, density)]
    return np.stack([words, density, *around, kind, main, heading, said], 1)


def _random_page(rnd: random.Random, marked: bool) -> str:
    """A page of random lengths. One that is not ``marked`` has no telling elements or names:
    words, links and neighbours decide."""
    text = lambda word, n: " ".join([word] * n)
    links = lambda: "<ul>" + "".join(f'<li><a href="/">{text("bad", rnd.randint(1, 3))}</a></li>' for _ in range(rnd.randint(3, 9))) + "</ul>"
    paragraphs = []
    for i in range(rnd.randint(3, 14)):
        n = rnd.choice([1, 2, 3, 6]) if 0 < i and rnd.random() < 0.3 else rnd.randint(12, 120)
        link = f' <a href="/">{text("good", 2)}</a>' if n > 11 and rnd.random() < 0.3 else ""
        paragraphs.append(f"<p>{text('good', n)}{link}</p>" if rnd.random() < 0.9 else f"<h2>{text('good', rnd.randint(1, 6))}</h2><p>{text('good', 30)}</p>")
    line = lambda: f"<div>{text('bad', rnd.randint(1, 9))}</div>"
    top = rnd.choice([links(), links() + line(), f"<div>{text('bad', 2)}</div>" + links()])
    foot = rnd.choice([links(), f"<div>{text('bad', rnd.randint(2, 8))} <a>{text('bad', rnd.randint(2, 6))}</a></div>", links() + line()])
    body = f"<h1>{text('good', rnd.randint(2, 8))}</h1>{''.join(paragraphs)}"
    if not marked:
        return f"{top}{body}{foot}"
    ad = f'<div class="{rnd.choice(PART_NAMES)}">{text("bad", rnd.randint(1, 60))}</div>'
    short = "".join(f"<p>{text('good', rnd.randint(1, 5))}</p>" for _ in range(rnd.randint(0, 4)))
    main = rnd.choice(("article", "main"))
    inside = ad if rnd.random() < 0.3 else ""
    return (f"<nav>{top}</nav>{ad}<{main}>{rnd.choice([body, short + body, body + short, short + '<p>good</p>'])}{inside}</{main}>"
            f"{rnd.choice(['', ad])}<footer>{foot}{text('bad', rnd.randint(0, 40))}</footer>")


def training_pages() -> list[str]:
    """Labelled pages: main blocks consist of the word ``good``, all others of ``bad``."""
    good = lambda n: " ".join(["good"] * n)
    bad = lambda n: " ".join(["bad"] * n)
    links = lambda n, w=1: "<ul>" + "".join(f'<li><a href="/">{bad(w)}</a></li>' for _ in range(n)) + "</ul>"
    out = []
    for k, (short, mid, long) in enumerate([(1, 9, 40), (2, 14, 25), (3, 20, 120), (1, 6, 300), (4, 11, 60), (2, 30, 15)]):
        body = (f"<h1>{good(3 + k)}</h1><p>{good(long)}</p><p>{good(short)}</p><h2>{good(2)}</h2><p>{good(mid)}</p>"
                f'<ul><li>{good(mid)}</li><li><a href="/">{good(short)}</a></li></ul><blockquote>{good(mid)}</blockquote>')
        junk = (f'<div class="ad">{bad(mid)}</div><aside><p>{bad(long)}</p></aside><form>{bad(short)}<button>{bad(1)}</button></form>'
                f'<div id="cookie-notice"><p>{bad(mid + long)}</p></div>')
        foot = f"<footer>{bad(4 + k)} <a>{bad(2)}</a></footer>"
        talk = f'<div class="comments"><h3>{bad(2)}</h3><p>{bad(long)}</p><p>{bad(mid)}</p></div>'
        nav = f"<nav>{links(4 + k)}</nav>"
        out.append(f"{nav}{junk}<article>{body}{talk}</article>{foot}")
        out.append(f"<header><h1>{bad(3)}</h1>{nav}</header><main>{body}{junk}</main>{talk}{foot}")
        out.append(f"<div>{bad(long)}</div><p>{bad(short)}</p><article><header><h1>{good(4)}</h1><p>{bad(mid)}</p></header>"
                   f"{body}</article><div>{bad(mid)}</div>{foot}")
        out += [f"<p>{good(n)}</p>" for n in (short + 11, mid + 9, long + 12, 20 + k)]
        out.append(f"<div>{good(long + 15)}</div><p>{good(mid + 15)}</p>")
        for n in (short, mid, long):                       # articles of one paragraph, between parts of any length
            out.append(f"<nav>{bad(n)}</nav><article><p>{good(n)}</p></article>")
            out.append(f"<article><p>{good(n)}</p><p>{good(short)}</p><form>{bad(mid)}</form><aside>{bad(n)}</aside><p>{good(short)}</p></article>")
            out.append(f"<article><p>{good(n)}</p></article><footer>{bad(mid)}</footer>")
        plain = f"<h1>{good(4)}</h1>" + "".join(f"<p>{good(n)}</p>" for n in (long + 10, mid + 12, long + 5, mid + 15))
        out.append(f"<div class='menu'>{links(6)}</div><div>{plain}</div>{talk}<div class='footer'>{bad(long)}</div>")
    # one page a name: such parts beside and inside the article, of all lengths
    for i, name in enumerate(PART_NAMES):
        n = (3, 12, 45)[i % 3]
        inside = f'<div class="{name}"><p>{bad(n)}</p><p>{bad(40 - 2 * (i % 9))}</p></div>'
        out.append(f'<article><p>{good(50)}</p>{inside}<p>{good(n)}</p></article>{inside}')
        out.append(f'<div class="{MAIN_NAMES[i % len(MAIN_NAMES)]}"><h1>{good(4)}</h1><p>{good(40)}</p>{inside}<p>{good(n)}</p><p>{good(30)}</p></div>{inside}')
        out.append(f'<div id="{MAIN_NAMES[i % len(MAIN_NAMES)]}"><p>{good(n + 12)}</p><div class="{name}">{bad(1 + i % 4)}</div>{inside}</div>')
    rnd = random.Random(11)
    return out + [_random_page(rnd, marked) for _ in range(60) for marked in (False, True)]


def name_odds(found: list[Block]) -> dict[str, float]:
    """Log odds of main text for each name over labelled blocks; each name counted once a block."""
    good, every = Counter(), Counter()
    for text, *_, names in found:
        every.update(names)
        if text.startswith("good"):
            good.update(names)
    return {n: math.log((good[n] + 0.5) / (every[n] - good[n] + 0.5)) for n in every}


class Tree:
    """Binary decision tree by Gini impurity; arrays of node -> feature, cut, children, verdict."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = DEPTH, least: int = 8) -> None:
        self.feature: list[int] = []
        self.cut: list[float] = []
        self.down: list[tuple[int, int]] = []
        self.verdict: list[bool] = []
        self._grow(x, y, depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        node = len(self.feature)
        self.feature.append(-1)
        self.cut.append(0.0)
        self.down.append((-1, -1))
        self.verdict.append(bool(y.mean() >= 0.5))
        if depth == 0 or y.all() or not y.any():
            return node
        best = (0.0, -1, 0.0)
        impurity = lambda n, k: k * (n - k) / np.maximum(n, 1)
        whole = impurity(len(y), y.sum())
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, hits = x[order, f], np.cumsum(y[order])
            n = np.arange(1, len(y))
            gain = whole - impurity(n, hits[:-1]) - impurity(len(y) - n, hits[-1] - hits[:-1])
            gain[(v[1:] == v[:-1]) | (n < least) | (len(y) - n < least)] = 0.0
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), f, float((v[k] + v[k + 1]) / 2))
        if best[1] >= 0:
            self.feature[node], self.cut[node] = best[1], best[2]
            low = x[:, best[1]] <= best[2]
            self.down[node] = (self._grow(x[low], y[low], depth - 1, least), self._grow(x[~low], y[~low], depth - 1, least))
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, cut = np.array(self.feature), np.array(self.cut)
        down, verdict = np.array(self.down), np.array(self.verdict)
        at = np.zeros(len(x), int)
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                return verdict[at]
            rows = np.flatnonzero(inner)
            node = at[rows]
            at[rows] = down[node, (x[rows, feature[node]] > cut[node]).astype(int)]


class Model:
    """Log odds of names and the tree, both of the labelled table (the same on every call)."""

    def __init__(self, pages: list[str]) -> None:
        self.odds = name_odds([b for p in pages for b in blocks(p)])
        found = [blocks(p, self.odds) for p in pages]
        self.tree = Tree(np.concatenate([block_features(b) for b in found]),
                         np.array([b[0].startswith("good") for page in found for b in page]))

    def judge(self, page: str) -> list[tuple[Block, bool]]:
        found = blocks(page, self.odds)
        return list(zip(found, self.tree.predict(block_features(found)).tolist()))


def train() -> Model:
    return Model(training_pages())


def main_text(page: str, model: Model) -> str:
    return " ".join(b[0] for b, keep in model.judge(page) if keep)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    source, model = pages.select("page_id", "url", "html"), train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), model) if h.is_valid else "" for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return small_batches(source).mapInArrow(run, StructType([
        source.schema["page_id"], source.schema["url"], StructField("text", StringType()), StructField("n_chars", LongType())]))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract_text(read_table(spark, sf_dir, "pages"))
