"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

A page becomes a tree of its block elements; each stretch of text between block boundaries is a leaf. Features of a
node: its kind, its attributes' words and those of its ancestors, depth, place among its siblings, text, link and
punctuation density of its subtree. The trees give each node the probability that its subtree holds main text, given
that its parent's does. Decoding takes the likeliest labels of the whole tree, in which none contradicts another:
below a node that is out, all is out (one pass from the leaves up, one down).

The trees are fitted on the driver, on a bounded sample of pages (``TRAIN_PAGES``, those with the smallest hashes of
their ids) in which ``article`` or ``main`` elements tell the text from the rest. Each of them is also set anew in
other layouts, with the same text and other wrappers, menus, notices, forms, side columns and comments, so that pages
without such elements can be told too.

Defined results: null and empty pages, and pages without text, give the empty text; unclosed and stray tags, cut-off
tags and references are taken as browsers do, as far as text goes; repeated rows each get their result; without pages
to learn from, all text outside of ``OUTSIDE`` elements is kept; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from html import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postloom.llm.common import small_batches, text_or_empty
from postloom.llm.gbt import Trees, fit

TRAIN_PAGES = 200
SETTINGS = 3
ROWS = 128

# Kinds of elements, and words of class, id and role attributes.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "select", "button", "object", "math", "xmp"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rt s samp small span strike strong sub sup time tt u var".split()
)
OUTSIDE = {"nav", "footer", "aside", "form", "header", "menu", "dialog"}
INSIDE = {"article", "main"}
KINDS = {
    "p": 0, "h1": 1, "h2": 1, "h3": 1, "h4": 1, "h5": 1, "h6": 1, "li": 2, "ul": 3, "ol": 3, "dl": 3, "menu": 3, "article": 4, "main": 4,
    "nav": 5, "footer": 6, "header": 7, "aside": 8, "form": 9, "fieldset": 9, "section": 10, "div": 11, "table": 12, "tr": 12, "td": 12,
    "blockquote": 13, "pre": 13, "figure": 14, "figcaption": 14, "#": 15,
}
GOOD = set("article body content entry main post prose story text page paragraph copy".split())
BAD = {
    w: k
    for k, words in enumerate(
        (
            "nav navigation navbar menu breadcrumb breadcrumbs pagination pager tabs toc",
            "ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion",
            "footer foot copyright legal header masthead topbar",
            "sidebar side aside widget related recommended trending popular more",
            "comment comments reply replies respondent disqus discussion reader",
            "cookie consent notice alert popup modal gdpr privacy overlay",
            "share social follow subscribe newsletter signup login form search",
        )
    )
    for w in words.split()
}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
NAMED = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
WIDE = 24 + len(KINDS)

_words: dict[str, tuple] = {}


def words_of(attributes: str) -> tuple:
    """(good words, bit for each family of bad words) of an element's attributes."""
    if "=" not in attributes:
        return 0, 0
    if attributes not in _words:
        if len(_words) > 50_000:
            _words.clear()
        good, bad = 0, 0
        for m in NAMED.finditer(attributes):
            for w in WORDS.findall(m[1] or m[2] or m[3] or ""):
                good += w.lower() in GOOD
                bad |= 1 << BAD[w.lower()] if w.lower() in BAD else 0
        _words[attributes] = (good, bad)
    return _words[attributes]


class Page:
    """Nodes in page order: kind, parent, depth, words; for leaves (kind ``#``) their text and its share in links."""

    def __init__(self, html: str):
        self.kind, self.parent, self.good, self.bad, self.text, self.linked = ["body"], [-1], [0], [0], [""], [0]
        stack = [("body", 0)]
        links, pieces, linked, at, n = 0, [], 0, 0, len(html)

        def flush() -> None:
            nonlocal pieces, linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self.add("#", stack[-1][1], 0, 0, text, linked)
                pieces, linked = [], 0

        while at < n:
            m = TOKEN.search(html, at)
            stop = m.start() if m else n
            if stop > at:
                piece = html[at:stop]
                pieces.append(unescape(piece) if "&" in piece else piece)
                if links:
                    linked += len(piece)
            if not m:
                break
            at = m.end()
            closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue
            name = name.lower()
            if closing:
                if name == "a":
                    links = max(0, links - 1)
                if name in INLINE or name in VOID:
                    continue
                flush()
                if name == "p" and not any(t == "p" for t, _ in stack):
                    continue
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        links = 0
                        break
                continue
            if name in RAW:
                pieces.append(" ")
                if not attributes.endswith("/") or name in ("script", "style", "title"):
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                    at = end.end() if end else n
            elif name == "br":
                pieces.append(" ")
            elif name == "a":
                links += 1
            elif name in INLINE:
                continue
            elif name in VOID:
                if name == "hr":
                    flush()
            elif name not in ("html", "body", "head"):
                flush()
                if stack[-1][0] == "p":
                    stack.pop()
                if name in CLOSES and stack[-1][0] in CLOSES[name]:
                    stack.pop()
                good, bad = words_of(attributes)
                stack.append((name, self.add(name, stack[-1][1], good, bad, "", 0)))
        flush()

    def add(self, kind: str, parent: int, good: int, bad: int, text: str, linked: int) -> int:
        for column, value in zip((self.kind, self.parent, self.good, self.bad, self.text, self.linked), (kind, parent, good, bad, text, linked)):
            column.append(value)
        return len(self.kind) - 1


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, parents, first node of each page) of all nodes of the pages, side by side."""
    sizes = np.array([len(p.kind) for p in pages])
    first = np.concatenate([[0], np.cumsum(sizes)])
    n = int(first[-1])
    parent = np.fromiter((q + f if q >= 0 else -1 for p, f in zip(pages, first.tolist()) for q in p.parent), "i8", n)
    kind = np.fromiter((KINDS.get(k, 16) for p in pages for k in p.kind), "i8", n)
    good = np.fromiter((g for p in pages for g in p.good), "i8", n)
    bad = np.fromiter((b for p in pages for b in p.bad), "i8", n)
    chars = np.fromiter((len(t) for p in pages for t in p.text), "f8", n)
    words = np.fromiter((t.count(" ") + 1 if t else 0 for p in pages for t in p.text), "f8", n)
    stops = np.fromiter((t.count(".") + t.count(",") if t else 0 for p in pages for t in p.text), "f8", n)
    linked = np.fromiter((x for p in pages for x in p.linked), "f8", n)
    up, ends, kinds = parent.tolist(), list(range(1, n + 1)), kind.tolist()
    d, gu, bu, ku = [0] * n, [0] * n, [0] * n, [0] * n
    goods, bads = good.tolist(), bad.tolist()
    children = [0] * n
    same: dict[tuple[int, int], int] = {}
    nth = [0] * n
    for i, q in enumerate(up):
        if q >= 0:
            d[i], gu[i], bu[i], ku[i] = d[q] + 1, gu[q] + goods[q], bu[q] | bads[q], ku[q] | 1 << kinds[q]
            nth[i] = children[q]
            children[q] += 1
            same[q, kinds[i]] = same.get((q, kinds[i]), 0) + 1
    for i in range(n - 1, -1, -1):
        q = up[i]
        if q >= 0 and ends[i] > ends[q]:
            ends[q] = ends[i]
    end, depth, good_up, bad_up, kinds_up = (np.array(x) for x in (ends, d, gu, bu, ku))
    place, kids = np.array(nth, "f8"), np.array(children, "f8")
    siblings = np.where(parent >= 0, kids[parent], 1)
    alike = np.fromiter((same.get((q, k), 1) for q, k in zip(up, kinds)), "f8", n)

    def subtree(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(x)])
        return total[end] - total[np.arange(n)]

    of_page = np.repeat(np.arange(len(pages)), sizes)
    all_chars = np.maximum(1, subtree(chars)[first[:-1]])[of_page]
    c, w = subtree(chars), subtree(words)
    leaves = subtree((kind == 15).astype("f8"))
    nodes = (end - np.arange(n)).astype("f8")
    before = np.concatenate([[0], np.cumsum(chars)])[:-1]
    before = before - before[first[:-1]][of_page]
    inside = (kinds_up >> 4 & 1) + (kind == 4)
    outside = ((kinds_up >> 5 & 0b11111) != 0) | ((kind >= 5) & (kind <= 9))
    columns = [
        depth, place, siblings, place / np.maximum(1, siblings - 1), alike / siblings, np.log1p(c), c / all_chars, subtree(linked) / np.maximum(1, c),
        np.log1p(nodes), c / nodes, w / np.maximum(1, leaves), subtree(stops) / np.maximum(1, w), before / all_chars, good, good_up,
        bad != 0, bad_up != 0, inside, outside, bad >> 4 & 1, bad_up >> 4 & 1, kids, np.log1p(c / np.maximum(1, leaves)), np.log1p(nodes[np.maximum(parent, 0)]),
    ]
    columns += [kind == k for k in range(len(KINDS))]
    return np.stack([np.asarray(x, "f8") for x in columns], 1), parent, first


def decode(p: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The likeliest labels, given each node's probability of being in if its parent is; below an out node all is out."""
    p = np.clip(p, 1e-6, 1 - 1e-6)
    into, out, up = np.log(p).tolist(), np.log(1 - p).tolist(), parent.tolist()
    for i in range(len(up) - 1, -1, -1):  # children come after their parents
        if up[i] >= 0:
            into[up[i]] += max(into[i], out[i])
    keep = [False] * len(up)
    for i, q in enumerate(up):
        keep[i] = into[i] > out[i] and (q < 0 or keep[q])
    return np.array(keep, bool)


def known_labels(page: Page) -> list[int] | None:
    """Labels of the nodes of a page whose elements tell the text from the rest; None for others."""
    n = len(page.kind)
    inside, outside, label = [False] * n, [False] * n, [0] * n
    for i in range(1, n):
        q = page.parent[i]
        inside[i] = inside[q] or page.kind[i] in INSIDE
        outside[i] = (outside[q] and page.kind[i] not in INSIDE) or page.kind[i] in OUTSIDE or page.bad[i] != 0
        label[i] = int(page.kind[i] == "#" and inside[i] and not outside[i])
    for i in range(n - 1, 0, -1):
        label[page.parent[i]] |= label[i]
    return label if label[0] and not all(label) else None


def pick(rng: random.Random, names: str) -> str:
    """A class or id attribute with one of ``names``, or none."""
    name = rng.choice(names.split()) + rng.choice(("", "", "-wrap", "_1", "-box"))
    return rng.choice((f' class="{name}"', f' id="{name}"', f' class="x1 {name}"')) if names else ""


def set_anew(rng: random.Random, texts: list[str], others: list[str]) -> tuple[str, set[str]]:
    """A page in a made-up layout, and its main texts; ``others`` are texts for what is around."""
    say = lambda k: " ".join(rng.choice(others) for _ in range(k))[: rng.choice((40, 120, 400))]
    links = lambda k: "".join(f'<li><a href="/{i}">{escape(say(1)[:18])}</a></li>' for i in range(k))
    # Only what its links or its element tell apart may lack the attribute.
    plain = lambda tag, inner: tag not in ("div", "li", "article", "section", "ol") or inner.count("<a") > 2
    block = lambda tag, names, inner: f"<{tag}{'' if plain(tag, inner) and rng.random() < 0.15 else pick(rng, names)}>{inner}</{tag}>"
    paragraph = lambda t: rng.choice(("<p>{}</p>", "<p>{}", "<div>{}</div>", "<p><b>{}</b></p>", "<blockquote><p>{}</p></blockquote>", "<p>{}</p>", "<p>{}</p>")).format(escape(t))
    main = "".join(paragraph(t) for t in texts)
    if rng.random() < 0.6:
        main = f"<h1>{escape(texts[0][:60])}</h1>" + main
    ad = lambda: block("div", "ad advert banner sponsored promo", escape(say(1)))
    if rng.random() < 0.3:
        cut = main.rfind("<p>")
        main = main[:cut] + ad() + main[cut:] if cut > 0 else main
    tag, names = rng.choice((("article", ""), ("main", ""), ("div", "content article post entry story main text"), ("section", "content article-body post-body"), ("article", "post entry"), ("div", ""), ("", "")))
    main = f"<{tag}{pick(rng, names) if names else ''}>{main}</{tag}>" if tag else main
    if rng.random() < 0.4:
        main = f"<div>{main}</div>"
    top = [block(rng.choice(("header", "div")), "header masthead topbar", escape(say(1)[:40])), block(rng.choice(("nav", "div", "div")), "nav menu navbar breadcrumb", f"<ul>{links(rng.randint(3, 9))}</ul>")]
    top += [ad(), block("div", "cookie notice consent alert popup", f"<p>{escape(say(1))}</p>")]
    comments = "".join(block(rng.choice(("div", "li", "article")), "comment reply", f"<p>{escape(say(2))}</p>") for _ in range(rng.randint(1, 6)))
    low = [block(rng.choice(("section", "div", "ol")), "comments discussion replies", f"<h3>{escape(say(1)[:20])}</h3>{comments}")]
    low += [block(rng.choice(("aside", "div")), "sidebar related widget trending", f"<h3>{escape(say(1)[:20])}</h3><ul>{links(rng.randint(2, 8))}</ul><p>{escape(say(1))}</p>")]
    low += [f"<form{pick(rng, 'newsletter search login signup')}><label>{escape(say(1)[:30])}</label><input><p>{escape(say(1))}</p></form>", block("div", "share social follow", links(3)), ad()]
    around = [x for x in top if rng.random() < 0.7], [x for x in low if rng.random() < 0.6]
    for x in around:
        rng.shuffle(x)
    foot = block(rng.choice(("footer", "footer", "div")), "footer copyright legal", escape("© " + say(1)))
    if rng.random() < 0.1:
        around, foot = ([], []), ""
    return f"<html><body>{''.join(around[0])}{main}{''.join(around[1])}{foot}</body></html>", {" ".join(t.split()) for t in [*texts, texts[0][:60]]}


def learn(htmls: list[str]) -> Trees:
    """Trees for the nodes of pages that can be told, as they are and set anew."""
    rng = random.Random(11)
    pages, labels = [], []
    told = [(p, y) for p in map(Page, htmls) if (y := known_labels(p))]
    others = [t for p, y in told for t, keep in zip(p.text, y) if t and not keep]
    for page, label in told:
        pages.append(page)
        labels.append(label)
        texts = [t for t, keep in zip(page.text, label) if t and keep]
        for _ in range(SETTINGS):
            html, main = set_anew(rng, texts, others + texts[:1])
            made = Page(html)
            y = [0] * len(made.kind)
            for i in range(len(y) - 1, 0, -1):
                if made.kind[i] == "#":
                    up, outside = made.parent[i], False
                    while up > 0:
                        outside |= made.bad[up] != 0 or made.kind[up] in OUTSIDE
                        up = made.parent[up]
                    y[i] = int(made.text[i] in main and not outside)
                y[made.parent[i]] |= y[i]
            pages.append(made)
            labels.append(y)
    if not pages:
        return fit(np.zeros((0, WIDE)), np.zeros(0))
    x, parent, _ = features(pages)
    y = np.concatenate(labels)
    asked = (parent < 0) | (y[parent] == 1)  # nothing is asked below an out node
    return fit(x[asked], y[asked].astype("f8"), trees=50, depth=5, rate=0.2)


def texts_of(htmls: list[str], trees: Trees) -> list[str]:
    """Main texts of pages."""
    pages = list(map(Page, htmls))
    x, parent, first = features(pages)
    if len(trees.roots) > 1:
        keep = decode(trees.predict(x), parent)
    else:
        keep = x[:, 18] == 0
    return [" ".join(t for t, k in zip(p.text, keep[a : a + len(p.kind)]) if t and k) for p, a in zip(pages, first.tolist())]


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> Trees:
    """Trees from a bounded sample; only the ids of candidates, not their pages, are ranked."""
    rows = pages.select("page_id", "html").where(F.col("html").isNotNull() & (F.length("html") < 1 << 17))
    ids = rows.select("page_id").distinct().where(F.col("page_id").isNotNull())
    ids = [r.page_id for r in ids.orderBy(F.xxhash64("page_id"), "page_id").limit(train_pages).collect()]
    found = {r.page_id: r.html for r in rows.where(F.col("page_id").isin(ids)).groupBy("page_id").agg(F.min("html").alias("html")).collect()}
    return learn([found[i] for i in ids])


def extract(pages: DataFrame, trees: Trees, html: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with the main text of ``html``."""
    small_batches(pages.sparkSession)

    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(column), ROWS):
            out += texts_of(column.slice(at, ROWS).to_pylist(), trees)
        return pa.array(out, pa.string())

    return pages.withColumn(out, of(text_or_empty(html)))


def report(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars."""
    made = extract(pages.select("page_id", "url", "html"), train(pages))
    return made.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))
