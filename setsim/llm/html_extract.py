"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every node gets a log-odds of belonging to the article from trees over its
subtree density, attribute tokens, depth, sibling and page statistics.  Decoding
is hierarchical: a node can stay only if its parent stays, and the kept set is
the one of greatest total log-odds under that rule, found bottom-up; so no
ancestor and descendant contradict each other.

The trees are fitted on ``n_pages`` pages that a small seeded grammar writes with
known article nodes: semantic tags or plain containers, telling or meaningless
class names, menus, headers, sidebars, notices, adverts, forms, comments,
footers, and sloppy markup.  Every row's whole page is scored.

Defined results: a null or empty page, or one without kept text, gives an empty
text; markup that never closes ends with the page; repeated rows are each judged
alone; extra columns pass through unless named ``text`` or ``n_chars``, which
the result replaces.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setsim.llm.common import row_slices, small_batches
from setsim.llm.html_dom import Page, extract, node_features, parse

N_PAGES = 400
DEPTH = 4
BINS = 32


# -- training pages -----------------------------------------------------------

class _Writer:
    """Random pages; ``data-mark`` says where the article starts and what is cut out of it."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.r
        parts = ["".join(r.choice("abcdefghilmnoprstuvé") for _ in range(r.randint(2, 9))) for _ in range(r.randint(low, high))]
        text = " ".join(w + ("," if r.random() < 0.08 else ".$&#"[r.randrange(4)] if r.random() < 0.06 else "") for w in parts)
        return text.capitalize() + ("." if r.random() < 0.8 else "")

    def name(self, *names: str) -> str:
        r = self.r
        kind = r.random()
        if kind < 0.25:
            return ""
        if kind < 0.45:
            return f' class="{"".join(r.choice("bcdfgkpqvxz0123") for _ in range(5))}"'
        return f' {r.choice(["class", "id"])}="{r.choice(names)}"'

    def box(self, tags: tuple, names: tuple, body: str, mark: str = "") -> str:
        tag = self.r.choice(tags)
        extra = f' data-mark="{mark}"' if mark else ""
        named = self.name(*names) if tag in ("div", "section", "ul", "p") else ""
        return f"<{tag}{named}{extra}>{body}</{tag}>"

    def links(self) -> str:
        r = self.r
        items = [f'<a href="/{r.randrange(99)}">{self.words(1, 3)}</a>' for _ in range(r.randint(2, 9))]
        form = r.random()
        return "<ul>" + "".join(f"<li>{a}</li>" for a in items) + "</ul>" if form < 0.6 else " | ".join(items) if form < 0.8 \
            else "".join(f"<p>{a}</p>" for a in items)

    def menu(self) -> str:
        return self.box(("nav", "div", "ul", "nav"), ("menu", "main-nav", "breadcrumb", "topnav"), self.links())

    def advert(self, mark: str = "") -> str:
        return self.box(("div", "aside", "div"), ("ad", "advert", "banner", "promo-box", "sponsored"),
                        self.words(3, 14) if self.r.random() < 0.8 else f"<p>{self.words(3, 12)}</p>", mark)

    def notice(self, mark: str = "") -> str:
        return self.box(("div", "section"), ("cookie-notice", "newsletter", "alert", "consent", "popup"),
                        f"<p>{self.words(6, 22)}</p><button>{self.words(1, 2)}</button>", mark)

    def form(self, mark: str = "") -> str:
        return f'<form{f" data-mark={mark}" if mark else ""}><label>{self.words(1, 3)}</label><input name="q">' \
               f"<p>{self.words(2, 8)}</p><button>{self.words(1, 1)}</button></form>"

    def comments(self) -> str:
        one = lambda: f'<div{self.name("comment", "reply")}><b>{self.words(1, 2)}</b><p>{self.words(4, 40)}</p></div>'
        return self.box(("section", "div"), ("comments", "comment-list", "disqus", "discussion"),
                        f"<h3>{self.words(1, 3)}</h3>" + "".join(one() for _ in range(self.r.randint(1, 5))))

    def sidebar(self) -> str:
        return self.box(("aside", "div"), ("sidebar", "side-col", "related", "widget"),
                        f"<h4>{self.words(1, 3)}</h4>" + (self.links() if self.r.random() < 0.6 else f"<p>{self.words(5, 30)}</p>"))

    def header(self) -> str:
        return self.box(("header", "div"), ("header", "masthead", "top", "site-header"),
                        self.words(1, 5) + (self.links() if self.r.random() < 0.5 else f"<h2>{self.words(1, 4)}</h2>"))

    def footer(self) -> str:
        return self.box(("footer", "div", "footer"), ("footer", "site-footer", "bottom", "copyright"),
                        "&copy; " + self.words(3, 16) + (self.links() if self.r.random() < 0.3 else ""))

    def article(self) -> str:
        r = self.r
        parts = [f"<h1>{self.words(1, 12)}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            text = self.words(1, r.choice([2, 6, 60, 150]))
            if kind < 0.6:
                close = "</p>" if r.random() < 0.9 else ""
                parts.append(f"<p>{text}{close}" if r.random() < 0.8 else f"<p><b>{text}<br>" if r.random() < 0.6
                             else f'<p>{text} <a href="#">{self.words(1, 3)}</a> <em>{self.words(1, 4)}</em> {self.words(1, 30)}</p>')
            elif kind < 0.67:
                parts.append(f"<h2>{self.words(1, 6)}</h2>")
            elif kind < 0.73:
                parts.append("<ul>" + "".join(f"<li>{self.words(2, 14)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.79:
                quote = self.words(2, 40)
                parts.append(f"<blockquote>{quote if r.random() < 0.5 else f'<p>{quote}</p>'}</blockquote>")
            elif kind < 0.83:
                cells = lambda: "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(2))
                parts.append("<table>" + "".join(f"<tr>{cells()}</tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif kind < 0.86:
                parts.append(f"<pre>{self.words(1, 20)}</pre>")
            elif kind < 0.9:
                parts.append(f'<figure><img src="x"><figcaption>{self.words(2, 14)}</figcaption></figure>')
            elif kind < 0.93:
                parts.append(f"<{(t := r.choice(('div', 'section')))}><h3>{self.words(1, 5)}</h3><p>{text}</p></{t}>")
            else:
                parts.append(r.choice((self.advert, self.notice, self.form))("out"))
        if r.random() < 0.12:  # no container at all
            return "".join(p if 'data-mark="out"' in p or "data-mark=out" in p else re.sub(r"^<(\w+)", r'<\1 data-mark="in"', p)
                           for p in parts)
        return self.box(("article", "main", "div", "article", "section"),
                        ("article", "content", "post-body", "entry-content", "story", "main-text"), "".join(parts), "in")

    def page(self) -> str:
        r = self.r
        maybe = lambda p, f: [f()] if r.random() < p else []
        before = maybe(0.5, self.header) + maybe(0.7, self.menu) + maybe(0.5, self.advert) + maybe(0.2, self.notice) + maybe(0.15, self.form)
        r.shuffle(before)
        core = maybe(0.2, self.sidebar) + [self.article()] + maybe(0.3, self.sidebar) + maybe(0.2, self.advert)
        core = "".join(core)
        if r.random() < 0.4:
            core = self.box(("div", "section", "main"), ("wrapper", "page", "container", "row"), core)
        after = maybe(0.35, self.comments) + maybe(0.2, self.notice) + maybe(0.2, self.menu) + maybe(0.15, self.form) + maybe(0.7, self.footer)
        end = "</body></html>" if r.random() < 0.9 else ""
        return f"<html><head><title>{self.words(2, 9)}</title></head><body>{''.join(before)}{core}{''.join(after)}{end}"


def node_labels(page: Page) -> np.ndarray:
    """1 for nodes of the marked article and for what holds them."""
    y = np.zeros(len(page.tag), np.int64)
    for i in range(1, len(y)):
        y[i] = {"in": 1, "out": 0}.get(page.marks[i], y[page.parent[i]])
    for i in range(len(y) - 1, 0, -1):
        if y[i]:
            y[page.parent[i]] = 1
    return y


# -- boosted trees --------------------------------------------------------------

@dataclass
class Trees:
    """Complete binary trees: per tree the feature and threshold of inner nodes, the values of leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - len(feature)]
        return out


def boost(x: np.ndarray, y: np.ndarray, n_trees: int = 60, rate: float = 0.3, ridge: float = 2.0) -> Trees:
    """Gradient boosting of the logistic loss with histogram splits."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    inner, leaves, d = 2 ** DEPTH - 1, 2 ** DEPTH, x.shape[1]
    base = float(np.log(y.mean() / (1 - y.mean())))
    score = np.full(len(y), base)
    feature, threshold, value = [], [], []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        f, t, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            low, width = 2 ** depth - 1, 2 ** depth
            slot = (at - low) * BINS
            gains = np.zeros((d, width, BINS))
            for j in range(d):
                cell = slot + binned[:, j]
                gs = np.bincount(cell, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                hs = np.bincount(cell, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                gains[j] = gs ** 2 / (hs + ridge) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + ridge)
            for k in range(width):
                j, cut = divmod(int(gains[:, k, :-1].argmax()), BINS - 1)
                if cut < len(edges[j]):
                    f[low + k], t[low + k] = j, edges[j][cut]
            at = 2 * at + 1 + (x[np.arange(len(y)), f[at]] > t[at])
        leaf = at - inner
        v = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        score += v[leaf]
        feature.append(f)
        threshold.append(t)
        value.append(v)
    return Trees(np.array(feature), np.array(threshold), np.array(value), base)


def fit_trees(n_pages: int = N_PAGES, seed: int = 5) -> Trees:
    writer = _Writer(seed)
    pages = [parse(writer.page()) for _ in range(n_pages)]
    return boost(np.concatenate([node_features(p) for p in pages]), np.concatenate([node_labels(p) for p in pages]))


# -- decoding -------------------------------------------------------------------

def decode(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """The set of nodes, closed under parents, of the greatest total log-odds."""
    worth = log_odds.copy()
    for i in range(len(worth) - 1, 0, -1):
        if worth[i] > 0:
            worth[page.parent[i]] += worth[i]
    keep = np.zeros(len(worth), bool)
    keep[0] = worth[0] > 0
    for i in range(1, len(worth)):
        keep[i] = worth[i] > 0 and keep[page.parent[i]]
    return keep


def extract_text(pages: DataFrame, trees: Trees | None = None, *, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points)."""
    trees = fit_trees() if trees is None else trees
    small_batches(pages.sparkSession)
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in row_slices(batches, html_col):
            parsed = [parse(h.decode("utf-8", "replace")) if h else Page() for h in raw]
            odds = trees.log_odds(np.concatenate([node_features(p) for p in parsed]))
            ends = np.cumsum([len(p.tag) for p in parsed])
            texts = [extract(p, decode(p, odds[e - len(p.tag):e])) for p, e in zip(parsed, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in kept), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], [*kept, "text", "n_chars"])

    source = pages.select(*kept)
    schema = T.StructType([*source.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return source.mapInArrow(run, schema)


def extraction_digest(pages: DataFrame) -> DataFrame:
    """The per-page report of the registered query."""
    return extract_text(pages.select("page_id", "url", "html")).select("page_id", "url", F.col("text"), "n_chars")
