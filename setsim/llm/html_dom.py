"""Pages as node tables: a forgiving tag scanner and the statistics of each node."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import numpy as np

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)", re.S)
_ATTR = re.compile(r"(?P<name>[^\s\"'>/=]+)(?:\s*=\s*(?:\"(?P<dq>[^\"]*)\"|'(?P<sq>[^']*)'|(?P<bare>[^\s\"'>]+)))?")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
#: Elements that never hold visible article text.
SILENT = frozenset("script style title textarea iframe noembed noframes template head select option "
                   "button object audio video canvas".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table "
                  "tbody td tfoot th thead tr ul caption".split())
#: A start tag ends an open element of these names, up to a boundary.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",), "thead": ("tbody",), "tbody": ("thead", "tbody"), "body": ("head",)}
#: What leaves an open head open.
_HEAD = frozenset("title meta link style script base basefont bgsound template noscript noframes".split())
#: What an end tag does not close across, unless it is one of these itself.
_CELLS = frozenset(("td", "th", "table"))
_STRUCTURE = frozenset(("table", "tbody", "thead", "tr", "td", "th", "body", "html"))
_SCOPE = frozenset("html body div section article main aside nav header footer table ul ol dl td th form fieldset "
                   "blockquote li figure".split())

GROUPS = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumb pagination pager topnav toc tabs links skip",
    "ad": "ad ads advert advertisement adsense banner promo promoted sponsor sponsored sponsors dfp outbrain taboola",
    "side": "sidebar side aside rail widget widgets related recommended trending popular teaser more",
    "note": "cookie cookies consent notice alert popup modal overlay newsletter subscribe subscription paywall gdpr toast",
    "talk": "comment comments commenter disqus reply replies discussion respond reviews",
    "share": "share sharing social follow twitter facebook whatsapp tags tag byline meta author",
    "form": "form login signup search searchbox input contact",
    "head": "header head masthead topbar top logo brand hero",
    "foot": "footer foot bottom copyright legal colophon credits",
    "body": "article content main post entry story body text page maincontent articlebody prose blog single",
}
_GROUP_OF = {token: name for name, tokens in GROUPS.items() for token in tokens.split()}
_GROUP_NO = {name: k for k, name in enumerate(GROUPS)}
TAGS = ("p", "h", "li", "a", "div", "section", "article", "main", "nav", "aside", "header", "footer", "form", "list",
        "table", "cell", "span", "strong", "body", "control", "figure", "quote", "other")
_TAG_OF = {"p": "p", "li": "li", "a": "a", "div": "div", "section": "section", "article": "article", "main": "main",
           "nav": "nav", "aside": "aside", "header": "header", "footer": "footer", "form": "form", "ul": "list", "ol": "list",
           "dl": "list", "menu": "list", "table": "table", "td": "cell", "th": "cell", "span": "span", "b": "strong",
           "strong": "strong", "em": "strong", "i": "strong", "u": "strong", "body": "body", "html": "body",
           "label": "control", "input": "control", "fieldset": "control", "button": "control", "figure": "figure",
           "figcaption": "figure", "blockquote": "quote", "pre": "quote", "code": "quote"}
_TAG_OF |= {f"h{k}": "h" for k in range(1, 7)}
_TAG_NO = {name: k for k, name in enumerate(TAGS)}


@dataclass
class Page:
    """Nodes in page order (parents first), and the pieces of text."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["html"])
    groups: list[frozenset] = field(default_factory=lambda: [frozenset()])
    hidden: list[bool] = field(default_factory=lambda: [False])
    marks: list[str] = field(default_factory=lambda: [""])
    texts: list[tuple[int, int, str]] = field(default_factory=list)  # node, block number, decoded text


def _attributes(raw: str) -> tuple[frozenset, bool, str]:
    groups, hidden, mark = set(), False, ""
    for m in _ATTR.finditer(raw):
        name, value = m["name"].lower(), m["dq"] or m["sq"] or m["bare"] or ""
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            groups.update(_GROUP_OF[t] for t in map(str.lower, _TOKEN.findall(value)) if t in _GROUP_OF)
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
        elif name == "data-mark":
            mark = value
    return frozenset(groups), hidden, mark


def parse(html: str) -> Page:
    """The node table of a page, whatever its markup."""
    page, stack, block, at = Page(), [0], 0, 0
    silent = 0  # open elements whose text is not shown

    def say(raw: str) -> None:
        if raw and not raw.isspace() and page.tag[stack[-1]] == "head":
            pop()
        if silent or not raw:
            return
        if not raw.isspace():
            page.texts.append((stack[-1], block, unescape(raw)))
        elif page.texts and page.texts[-1][1] == block:
            page.texts.append((stack[-1], block, " "))

    def pop() -> None:
        nonlocal silent
        silent -= page.tag[stack.pop()] in SILENT

    def close(names: tuple, scope: frozenset) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            name = page.tag[stack[depth]]
            if name in names:
                while len(stack) > depth:
                    pop()
                return
            if name in scope:
                return

    while (m := _MARKUP.search(html, at)) is not None:
        say(html[at:m.start()])
        at = m.end()
        if m["tag"] is None:
            continue
        if html[at:at + 1] != ">":  # a quote that never closes
            at = html.find(">", at)
            at = len(html) if at < 0 else at
        at += 1
        tag = m["tag"].lower()
        if tag in BLOCK:
            block += 1
        if m["close"]:
            close((tag,), frozenset() if tag in _STRUCTURE else _CELLS)
            continue
        if tag == "html":
            continue
        if page.tag[stack[-1]] == "head" and tag not in _HEAD:
            pop()
        if tag in BLOCK:
            close(("p",), _SCOPE)
        if tag in _ENDS:
            close(_ENDS[tag], frozenset(("ul", "ol", "dl", "table", "select")))
        if tag == "br":
            if page.texts and page.texts[-1][1] == block:
                page.texts.append((stack[-1], block, " "))
            continue
        groups, hidden, mark = _attributes(m["attrs"])
        page.parent.append(stack[-1])
        page.tag.append(tag)
        page.groups.append(groups)
        page.hidden.append(hidden)
        page.marks.append(mark)
        if tag in VOID or m["attrs"].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A).search(html, at)
            at = len(html) if end is None else end.start()
        silent += tag in SILENT
        stack.append(len(page.tag) - 1)
    say(html[at:])
    return page


FEATURES = len(TAGS) * 2 + len(GROUPS) * 2 + 24


def node_features(page: Page) -> np.ndarray:
    """Per node: tag and attribute groups (own and inherited), subtree density,
    links, depth, place among siblings and on the page."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own, words, stops, pieces = (np.zeros(n) for _ in range(4))
    first = np.full(n, np.inf)
    seen = 0.0
    for node, _, text in page.texts:
        size = len(text.strip())
        own[node] += size
        words[node] += len(text.split())
        stops[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
        pieces[node] += size > 0
        first[node] = min(first[node], seen)
        seen += size
    tags = np.array([_TAG_NO[_TAG_OF.get(t, "other")] for t in page.tag])
    link = np.where(tags == _TAG_NO["a"], 1.0, 0.0)
    total, total_words, total_stops, total_pieces = own.copy(), words.copy(), stops.copy(), pieces.copy()
    link_text, inner, paragraphs = np.zeros(n), np.ones(n), (tags == _TAG_NO["p"]).astype(float)
    links, controls = link.copy(), (tags == _TAG_NO["control"]).astype(float)
    kids, index, same = np.zeros(n), np.zeros(n), np.zeros(n)
    depth = np.zeros(n)
    up_tags, up_groups = np.zeros((n, len(TAGS)), bool), np.zeros((n, len(GROUPS)), bool)
    mine = np.zeros((n, len(GROUPS)), bool)
    for i, groups in enumerate(page.groups):
        for g in groups:
            mine[i, _GROUP_NO[g]] = True
    kin: dict = {}
    for i in range(1, n):
        p = parent[i]
        depth[i], index[i] = depth[p] + 1, kids[p]
        kids[p] += 1
        kin[p, tags[i]] = kin.get((p, tags[i]), 0) + 1
        up_tags[i], up_groups[i] = up_tags[p], up_groups[p] | mine[p]
        up_tags[i, tags[p]] = True
    for i in range(n - 1, 0, -1):
        p = parent[i]
        link_text[i] = total[i] if link[i] else link_text[i]
        for a in (total, total_words, total_stops, total_pieces, link_text, inner, paragraphs, links, controls):
            a[p] += a[i]
        first[p] = min(first[p], first[i])
    for i in range(1, n):
        same[i] = kin[parent[i], tags[i]]
    page_text = max(1.0, total[0])
    safe = np.maximum(total, 1)
    up = np.maximum(parent, 0)
    x = np.zeros((n, FEATURES), np.float32)
    x[np.arange(n), tags] = 1
    k = len(TAGS)
    x[:, k:2 * k] = up_tags
    x[:, 2 * k:2 * k + len(GROUPS)] = mine
    x[:, 2 * k + len(GROUPS):2 * k + 2 * len(GROUPS)] = up_groups
    density = total / inner
    x[:, -24:] = np.stack([
        np.log1p(own), np.log1p(total), np.log1p(density), link_text / safe, total_stops / np.maximum(total_words, 1),
        total_words / np.maximum(total_pieces, 1), np.log1p(paragraphs), np.log1p(links), np.log1p(controls), depth,
        np.log1p(inner), total / page_text, np.where(np.isfinite(first), first, seen) / page_text, index,
        index / np.maximum(kids[up], 1), kids[up], same / np.maximum(kids[up], 1), kids, np.log1p(density[up]),
        link_text[up] / safe[up], np.log1p(paragraphs[up]), np.array(page.hidden, float), total[up] / page_text,
        np.arange(n) / n], axis=1)
    return x


def extract(page: Page, keep: np.ndarray) -> str:
    """The text of the kept nodes: one line for each block."""
    lines, current, parts = [], None, []
    for node, block, text in page.texts:
        if block != current:
            lines.append(" ".join("".join(parts).split()))
            current, parts = block, []
        parts.append(text if keep[node] else " ")
    lines.append(" ".join("".join(parts).split()))
    return "\n".join(line for line in lines if line)
