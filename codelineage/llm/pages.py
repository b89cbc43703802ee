"""Main text of web pages by a tree-structured graphical model.

Block elements of a page are the nodes of a tree. A node is content or not; potentials of its own
features and of parent and child together form a conditional random field, whose exact marginals come from
sum-product messages passed up and down the tree. The weights are fitted by maximum likelihood to labelled pages.
Pages are worked on where they are read; only the weights are shipped.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard by their part in the tree.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var br wbr img audio canvas map object optgroup option video".split())
# MathML, whose text stands in a line.
_MATH = frozenset(
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
# Elements without text of the page, with all they hold.
_DROPPED = frozenset("template svg select button datalist annotation annotation-xml".split())
# What may stand in a head; anything else ends it.
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
_RAW = frozenset("script style textarea title noscript iframe noframes".split())
# An element of the first names ends an open one of the second when it begins.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|y)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HINT = re.compile(r"[a-zA-Z][a-z]*|[A-Z]+")
_AWAY = re.compile(
    r"nav|menu|foot|header|masthead|side|aside|banner|cookie|consent|gdpr|notice|alert|advert|sponsor|promo|comment|repl|disqus|"
    r"share|social|related|recommend|newsletter|subscri|signup|login|form|search|breadcrumb|pagin|widget|popup|modal|toolbar|"
    r"copyright|legal|skip|hidden|contentinfo|complementary|(?:ad|ads|adv)$", re.I)
_TOWARDS = re.compile(r"article|content|main|post|entry|story|body|text|prose", re.I)

_TAG_GROUPS = {"h1": "h1"} | {f"h{i}": "h" for i in range(2, 7)} | {t: t for t in (
    "article main nav header footer aside form section div p ul ol li table td body blockquote pre figure figcaption dl dialog "
    "fieldset address details").split()}
_GROUPS = 3  # of child elements with potentials of their own: text, containers, lists and tables


@dataclass
class Page:
    """Block elements in page order (a parent before its children) and the texts they hold."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["body"])
    hints: list[tuple[bool, bool]] = field(default_factory=lambda: [(False, False)])
    label: list[int] = field(default_factory=lambda: [0])
    texts: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters of links


_DROPPED_TAG = re.compile(rf"<(/?)({'|'.join(sorted(_DROPPED, key=len, reverse=True))})(?=[\s/>])", re.I)


class _Open:
    """Open elements from the page down, found by name in logarithmic time."""

    def __init__(self):
        self.nodes, self.names, self.places = [0], ["body"], defaultdict(list)

    def push(self, node: int, name: str) -> None:
        self.places[name].append(len(self.nodes))
        self.nodes.append(node)
        self.names.append(name)

    def cut(self, at: int) -> None:
        """Close the elements from place ``at`` on."""
        while len(self.nodes) > at:
            self.nodes.pop()
            self.places[self.names.pop()].pop()

    def last(self, names) -> int:
        return max((self.places[x][-1] for x in names if self.places[x]), default=0)

    def first_behind(self, names, low: int) -> int | None:
        found = [self.places[x][i] for x in names if (i := bisect_left(self.places[x], low + 1)) < len(self.places[x])]
        return min(found, default=None)


def parse(source: str) -> Page:
    """The page's tree; elements left open end where the standard ends them, stray ends are ignored.

    A head ends at the first thing that cannot stand in it. A dropped element (form controls, drawings, templates) takes what it
    holds along up to its end; one that is never ended, or not before the next of its name, takes along the text up to the next block
    only. The time is linear in the page, however deep its elements nest.
    """
    page, open_ = Page(), _Open()
    pieces: list[str] = []
    linked, in_link, in_head, at, n = 0, False, False, 0, len(source)
    # Of each dropped name the places of its starts and ends; the one that is open now, and whether a block ends it.
    tags = defaultdict(lambda: ([], []))
    for m in _DROPPED_TAG.finditer(source):
        tags[m[2].lower()][bool(m[1])].append(m.start())
    dropped, loose = "", False

    def close_text():
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                page.texts.append((open_.nodes[-1], text, linked))
        linked = 0

    def unending(name, place):
        starts, ends = tags[name]
        i, j = bisect_left(starts, place), bisect_left(ends, place)
        return j == len(ends) or i < len(starts) and starts[i] < ends[j]

    while at < n:
        mark = source.find("<", at)
        m = _TOKEN.match(source, mark) if mark >= 0 else None
        end = n if mark < 0 else mark if m else mark + 1
        if end > at and not dropped:
            if in_head and source[at:end].strip():
                in_head = False
            pieces.append(source[at:end])
            if in_link:
                linked += end - at
        if not m:
            at = end
            continue
        at = m.end()
        ending, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name in _RAW and not ending:
            # Raw text up to its own end; its content is no markup.
            close = re.compile(f"</{name}\\b[^>]*>", re.I).search(source, at)
            at = close.end() if close else n
            continue
        if name in _DROPPED and (not dropped or name == dropped):
            if ending:
                dropped = ""
            elif not rest.endswith("/") or name not in ("svg", "annotation", "annotation-xml"):
                dropped, loose = name, unending(name, at)
            continue
        block = name not in _INLINE and name not in _MATH and name not in _DROPPED
        if dropped:
            if not (loose and block):
                continue
            dropped = ""
        if in_head and (ending or name not in _IN_HEAD):
            in_head = False
        if name == "a":
            in_link = not ending
        if not block:
            if name == "br" or name == "img":
                pieces.append(" ")
            continue
        close_text()
        in_link = False
        if name == "head":
            in_head = not ending
        if name in ("html", "head", "body"):
            if name == "body" and not ending:
                page.label[0] = _label(rest, page.label[0])
            continue
        if ending:
            if open_.places[name]:
                open_.cut(open_.places[name][-1])
            continue
        if name in _VOID:
            continue
        if open_.names[-1] == "p" and len(open_.nodes) > 1:
            open_.cut(len(open_.nodes) - 1)
        if name in _ENDS:
            found = open_.first_behind(_ENDS[name], open_.last(_HOLDS[name]))
            if found is not None:
                open_.cut(found)
        hint = ""
        for a, *values in _ATTRIBUTE.findall(rest) if rest else ():
            if a != "y":
                hint += " " + (a if a.lower() == "hidden" else "".join(values))
        words = _HINT.findall(hint)
        page.hints.append((any(map(_AWAY.match, words)), any(map(_TOWARDS.match, words))))
        page.parent.append(open_.nodes[-1])
        page.tag.append(name)
        page.label.append(_label(rest, page.label[open_.nodes[-1]]))
        open_.push(len(page.parent) - 1, name)
    close_text()
    return page


def _label(attributes: str, otherwise: int) -> int:
    found = ["".join(values) for a, *values in _ATTRIBUTE.findall(attributes) if a == "y"] if attributes else []
    return int(found[-1] or 0) if found else otherwise


_NAMES = sorted(set(_TAG_GROUPS.values())) + ["other"]
FEATURES = {f: i for i, f in enumerate(
    [f"tag:{t}" for t in _NAMES] + ["bias", "away", "towards"]
    + [f"own:{i}" for i in range(5)] + [f"all:{i}" for i in range(5)] + [f"links:{i}" for i in range(4)]
    + ["sentence", "sign", "depth:1", "depth:2", "depth:3", "inside", "beside", "bare"])}


def _size(n: int) -> int:
    return 0 if n == 0 else 1 if n < 25 else 2 if n < 100 else 3 if n < 400 else 4


def features(page: Page) -> list[list[int]]:
    """The active features of every node."""
    n = len(page.parent)
    own, whole, links, depth, last = [0] * n, [0] * n, [0] * n, [0] * n, [""] * n
    for node, text, linked in page.texts:
        own[node] += len(text)
        links[node] += linked
        last[node] = text
    whole[:] = own
    for i in range(n - 1, 0, -1):
        whole[page.parent[i]] += whole[i]
        links[page.parent[i]] += links[i]
    # Containers that are marked as the article and hold text; what stands in them, and what stands beside them.
    inside, over = [False] * n, [False] * n
    for i in range(n):
        marked = page.tag[i] in ("article", "main") and whole[i] > 0 or page.hints[i][1] and whole[i] >= 25
        own_mark = marked and not page.hints[i][0] and i > 0
        inside[i] = own_mark or i > 0 and inside[page.parent[i]]
    for i in range(n - 1, 0, -1):
        over[page.parent[i]] |= over[i] or inside[i]
    out = []
    for i in range(n):
        if i:
            depth[i] = depth[page.parent[i]] + 1
        share = links[i] / max(1, whole[i])
        names = [f"tag:{_TAG_GROUPS.get(page.tag[i], 'other')}", "bias", f"own:{_size(own[i])}", f"all:{_size(whole[i])}",
                 f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.7 else 3}", f"depth:{min(3, max(1, depth[i]))}"]
        names.append("inside" if inside[i] else "bare" if not over[0] else "beside")
        if page.hints[i][0]:
            names.append("away")
        if page.hints[i][1]:
            names.append("towards")
        if last[i][-1:] in (".", "!", "?", "…", ":"):
            names.append("sentence")
        if "©" in last[i] or "@" in last[i]:
            names.append("sign")
        out.append([FEATURES[x] for x in names])
    return out


def _group(tag: str) -> int:
    return 0 if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption") else 2 if tag in (
        "ul", "ol", "li", "table", "tr", "td", "th", "tbody", "dl", "dt", "dd") else 1


@dataclass(frozen=True)
class Field:
    """Weights: of a feature for content, and of parent and child labels by the child's group."""

    own: list[float]
    pair: list[list[list[float]]]  # group, parent label, child label

    def beliefs(self, page: Page, active: list[list[int]]):
        """Marginals of every node, and of parent and child together, by messages up and down the tree."""
        n = len(page.parent)
        up = [[0.0, sum(self.own[f] for f in a)] for a in active]
        sent = [(0.0, 0.0)] * n
        groups = [_group(t) for t in page.tag]
        for i in range(n - 1, 0, -1):
            w, (a, b) = self.pair[groups[i]], up[i]
            sent[i] = tuple(_sum(a + w[y][0], b + w[y][1]) for y in (0, 1))
            mother = up[page.parent[i]]
            mother[0] += sent[i][0]
            mother[1] += sent[i][1]
        down = [(0.0, 0.0)] * n
        content, together = [0.0] * n, [None] * n
        for i in range(n):
            if i:
                w, mother = self.pair[groups[i]], page.parent[i]
                # What the parent says without what this child told it.
                rest = [up[mother][y] + down[mother][y] - sent[i][y] for y in (0, 1)]
                down[i] = tuple(_sum(rest[0] + w[0][y], rest[1] + w[1][y]) for y in (0, 1))
                joint = [[rest[x] + w[x][y] + up[i][y] for y in (0, 1)] for x in (0, 1)]
                top = _sum(_sum(*joint[0]), _sum(*joint[1]))
                together[i] = [[math.exp(v - top) for v in row] for row in joint]
            a, b = up[i][0] + down[i][0], up[i][1] + down[i][1]
            content[i] = 1 / (1 + math.exp(min(700.0, a - b)))
        return content, together

    def text(self, source: str | None, least: float = 0.5) -> str:
        """The texts of content nodes in page order."""
        page = parse(source or "")
        if not page.texts:
            return ""
        content, _ = self.beliefs(page, features(page))
        return "\n\n".join(text for node, text, _ in page.texts if content[node] >= least)


def _sum(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def learn(sources: list[str], rounds: int = 100, rate: float = 2.0, decay: float = 0.0003) -> Field:
    """Weights of greatest likelihood for pages whose elements carry their label in an attribute ``y``.

    An element without one has its parent's label. The gradient is the labels' features less their expectation.
    """
    pages = [parse(s) for s in sources]
    active = [features(p) for p in pages]
    own, pair = np.zeros(len(FEATURES)), np.zeros((_GROUPS, 2, 2))
    squares = [np.full_like(own, 1e-8), np.full_like(pair, 1e-8)]
    total = sum(len(p.parent) for p in pages)
    for _ in range(rounds):
        grad_own, grad_pair = -decay * total * own, -decay * total * pair
        field_ = Field(own.tolist(), pair.tolist())
        for page, rows in zip(pages, active, strict=True):
            content, together = field_.beliefs(page, rows)
            for i, row in enumerate(rows):
                grad_own[row] += page.label[i] - content[i]
                if i:
                    g = _group(page.tag[i])
                    grad_pair[g, page.label[page.parent[i]], page.label[i]] += 1
                    grad_pair[g] -= together[i]
        for weights, grad, seen in ((own, grad_own, squares[0]), (pair, grad_pair, squares[1])):
            seen += (grad / total) ** 2
            weights += rate * grad / total / np.sqrt(seen)
    return Field(own.tolist(), pair.tolist())


def labelled_pages(n: int = 90, seed: int = 5) -> list[str]:
    """Made pages in many layouts; the article's elements carry y=1, all others y=0."""
    rng = random.Random(seed)
    pick, chance = rng.choice, rng.random
    word = lambda: "".join(rng.choices("aeioulnrst", k=rng.randint(2, 8)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: words(4, 18).capitalize() + pick([".", ".", ".", "!", "?", "", ","])
    prose = lambda a, b: " ".join(sentence() for _ in range(rng.randint(a, b)))
    inline = lambda t: t if chance() < 0.7 else f'{t} <a href="/x">{words(1, 3)}</a> <b>{words(1, 3)}</b> {words(2, 6)}.'
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'

    def links(a, b):
        items = [link() for _ in range(rng.randint(a, b))]
        return pick(["<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", " | ".join(items), "".join(f"<p>{x}</p>" for x in items)])

    def block(names, classes, body):
        name = pick(names)
        own = pick(classes)
        return f'<{name}{pick([" class", " id"])}="{own}" y=0>{body}</{name}>' if own else f"<{name} y=0>{body}</{name}>"

    plain = lambda: prose(1, 3) if chance() < 0.6 else f"<p>{prose(1, 4)}</p>"
    parts = {
        "nav": lambda: block(["nav"], ["", "menu"], links(3, 8)) if chance() < 0.6 else block(["div", "ul"], ["nav", "main-menu", "navbar", "topMenu"], links(3, 8)),
        "header": lambda: block(["header"], ["", "page-header"], f"<h2>{words(1, 4)}</h2>" + links(0, 3)) if chance() < 0.6 else block(["div"], ["header", "site-header", "masthead"], words(1, 5)),
        "footer": lambda: block(["footer"], ["", "foot"], f"&copy; {word()}.org {plain()}") if chance() < 0.6 else block(["div"], ["footer", "page-footer", "copyright"], plain() + links(1, 4)),
        "aside": lambda: block(["aside"], ["", "sidebar"], f"<h3>{words(1, 3)}</h3>" + links(2, 5) + plain()) if chance() < 0.5 else block(["div", "section"], ["sidebar", "side-column", "related-posts", "widget"], f"<h3>{words(1, 3)}</h3>" + plain()),
        "ad": lambda: block(["div", "section"], ["ad", "ads", "advert", "sponsored", "promo-box", "ad-slot"], plain()),
        "notice": lambda: block(["div", "section", "dialog"], ["cookie-notice", "consent", "banner", "alert", "notice", "gdpr-popup"], plain() + link()),
        "form": lambda: block(["form"], ["", "search", "newsletter"], f"<label>{words(1, 4)}</label><input name=q><p>{sentence()}</p>"),
        "comments": lambda: block(["section", "div", "ol"], ["comments", "comment-list", "reader-comments", "replies"], "".join(f"<div class='{pick(['comment', 'reply', ''])}'><p>{prose(1, 4)}</p></div>" for _ in range(rng.randint(1, 4)))),
        "share": lambda: block(["div", "ul"], ["share", "social-links", "breadcrumbs", "pagination"], links(1, 4)),
    }

    def article(bare=False):
        title = f"<h1>{words(2, 9)}</h1>"
        body = [title if bare or chance() < 0.7 else f"<header>{title}{pick(['', f'<p>{sentence()}</p>'])}</header>"] if chance() < 0.8 else []
        for _ in range(rng.choice((1, 1, 2, 3, 4, 6, 9))):
            kind = chance()
            text = inline(prose(1, 6) if chance() < 0.8 else words(1, 4))
            if kind < 0.7:
                body.append(pick([f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>"]))
            elif kind < 0.78:
                body.append(f"<h2>{words(1, 5)}</h2>")
            elif kind < 0.86:
                body.append("<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(rng.randint(1, 4))) + "</ul>")
            elif kind < 0.92:
                body.append(f"<blockquote>{prose(1, 2)}</blockquote>")
            elif kind < 0.94:
                body.append(f"<figure><img src={word()}><figcaption>{sentence()}</figcaption></figure>")
            elif kind < 0.97:
                body.append("<table><tr>" + "".join(f"<td>{words(1, 3)}</td>" for _ in range(3)) + "</table>")
            else:
                body.append(f"<pre>{words(3, 12)}</pre>")
            if chance() < 0.08:
                body.append(parts[pick(["ad", "share", "aside", "form"])]())
        if chance() < 0.15:
            body.append(parts["comments"]())
        if bare:
            return "".join(f"{x[:x.index('>')].rstrip('/')} y=1{x[x.index('>'):]}" if x.startswith("<") and " y=0" not in x[:x.index(">")] else x for x in body)
        name, own = pick([("article", ""), ("article", ""), ("main", ""), ("div", "content"), ("div", "post-body"), ("div", "article"), ("section", "story"), ("div", "entry-text"), ("div", "mainContent")])
        inner = "".join(body)
        if own or chance() < 0.7:
            return f'<{name}{f" class={own}" if own else ""} y=1>{inner}</{name}>'
        outer = pick(["main", "main", "section", "div class=content"])
        return f"<{name} y=1><div>{inner}</div></{name}>" if chance() < 0.4 else f"<{outer} y=1><{name}>{inner}</{name}></{outer.split()[0]}>"

    pages = []
    for _ in range(n):
        before = [parts[k]() for k in rng.sample(["nav", "header", "ad", "notice", "share", "form"], rng.randint(1, 4))]
        after = [parts[k]() for k in rng.sample(["footer", "aside", "comments", "ad", "form", "nav"], rng.randint(0, 4))]
        kind = chance()
        if kind < 0.08:  # nothing but text, or paragraphs and a few others
            pages.append(pick([f"<body y=1>{prose(2, 6)}", f"<html><body y=1>{prose(1, 3)}<br><br>{prose(1, 4)}</body></html>"]))
            continue
        if kind < 0.3:  # no element holds the article
            some = lambda x: [y for y in x if chance() < 0.5]
            inner = "".join([*some(before), article(bare=True), *some(after)])
            pages.append(f"<html><head><title>{words(2, 5)}</title></head><body>{inner}" + pick(["</body></html>", ""]))
            continue
        inner = "".join([*before, article() if chance() < 0.95 else "", *after])
        if chance() < 0.4:
            inner = f'<div{pick(["", " id=wrapper", " class=container", " class=page"])} y=0>{inner}</div>'
        pages.append(f"<html><head><title>{words(2, 5)}</title></head><body>{inner}" + pick(["</body></html>", ""]))
    return pages


@lru_cache(maxsize=1)
def standard_field() -> Field:
    return learn(labelled_pages())


def extract(pages: DataFrame, *, source: str = "html", model: Field | None = None, into: str = "text") -> DataFrame:
    """Add ``into``, the main text of every page: its content blocks joined by an empty line.

    White space inside a block becomes one space, references are decoded, nothing is cut. A null or empty page, or one
    without content, has the empty text; equal pages have equal texts; all rows and other columns stay.
    A column that is named ``into`` already is replaced. The model is fitted to made labelled pages unless one is given.
    """
    known = model or standard_field()

    @F.pandas_udf("string")
    def texts(sources: pd.Series) -> pd.Series:
        return sources.map(known.text)

    return pages.withColumn(into, texts(F.col(source)))
