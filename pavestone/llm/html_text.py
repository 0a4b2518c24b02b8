"""Operator 1, HTML extraction: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements.  Trees of features (subtree text and
link density, attribute tokens of the node and its ancestors, depth, sibling
statistics, place in the page) give each node its odds of being main text.  The
decoding then finds the most likely choice in which nothing below a dropped
node is kept: a node's best value is the better of keeping it with the best
choices of its children, and of dropping its whole subtree.

The classifier is fitted on labelled pages of this module's own making, in many
layouts; how many is the parameter `training_pages` (a fixed bound).

Text: character references are decoded, runs of white space in a block (a line
break among them) become one space, blocks are trimmed and joined in page order
by an empty line; nothing is shortened.

Defined results: a null or empty html, or one without main text, gives an empty text; markup that never ends
runs to the end of the page; repeated rows each get theirs; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees
from .common import batches, only

TRAINING_PAGES = 500

#: Where markup begins: a comment, a tag's name, or a declaration.
MARKUP = re.compile(r"<(?:(!--)|(/?)([A-Za-z][^\s/>]*)|([!?]))")
#: The rest of a tag, its attributes with their quotes closed.
REST = re.compile(r"((?:\"[^\"]*\"|'[^']*'|[^'\">]++)*+)>")
SPECIAL = re.compile(r"['\">]")
ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements whose content is never text of the page.
OPAQUE = frozenset("script style head noscript template svg math iframe object canvas audio video select textarea button title".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul caption search".split()
)
#: A start tag of the key closes an open element of the value before it.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: Elements beyond which no start tag closes anything.
LIMITS = frozenset("ul ol dl table menu div section article body".split())
KINDS = [
    frozenset({"article", "main"}), frozenset({"section", "div", "body", "html", "center"}), frozenset({"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}), frozenset({"p", "pre", "blockquote"}),
    frozenset({"ul", "ol", "dl", "menu", "li", "dt", "dd"}), frozenset({"nav", "search"}), frozenset({"header"}), frozenset({"footer", "address"}), frozenset({"aside", "dialog"}), frozenset({"form", "fieldset"}),
    frozenset({"table", "tbody", "td", "tfoot", "th", "thead", "tr", "caption"}),
]
KIND_OF = {t: k for k, names in enumerate(KINDS) for t in names}
#: Attribute tokens by what they tell.
TOKENS = {
    "main": "article content main post entry story body text prose page single blog hentry articlebody maincontent richtext",
    "advert": "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner dfp adsense teaser outbrain taboola",
    "notice": "cookie cookies consent notice gdpr popup modal alert overlay newsletter subscribe subscription paywall toast disclaimer privacy announcement complementary",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pagination pager toc skip links tabs toolbar topbar",
    "side": "sidebar side aside widget widgets related recommended popular trending rail more",
    "foot": "footer foot copyright legal colophon credits imprint contentinfo",
    "head": "header masthead logo branding tagline hero site top",
    "talk": "comment comments commentlist reply replies respond disqus discussion thread reader feedback responses",
    "form": "form login signin signup register search share social sharing follow buttons rating poll survey contact",
}
TOKEN_OF = {w: k for k, ws in enumerate(TOKENS.values()) for w in ws.split()}
N_TOKENS, N_KINDS = len(TOKENS), len(KINDS)


class Node:
    __slots__ = ("tag", "up", "below", "depth", "marks", "runs", "chars", "links", "stops", "tags", "order", "controls", "paragraphs", "items", "before", "label", "ends")

    def __init__(self, tag: str, up: Node | None, marks: int) -> None:
        self.tag, self.up, self.marks = tag, up, marks
        self.depth = up.depth + 1 if up else 0
        self.below: list[Node] = []
        self.runs: list[tuple[int, str]] = []
        self.chars = self.links = self.stops = self.controls = self.paragraphs = self.items = self.before = 0
        self.tags = 1
        self.order = 0
        self.label = None
        #: What a start tag inside would close, by its name.
        self.ends: dict[str, Node] = {} if not up or tag in LIMITS else up.ends
        own = [t for t, closed in CLOSES.items() if tag in closed]
        if own:
            self.ends = self.ends | dict.fromkeys(own, self)
        if up:
            up.below.append(self)


def token_marks(attributes: str) -> int:
    if "=" not in attributes:
        return 0
    out = 0
    for m in ATTRIBUTE.finditer(attributes):
        for t in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "").lower()):
            k = TOKEN_OF.get(t)
            if k is not None:
                out |= 1 << k
    return out


@cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I)


class Tags:
    """Ends of the tags of a page; a place from which no end was found is not passed again, so all tags together take one walk."""

    def __init__(self, html: str) -> None:
        self.html = html
        self.dead: set[int] = set()
        self.none_from = len(html)  # no quote and no end from here on

    def end(self, at: int) -> int:
        """The place of the > that ends a tag whose name ends at `at`, or -1."""
        if not self.dead and at < self.none_from:
            m = REST.match(self.html, at)
            if m:
                return m.end() - 1
        seen = []
        while at < self.none_from:
            m = SPECIAL.search(self.html, at)
            if not m:
                self.none_from = at
                break
            p = m.start()
            if p in self.dead:
                break
            if self.html[p] == ">":
                return p
            seen.append(p)
            close = self.html.find(self.html[p], p + 1)
            if close < 0:
                break
            at = close + 1
        self.dead.update(seen)
        return -1


def parse(html: str) -> Node:
    """The tree of block elements of a page; text lies in runs of (order, text) at its nearest block."""
    root = here = Node("html", None, 0)
    parts: list[str] = []
    at, order, in_link, link_chars, end = 0, 0, 0, 0, len(html)
    tags, opened, head_ends = Tags(html), dict.fromkeys(BLOCK, 0), True

    def leave(node: Node) -> None:
        """Ends a node and all open ones inside it."""
        nonlocal here
        stop = node.up
        while here is not stop:
            opened[here.tag] -= 1
            here = here.up

    def flush() -> None:
        nonlocal parts, order, link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                here.runs.append((order, text))
                order += 1
                here.chars += len(text)
                here.links += min(link_chars, len(text))
                here.stops += sum(map(text.count, ".,;!?"))
            parts = []
        link_chars = 0

    text_at = at  # where the text begins that isn't taken yet
    while at < end:
        m = MARKUP.search(html, at)
        close = tags.end(m.end()) if m and m[3] else -1
        if m and m[3] and close < 0:
            at = m.end()  # no tag: its characters are text
            continue
        stop = m.start() if m else end
        if stop > text_at:
            text = html[text_at:stop]
            if "&" in text:
                text = unescape(text)
            parts.append(text)
            if in_link:
                link_chars += len(text)
        text_at = end
        if not m:
            break
        if not m[3]:
            found = html.find("-->" if m[1] else ">", m.end())
            at = text_at = end if found < 0 else found + (3 if m[1] else 1)
            continue
        at = text_at = close + 1
        tag, attributes = m[3].lower(), html[m.end() : close]
        if m[2]:
            if tag == "a":
                in_link = 0
            elif tag in BLOCK:
                node = here
                if opened[tag]:
                    while node.tag != tag:
                        node = node.up
                    flush()
                    leave(node)
                elif tag in ("body", "html", "p"):
                    flush()
            continue
        if tag in OPAQUE:
            if tag in ("select", "textarea", "button"):
                here.controls += 1
            here.tags += 1
            if not attributes.endswith("/"):
                if tag == "head":  # a body start tag ends a head that isn't closed
                    found = re.compile(r"</head\s*>|(?=<body[\s>])", re.I).search(html, at) if head_ends else None
                    head_ends = found is not None
                else:
                    found = _end_of(tag).search(html, at)
                at = text_at = found.end() if found else (at if tag == "head" else end)
            continue
        if tag == "a":
            in_link = 1
        elif tag == "br":
            parts.append(" ")
        elif tag == "hr":
            flush()
        elif tag == "input":
            here.controls += 1
        elif tag in BLOCK:
            flush()
            in_link = 0
            if tag in ("html", "body"):
                if tag == "html" or opened["body"]:
                    root.marks |= token_marks(attributes)
                    continue
            if here.tag == "p":  # a block ends an open paragraph, so a paragraph never holds one
                leave(here)
            if tag in here.ends:
                leave(here.ends[tag])
            here = Node(tag, here, token_marks(attributes))
            opened[tag] += 1
            continue
        here.tags += 1
    if text_at < end:
        parts.append(unescape(html[text_at:end]))
        link_chars += (end - text_at) * in_link
    flush()
    return root


def flat(root: Node) -> list[Node]:
    """All nodes, parents first; the text of a node that also holds blocks becomes nodes of its own."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.below and node.runs:
            share = 1 / len(node.runs)
            for order, text in node.runs:
                leaf = Node("#run", node, 0)
                leaf.runs, leaf.chars = [(order, text)], len(text)
                leaf.links, leaf.stops = round(node.links * share), sum(map(text.count, ".,;!?"))
            node.runs = []
            node.chars = node.links = node.stops = 0
        out.append(node)
        todo.extend(reversed(node.below))
    return out


N_FEATURES = 19 + 2 * N_TOKENS + 2 * N_KINDS + 1


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node; `nodes` as from `flat`.  Sums of subtrees are gathered into the nodes first."""
    own_chars = [n.chars for n in nodes]
    for n in nodes:
        n.paragraphs = int(n.tag in ("p", "pre", "blockquote"))
        n.items = int(n.tag == "li")
        n.order = 0
    runs = {id(n): len(n.runs) for n in nodes}
    for n in reversed(nodes):
        if n.up:
            u = n.up
            u.chars += n.chars
            u.links += n.links
            u.stops += n.stops
            u.tags += n.tags
            u.controls += n.controls
            u.paragraphs += n.paragraphs
            u.items += n.items
            runs[id(u)] += runs[id(n)]
    total = max(1, nodes[0].chars)
    seen = 0
    for n, c in zip(nodes, own_chars, strict=True):
        n.before = seen
        seen += c
    x = np.zeros((len(nodes), N_FEATURES))
    above_marks: dict[int, int] = {}
    above_kinds: dict[int, int] = {}
    place: dict[int, int] = {}
    for n in nodes:
        alike: dict[str, int] = {}
        for k, c in enumerate(n.below):
            place[id(c)] = k
            alike[c.tag] = alike.get(c.tag, 0) + 1
        n.label = (n.label, alike)
    for i, n in enumerate(nodes):
        u = n.up
        key = id(n)
        kind = KIND_OF.get(n.tag, -1)
        if u:
            up_marks, up_kinds = above_marks[id(u)], above_kinds[id(u)]
            siblings = len(u.below)
            row = [n.depth, place[key], siblings, place[key] / siblings, n.label[1] and len(n.below) or 0, u.label[1][n.tag] / siblings, n.chars / max(1, u.chars), (u.paragraphs - n.paragraphs), u.links / max(1, u.chars)]
        else:
            up_marks = up_kinds = 0
            row = [0, 0, 1, 0, len(n.below), 1, 1, 0, 0]
        above_marks[key] = up_marks | n.marks
        above_kinds[key] = up_kinds | (1 << kind if kind >= 0 else 0)
        row += [
            math.log1p(n.chars), n.links / max(1, n.chars), math.log1p(n.chars / n.tags), n.chars / max(1, runs[key]), n.stops / max(1, n.chars),
            n.paragraphs, n.items, n.controls, n.before / total, n.chars / total,
        ]
        row += [n.marks >> k & 1 for k in range(N_TOKENS)]
        row += [up_marks >> k & 1 for k in range(N_TOKENS)]
        row += [kind == k for k in range(N_KINDS)]
        row += [up_kinds >> k & 1 for k in range(N_KINDS)]
        row.append(n.tag == "#run")
        x[i] = row
    for n in nodes:
        n.label = n.label[0]
    return x


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The most likely choice of nodes in which a kept node's ancestors are kept; the root is kept."""
    place = {id(n): i for i, n in enumerate(nodes)}
    odds = np.clip(odds, -12, 12)
    keep_cost, drop_cost = np.logaddexp(0, -odds), np.logaddexp(0, odds)
    dropped = drop_cost.copy()  # of the whole subtree
    kept = keep_cost.copy()
    for i in range(len(nodes) - 1, 0, -1):
        u = place[id(nodes[i].up)]
        dropped[u] += dropped[i]
        kept[u] += min(kept[i], dropped[i])
    out = [True] * len(nodes)
    for i in range(1, len(nodes)):
        out[i] = out[place[id(nodes[i].up)]] and bool(kept[i] <= dropped[i])
    return out


def text_of(nodes: list[Node], keep: list[bool]) -> str:
    runs = sorted(r for n, k in zip(nodes, keep, strict=True) if k for r in n.runs)
    return "\n\n".join(t for _, t in runs)


# ---- labelled pages ----


class _Page:
    """One made page: its html, and which texts are main text."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        self.main: list[str] = []

    def words(self, low: int, high: int) -> str:
        r = self.r
        n = r.randint(low, high)
        out = []
        while len(out) < n:
            s = ["".join(r.choice(["an", "ter", "lo", "mi", "re", "sen", "do", "qu", "ü", "é", "st", "ka"]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 14))]
            s[0] = s[0].capitalize()
            s[-1] += r.choice([".", ".", ".", "!", "?", ";", ""])
            if len(s) > 6:
                s[3] += ","
            out += s
        return " ".join(out[:n])

    def attrs(self, kinds: list[str]) -> str:
        r = self.r
        if not kinds:
            return r.choice(["", "", f' class="c{r.randint(1, 99)}"', f' id="x{r.randint(1, 99)}"'])
        token = r.choice(TOKENS[r.choice(kinds)].split())
        more = r.choice(["", f" c{r.randint(1, 99)}", "-wrap", "-box", "_inner"])
        return f' {r.choice(["class", "class", "class", "id"])}="{token}{more}"'

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{i}">{self.words(1, 4)}</a></li>' for i in range(n))

    def paragraph(self) -> str:
        r = self.r
        text = self.words(1, 4) if r.random() < 0.3 else self.words(5, 130)
        self.main.append(text)
        if r.random() < 0.15:
            return f"<p><b>{text}<br>"
        inner = text
        if r.random() < 0.2:
            w = text.split(" ")
            k = r.randrange(len(w))
            w[k] = f'<a href="#">{w[k]}</a>'
            inner = " ".join(w)
        return f"<p>{inner}</p>"

    def boiler(self) -> str:
        r = self.r
        kind = r.choice(["nav", "header", "footer", "aside", "ad", "ad", "notice", "form", "share", "related", "comments"])
        some = self.words(2, 40)
        if kind == "nav":
            tag, a = r.choice([("nav", self.attrs(r.choice([[], ["menu"]]))), ("div", self.attrs(["menu"])), ("ul", self.attrs(["menu"]))])
            body = self.links(r.randint(2, 12))
            return f"<{tag}{a}>{body if tag == 'ul' else f'<ul>{body}</ul>'}</{tag}>"
        if kind == "header":
            tag, a = r.choice([("header", self.attrs(r.choice([[], ["head"]]))), ("div", self.attrs(["head"]))])
            return f"<{tag}{a}>{r.choice(['<h2>', '<p>', '<div>'])}{self.words(1, 8)}{r.choice(['', '<ul>' + self.links(3) + '</ul>'])}</{tag}>"
        if kind == "footer":
            tag, a = r.choice([("footer", self.attrs(r.choice([[], ["foot"]]))), ("div", self.attrs(["foot"]))])
            return f"<{tag}{a}>{r.choice(['&copy; ', '', '<p>'])}{some}</{tag}>"
        if kind == "aside":
            tag, a = r.choice([("aside", self.attrs(r.choice([[], ["side"]]))), ("div", self.attrs(["side"]))])
            return f"<{tag}{a}><h3>{self.words(1, 4)}</h3>{r.choice([f'<p>{some}</p>', f'<p>{some}</p><p>{self.words(4, 40)}</p>', '<ul>' + self.links(4) + '</ul>'])}</{tag}>"
        if kind == "form":
            return f"<form{self.attrs(r.choice([[], ['form']]))}>{r.choice(['<label>', '<p>', ''])}{self.words(1, 9)}<input name=q>{r.choice(['', '<button>Go</button>'])}</form>"
        if kind == "comments":
            each = "".join(f"<{t}{self.attrs(['talk'])}><p>{self.words(2, 60)}</p></{t}>" for t in [r.choice(["div", "li", "article"])] for _ in range(r.randint(1, 5)))
            tag = r.choice(["section", "div", "ol"])
            return f"<{tag}{self.attrs(['talk'])}>{r.choice(['', '<h3>' + self.words(1, 3) + '</h3>'])}{each}</{tag}>"
        names = {"ad": "advert", "notice": "notice", "share": "form", "related": "side"}
        tag = r.choice(["div", "div", "section", "p", "aside"])
        body = some if tag == "p" or r.random() < 0.5 else f"<p>{some}</p>"
        return f"<{tag}{self.attrs([names[kind]])}>{body}</{tag}>"

    def article(self) -> str:
        r = self.r
        out = []
        if r.random() < 0.85:
            title = self.words(1, 14)
            self.main.append(title)
            head = f"<h1>{title}</h1>"
            out.append(f"<header>{head}</header>" if r.random() < 0.15 else head)
        for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8, 15])):
            x = r.random()
            if x < 0.72:
                out.append(self.paragraph())
            elif x < 0.8:
                t = self.words(1, 8)
                self.main.append(t)
                out.append(f"<h{k}>{t}</h{k}>" if (k := r.randint(2, 4)) else "")
            elif x < 0.87:
                items = [self.words(1, 15) for _ in range(r.randint(1, 5))]
                self.main += items
                out.append("<ul>" + "".join(f"<li>{t}</li>" for t in items) + "</ul>")
            elif x < 0.92:
                t = self.words(3, 40)
                self.main.append(t)
                out.append(f"<blockquote>{t}</blockquote>" if r.random() < 0.5 else f"<div>{t}</div>")
            elif x < 0.97:
                out.append(self.boiler())
            else:
                t = self.words(3, 30)
                self.main.append(t)
                out.append(f"<table><tr><td>{t}</td></tr></table>")
        body = "".join(out)
        tag, a = r.choice([("article", self.attrs(r.choice([[], ["main"]]))), ("article", ""), ("main", self.attrs([])), ("div", self.attrs(["main"])), ("section", self.attrs(["main"]))])
        return f"<{tag}{a}>{body}</{tag}>"

    def html(self) -> str:
        r = self.r
        before = [self.boiler() for _ in range(r.randint(0, 4))]
        middle = self.article()
        after = [self.boiler() for _ in range(r.randint(0, 4))]
        if r.random() < 0.3:
            middle = f"<div{self.attrs([])}>{middle}{self.boiler() if r.random() < 0.5 else ''}</div>"
        body = "".join(before) + middle + "".join(after)
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 9)}</title><style>p{{}}</style></head><body>{body}</body></html>"


def labelled_nodes(pages: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of made pages: a node is main text if any text below it is."""
    xs, ys = [], []
    for seed in range(pages):
        p = _Page(seed)
        nodes = flat(parse(p.html()))
        main: dict[str, int] = {}
        for t in p.main:
            t = " ".join(t.split())
            main[t] = main.get(t, 0) + 1
        label = {}
        for n in nodes:
            label[id(n)] = any(t in main for _, t in n.runs)
        for n in reversed(nodes):
            if n.up and label[id(n)]:
                label[id(n.up)] = True
        use = [i for i, n in enumerate(nodes) if i and (n.runs or n.below)]
        xs.append(features(nodes)[use])
        ys.append(np.array([label[id(nodes[i])] for i in use], float))
    return np.concatenate(xs), np.concatenate(ys)


@cache
def fitted(training_pages: int = TRAINING_PAGES) -> BoostedTrees:
    return BoostedTrees().fit(*labelled_nodes(training_pages))


def extract(pages: list[str | None], model: BoostedTrees) -> list[str]:
    """The main texts of a batch of pages."""
    trees = [flat(parse(h)) if h else [] for h in pages]
    filled = [t for t in trees if t]
    if not filled:
        return [""] * len(pages)
    odds = model.log_odds(np.concatenate([features(t) for t in filled]))
    out, at = [], 0
    for t in trees:
        if not t:
            out.append("")
            continue
        out.append(text_of(t, decode(t, odds[at : at + len(t)])))
        at += len(t)
    return out


def _task(model: BoostedTrees):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 1 << 20):
            texts = extract(b.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return task


def main_text(pages: DataFrame, training_pages: int = TRAINING_PAGES) -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points)."""
    rows = only(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(_task(fitted(training_pages)), "page_id long, url string, text string, n_chars long")


def op1_html_text(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
