"""Operator 1: main text of HTML pages by a tree-structured graphical model.

A page is parsed into its element tree. Every element is a binary variable,
content or not; unary potentials weigh its features (tag, words of its class,
id and role, length, share of links, sentences), pairwise potentials
connect parent and child, with a table for each kind of child. Sum-product
messages, upward and then downward, give every element's content marginal.
The potentials are fitted by maximum likelihood, whose gradient needs the same
marginals, from labelled pages; ``labelled_pages`` writes the default ones.

Text is kept where its element's marginal is at least one half. Parsing and
message passing run inside the tasks, a page at a time and a batch at a time;
nothing is shuffled. The model is a few hundred numbers.

Defined results: null, empty and tagless pages without text give an empty
text; a page without any element is one block of text under a root that the
model judges as any other, and learns to keep. No attribute of a page to extract is
read as a label. Broken markup is read leniently: unknown end tags
are skipped, open elements end with their parent. Rows are extracted alone, so
repeated rows get equal results. Columns that the input has under the names of
the result's columns are replaced.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)|[^<]++|<", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Text of these is never shown as text.
SILENT = frozenset("script style noscript template iframe object svg math head title select option datalist "
                   "textarea button audio video canvas noframes noembed".split())
RAW = frozenset("script style textarea title iframe noframes noembed xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q ruby rb rp rt s samp "
                   "small span strike strong sub sup time tt u var wbr label output meter progress".split())
# A start tag of the first kind ends an open element of the second, up to the named border.
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("table", "tr")),
          "th": (("td", "th"), ("table", "tr")), "body": (("head",), ())}
ENDS_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hr main menu nav ol p pre section table ul".split())

TAGS = {"article": "article", "main": "article", "section": "section", "div": "div", "center": "div", "p": "p", "pre": "quote",
        "blockquote": "quote", "ul": "list", "ol": "list", "dl": "list", "li": "item", "dt": "item", "dd": "item",
        "table": "table", "tbody": "table", "thead": "table", "tfoot": "table", "tr": "table", "td": "cell", "th": "cell",
        "nav": "nav", "menu": "nav", "aside": "aside", "header": "header", "footer": "footer", "form": "form",
        "fieldset": "form", "legend": "form", "label": "form", "dialog": "dialog", "figure": "figure", "figcaption": "figure",
        "details": "section", "summary": "item", "html": "root", "body": "root", "#root": "root", "address": "address",
        "h1": "h1", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading"}
ROLES = {"navigation": "nav", "banner": "header", "contentinfo": "footer", "complementary": "aside", "search": "form",
         "form": "form", "dialog": "dialog", "alertdialog": "dialog", "alert": "dialog", "article": "article", "main": "article"}
# Words of class, id and data attributes that tell what a part of a page is for.
WORDS = {
    "w_nav": "nav navigation navbar menu menubar submenu breadcrumb breadcrumbs crumbs toc pagination pager paging tabs tab skip",
    "w_ad": "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promoted promotion "
            "doubleclick dfp outbrain taboola teaser affiliate",
    "w_side": "sidebar side aside rail widget widgets related recommended recommendations recommend popular trending more "
              "similar readmore also tags tagcloud archive archives",
    "w_comment": "comment comments commentlist respond reply replies disqus discussion reader readers feedback reviews",
    "w_notice": "cookie cookies consent gdpr notice notices alert warning popup modal overlay newsletter subscribe subscription "
                "signup paywall toast message notification announcement disclaimer privacy",
    "w_share": "share sharing social follow facebook twitter buttons toolbar tools print rating",
    "w_frame": "header footer masthead topbar top bottom foot head copyright legal colophon logo branding site global",
    "w_form": "form login search signin register contact field input",
    "w_meta": "meta byline author date dateline timestamp published credit caption",
    "w_main": "article content post entry main story body text maincontent articlebody page prose blog hentry richtext copy",
    "w_hidden": "hidden hide invisible sr visuallyhidden offscreen screenreader",
}
LEXICON = {w: group for group, ws in WORDS.items() for w in ws.split()}
KINDS = tuple(dict.fromkeys(TAGS.values())) + ("other",)
EXTRA = ("hidden", "no_text", "short", "long", "links_some", "links_most", "sentences", "many_sentences",
         "own_text", "copyright", "alone", "bias")
NAMES = tuple(f"t_{k}" for k in KINDS) + tuple(WORDS) + EXTRA
AT = {name: i for i, name in enumerate(NAMES)}
# Kinds of child that have a table of pairwise potentials of their own.
CHILD = {"p": 1, "h1": 1, "heading": 1, "quote": 1, "item": 2, "list": 2, "cell": 2, "table": 2, "figure": 1}
N_CHILD = 3
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])|(?<=[a-z])(?=[0-9])")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Page:
    """An element tree: parent, depth, features of each element; runs of text with element and block."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: ["#root"])
    cues: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    marks: list[int | None] = field(default_factory=lambda: [None])
    runs: list[tuple[int, int, str, bool]] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        if value[:1] in "\"'" and value:
            value = value[1:-1]
        out.setdefault(name.lower(), unescape(value))
    return out


def _cues(attrs: dict[str, str]) -> tuple[str, ...]:
    out = set()
    for name in ("class", "id"):
        if name in attrs:
            for word in SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", attrs[name]).lower()):
                if word in LEXICON:
                    out.add(LEXICON[word])
    role = attrs.get("role", "").lower()
    if role in ROLES:
        out.add(f"t_{ROLES[role]}")
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDING.search(attrs.get("style", "")):
        out.add("hidden")
    return tuple(sorted(out))


MARK = "data-main"      # attribute of labelled pages: 1 or 0


def parse(html: str, mark_name: str | None = MARK) -> Page:
    """Read a page leniently. Pages to learn from have an attribute ``mark_name`` that says 1 or 0 (any
    other value is none); None for pages to extract, whose attributes of that name mean nothing."""
    page = Page()
    stack = [0]
    silent = 0
    silent_at: list[int] = []
    block = 0
    link_at = -1           # length of the stack at which a link was opened
    at, n = 0, len(html)
    match = TOKEN.match

    def pop_to(size: int) -> None:
        nonlocal silent, link_at
        del stack[size:]
        while silent_at and silent_at[-1] >= size:
            silent_at.pop()
            silent -= 1
        if link_at > size:
            link_at = -1

    while at < n:
        m = match(html, at)
        at = m.end()
        name = m.group(2)
        if name is None:
            text = m.group()
            if text[0] == "<" and len(text) > 1:
                if text.startswith("<![CDATA["):
                    text = text[9:-3]
                else:
                    continue
            if not silent:
                page.runs.append((stack[-1], block, unescape(text), link_at >= 0))
            continue
        name = name.lower()
        if m.group(1):
            if name == "br":
                page.runs.append((stack[-1], block, " ", False))
            elif name == "a":
                link_at = -1
            if name in VOID:
                continue
            inline = name in INLINE
            for i in range(len(stack) - 1, 0, -1):
                tag = page.tag[stack[i]]
                if tag == name:
                    pop_to(i)
                    break
                if inline and tag not in INLINE:
                    break
            if not inline:
                block += 1
            continue
        if name in ("br", "wbr", "img"):
            if name == "br" and not silent:
                page.runs.append((stack[-1], block, " ", False))
            continue
        if name in VOID:
            block += name == "hr"
            continue
        rest = m.group(3)
        inline = name in INLINE
        attrs = _attributes(rest) if "=" in rest or "hidden" in rest else {}
        cues = _cues(attrs) if attrs else ()
        mark = attrs.get(mark_name) if attrs and mark_name else None
        if mark not in ("0", "1"):
            mark = None
        if inline and name == "a":
            link_at = len(stack)
        if inline and not cues and mark is None and name != "label":
            continue
        if not inline:
            block += 1
            if name in ENDS_P:
                for i in range(len(stack) - 1, 0, -1):
                    if page.tag[stack[i]] == "p":
                        pop_to(i)
                        break
                    if page.tag[stack[i]] not in INLINE:
                        break
            if name in CLOSES:
                ended, border = CLOSES[name]
                for i in range(len(stack) - 1, 0, -1):
                    tag = page.tag[stack[i]]
                    if tag in border:
                        break
                    if tag in ended:
                        pop_to(i)
                        if tag == name or name not in ("tr",):
                            break
        if rest.endswith("/") and name not in TAGS and name not in SILENT:
            continue
        page.parent.append(stack[-1])
        page.depth.append(page.depth[stack[-1]] + 1)
        page.tag.append(name)
        page.cues.append(cues)
        page.marks.append(None if mark is None else int(mark))
        stack.append(len(page.parent) - 1)
        if name in SILENT:
            silent += 1
            silent_at.append(len(stack) - 1)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else n
    return page


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(parent, depth, kind of child, feature matrix) of all elements of the pages, one forest."""
    counts = [len(p.parent) for p in pages]
    start = np.concatenate([[0], np.cumsum(counts)])
    total = int(start[-1])
    parent = np.empty(total, np.int64)
    depth = np.empty(total, np.int64)
    kind = np.zeros(total, np.int64)
    x = np.zeros((total, len(NAMES)), np.float32)
    own = np.zeros((total, 3))
    mark = np.zeros(total, bool)
    for p, a in zip(pages, start):
        b = a + len(p.parent)
        parent[a:b] = np.asarray(p.parent) + a
        parent[a] = -1
        depth[a:b] = p.depth
        for i, (tag, cues) in enumerate(zip(p.tag, p.cues), a):
            k = TAGS.get(tag, "other")
            kind[i] = CHILD.get(k, 0)
            x[i, AT[f"t_{k}"]] = 1
            for c in cues:
                x[i, AT[c]] = 1
        for node, _, text, link in p.runs:
            size = len(text) - text.count(" ")
            if size:
                own[a + node, 0] += size
                if link:
                    own[a + node, 1] += size
                own[a + node, 2] += text.count(". ") + text.count(".\n") + text.rstrip().endswith((".", "!", "?", "。"))
                if "©" in text:
                    mark[a + node] = True
    whole = own.copy()
    for at in _levels(depth)[:0:-1]:
        np.add.at(whole, parent[at], whole[at])
    share = whole[:, 1] / np.maximum(whole[:, 0], 1)
    for name, on in (("no_text", whole[:, 0] == 0), ("short", (whole[:, 0] > 0) & (whole[:, 0] < 25)), ("long", whole[:, 0] >= 120),
                     ("links_some", (share > 0.2) & (share <= 0.6)), ("links_most", share > 0.6),
                     ("sentences", whole[:, 2] >= 1), ("many_sentences", whole[:, 2] >= 3),
                     ("own_text", own[:, 0] > 0), ("copyright", mark)):
        x[:, AT[name]] = on
    x[start[:-1], AT["alone"]] = np.array(counts) == 1     # a page without any element
    x[:, AT["bias"]] = 1
    return parent, depth, kind, x


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """Elements by depth."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(parent: np.ndarray, depth: np.ndarray, unary: np.ndarray, pair: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product on the forest: P(content) of each element and the 2x2 table of it with its parent.

    ``unary`` is the log potential of content against not; ``pair[i]`` the log
    potentials (parent state, own state) of element i. Roots have a zero table.
    """
    n = len(parent)
    up = np.zeros((n, 2))           # own potential and messages of the children
    up[:, 1] = unary
    to_parent = np.zeros((n, 2))
    levels = _levels(depth)
    for at in levels[:0:-1]:
        s = pair[at] + up[at][:, None, :]
        to_parent[at] = _join(s[:, :, 0], s[:, :, 1])
        np.add.at(up, parent[at], to_parent[at])
    belief = up.copy()              # log belief; the parent's message is added on the way down
    table = np.zeros((n, 2, 2))
    for at in levels[1:]:
        p = parent[at]
        rest = belief[p] - to_parent[at]
        joint = pair[at] + up[at][:, None, :] + rest[:, :, None]
        joint -= joint.max((1, 2), keepdims=True)
        e = np.exp(joint)
        table[at] = e / e.sum((1, 2), keepdims=True)
        s = pair[at] + rest[:, :, None]
        belief[at] = up[at] + _join(s[:, 0], s[:, 1])
        belief[at] -= belief[at].max(1, keepdims=True)
    d = np.clip(belief[:, 0] - belief[:, 1], -60, 60)
    return 1 / (1 + np.exp(d)), table


@dataclass
class Model:
    """Weights of the features, and a 2x2 table of log potentials for each kind of child."""

    w: np.ndarray
    pair: np.ndarray


def fit(pages: list[Page], steps: int = 250) -> Model:
    """Maximum likelihood (with L2) from pages whose elements are marked, by Adam."""
    parent, depth, kind, x = features(pages)
    y = np.zeros(len(parent))
    at = 0
    for p in pages:
        mine = np.zeros(len(p.parent))
        mine[0] = len(mine) == 1          # text without any tag is all content
        for i in range(1, len(p.parent)):
            mine[i] = mine[p.parent[i]] if p.marks[i] is None else p.marks[i]
        y[at:at + len(mine)] = mine
        at += len(mine)
    child = np.flatnonzero(parent >= 0)
    truth = np.zeros((len(parent), 2, 2))
    truth[child, y[parent[child]].astype(int), y[child].astype(int)] = 1
    w, pair = np.zeros(len(NAMES)), np.zeros((N_CHILD, 2, 2))
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, pair)]
    for t in range(1, steps + 1):
        m, table = marginals(parent, depth, x @ w, np.where((parent >= 0)[:, None, None], pair[kind], 0))
        g_pair = np.zeros_like(pair)
        np.add.at(g_pair, kind[child], (table - truth)[child])
        grads = (x.T @ (m - y) / len(pages) + 0.002 * w, g_pair / len(pages) + 0.002 * pair)
        for v, g, (one, two) in zip((w, pair), grads, state):
            one += 0.1 * (g - one)
            two += 0.01 * (g * g - two)
            v -= 0.1 * (one / (1 - 0.9 ** t)) / (np.sqrt(two / (1 - 0.99 ** t)) + 1e-8)
    return Model(w, pair)


def content(pages: list[Page], model: Model) -> list[np.ndarray]:
    """P(content) of each element of each page."""
    parent, depth, kind, x = features(pages)
    m, _ = marginals(parent, depth, x @ model.w, np.where((parent >= 0)[:, None, None], model.pair[kind], 0))
    return np.split(m, np.cumsum([len(p.parent) for p in pages])[:-1])


def main_text(page: Page, keep: np.ndarray) -> str:
    """Kept runs, white space made one space inside a block, blocks joined by an empty line."""
    blocks: list[list[str]] = []
    last = -1
    for node, block, text, _ in page.runs:
        if keep[node]:
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(text)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n\n".join(x for x in lines if x)


def _sentence(rng: random.Random, low: int = 5, high: int = 16) -> str:
    word = lambda: "".join(rng.choice("ba ke lo mi nu ra se ti vo zen".split()) for _ in range(rng.randint(1, 3)))
    return " ".join(word() for _ in range(rng.randint(low, high))).capitalize() + "."


def labelled_pages(n: int = 330, seed: int = 5) -> list[str]:
    """Pages in many layouts whose parts carry ``data-main`` 1 or 0, which no feature looks at."""
    rng = random.Random(seed)
    pick = rng.choice

    def named(group: str) -> str:
        words = WORDS[group].split()
        word = pick(words)
        if rng.random() < 0.4:
            word += pick(["-", "_"]) + pick(["box", "area", "wrap", "1", "block", "list", "item"])
        return pick([f' class="{word}"', f' id="{word}"', f' class="{pick(["x", "col", "u"])} {word}"'])

    def text(low: int, high: int) -> str:
        return " ".join(_sentence(rng) for _ in range(rng.randint(low, high)))

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{i}">{_sentence(rng, 1, 3)[:-1]}</a></li>' for i in range(k))

    def para() -> str:
        kind = rng.random()
        if kind < 0.72:
            return f"<p>{text(1, 6)}</p>"
        if kind < 0.78:
            level = pick("234")
            return f"<h{level}>{_sentence(rng, 2, 6)[:-1]}</h{level}>"
        if kind < 0.84:
            return "<ul>" + "".join(f"<li>{_sentence(rng)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.88:
            return f"<blockquote><p>{text(1, 2)}</p></blockquote>"
        if kind < 0.92:
            return "<table>" + "".join(f"<tr><td>{_sentence(rng, 1, 4)}</td><td>{_sentence(rng, 1, 4)}</td></tr>" for _ in range(3)) + "</table>"
        if kind < 0.96:
            return f'<p>{text(1, 2)} <a href="/x">{_sentence(rng, 1, 3)}</a> {text(1, 2)}</p>'
        if kind < 0.98:
            return f"<ul>{links(rng.randint(1, 4))}</ul>"
        return f"<pre>{text(1, 2)}</pre>"

    def noise() -> str:
        kind = rng.randrange(22)
        if kind == 0:
            return f'<nav data-main="0">{pick([f"<ul>{links(5)}</ul>", f"<ul>{links(2)}</ul>", text(1, 2), f"<p>{text(1, 3)}</p>"])}</nav>'
        if kind == 1:
            return f'<div{named("w_nav")} data-main="0">{pick([f"<ul>{links(5)}</ul>", text(1, 2), f"<p>{text(1, 3)}</p>"])}</div>'
        if kind in (2, 3):
            tag = pick(["div", "div", "p", "section", "aside"])
            return f'<{tag}{named("w_ad")} data-main="0">{pick(["", "<p>"]) if tag != "p" else ""}{text(1, 3)}</{tag}>'
        if kind == 4:
            return f'<aside{pick(["", named("w_side")])} data-main="0"><h3>{_sentence(rng, 1, 3)}</h3><p>{text(1, 4)}</p><ul>{links(3)}</ul></aside>'
        if kind == 5:
            return f'<div{named("w_side")} data-main="0"><h3>{_sentence(rng, 1, 3)}</h3><p>{text(1, 4)}</p></div>'
        if kind in (6, 7):
            one, tag = pick(["div", "li", "article"]), pick(["div", "section"])
            who = "".join(f'<{one}{pick(["", named("w_comment")])}><p>{text(1, 4)}</p></{one}>' for _ in range(rng.randint(1, 4)))
            return f'<{tag}{named("w_comment")} data-main="0"><h3>{_sentence(rng, 1, 2)}</h3>{who}</{tag}>'
        if kind in (8, 9):
            return f'<div{named("w_notice")} data-main="0">{pick(["<p>", ""])}{text(1, 3)}</div>'
        if kind == 10:
            return f'<form{pick(["", named("w_form")])} data-main="0"><label>{_sentence(rng, 1, 3)}</label><input name=q><p>{text(1, 2)}</p></form>'
        if kind == 11:
            return f'<div{named("w_share")} data-main="0"><ul>{links(3)}</ul></div>'
        if kind in (16, 17, 19, 20, 21):
            tag, group = pick(["ul", "ol", "dl", "table"]), pick(["w_comment", "w_nav", "w_side", "w_share", "w_notice", "w_ad"])
            one = {"dl": "dd", "table": "td"}.get(tag, "li")
            return f'<{tag}{named(group)} data-main="0">' + "".join(f"<{one}>{text(1, 3)}</{one}>" for _ in range(rng.randint(1, 5))) + f"</{tag}>"
        if kind == 18:
            return f'<aside data-main="0">{pick(["", f"<h3>{_sentence(rng, 1, 3)}</h3>"])}' + "".join(f"<p>{text(1, 5)}</p>" for _ in range(rng.randint(1, 3))) + "</aside>"
        if kind == 13:
            return f'<footer data-main="0"><p>{text(1, 4)}</p></footer>'
        if kind == 14:
            return f'<dialog data-main="0"><p>{text(1, 3)}</p></dialog>'
        if kind == 15:
            return f'<div{named(pick(["w_share", "w_frame", "w_form", "w_hidden"]))} data-main="0"><p>{text(1, 4)}</p></div>'
        return f'<div role="{pick(["dialog", "alert", "complementary", "navigation", "search"])}" data-main="0"><p>{text(1, 3)}</p></div>'

    out = []
    for _ in range(n):
        short = rng.random()
        if short < 0.07:
            out.append(pick([_sentence(rng, 2, 8)[:-1], text(1, 2), text(1, 12)]))
            continue
        body = [f"<h1>{_sentence(rng, 3, 9)[:-1]}</h1>"] * (rng.random() < 0.85)
        if short < 0.35:
            body = []
        body += [para() for _ in range(rng.randint(1, 2 if short < 0.35 else 9))]
        if short < 0.35 and "<p>" not in "".join(body):
            body.append(f"<p>{text(1, 2)}</p>")
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            body.insert(rng.randint(0, len(body)), noise())
        inner = "".join(body)
        if rng.random() < 0.25:
            inner = f"<div{named('w_main')}>{inner}</div>" if rng.random() < 0.6 else f"<section>{inner}</section>"
        kind = rng.random() * (0.7 if short < 0.35 else 1)
        if kind < 0.4:
            core = f'<article{pick(["", "", named("w_main")])} data-main="1">{inner}</article>'
        elif kind < 0.55:
            core = f'<main data-main="1">{inner}</main>'
        elif kind < 0.65:
            core = f'<main><article data-main="1">{inner}</article></main>'
        elif kind < 0.9:
            core = f'<div{named("w_main")} data-main="1">{inner}</div>'
        else:
            core = f'<div data-main="1">{inner}</div>'
        head = pick([f'<header data-main="0"><p>{text(1, 1)}</p></header>', f'<div{named("w_frame")} data-main="0">{text(1, 1)}</div>', "",
                     f'<header data-main="0"><h2>{_sentence(rng, 1, 3)}</h2><nav><ul>{links(4)}</ul></nav></header>'])
        foot = pick([f'<footer data-main="0">&copy; {text(1, 2)}</footer>', f'<footer data-main="0"><p>{text(1, 2)}</p></footer>',
                     f'<div{named("w_frame")} data-main="0">&copy; {text(1, 2)}</div>', ""])
        before = "".join(noise() for _ in range(rng.randint(0, 3)))
        after = "".join(noise() for _ in range(rng.randint(0, 3)))
        whole = f"{head}{before}{core}{after}{foot}"
        if rng.random() < 0.3:
            whole = f'<div{pick(["", " id=wrapper", " class=container"])}>{whole}</div>'
        if rng.random() < 0.15:
            out.append(whole if rng.random() < 0.5 else core)
            continue
        out.append(f"<html><head><title>{text(1, 1)}</title></head><body>{whole}</body></html>")
    return out


def train(labelled: list[str]) -> Model:
    """Fit on labelled pages: HTML with ``data-main`` marks."""
    return fit([parse(h) for h in labelled])


@cache
def default_model() -> Model:
    """Fit on the written pages, once in a process."""
    return train(labelled_pages())


def extract(pages: DataFrame, model: Model | None = None, html_col: str = "html", batch: int = 64) -> DataFrame:
    """``pages`` with text (main text) and n_chars (its code points) in place of the HTML."""
    model = model or default_model()
    shared = pages.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    schema = pages.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                parsed = [parse(h.as_py() or "", None) for h in part.column(html_col)]
                texts = [main_text(p, m >= 0.5) for p, m in zip(parsed, content(parsed, shared.value))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*keep, "text", "n_chars"])

    return pages.select(*keep, html_col).mapInArrow(extracted, schema)
