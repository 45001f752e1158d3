"""DOM trees of raw web pages for main-text extraction: a forgiving parser and per-node features.

Only block elements are nodes; inline elements give their text to the block they stand in.  The parser follows
the usual repairs (an open paragraph ends where a block begins, list items and cells end at the next one, an
end tag closes what is still open inside it, unknown end tags are ignored)."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is never page text.
RAW = frozenset("script style noscript template textarea select option button svg iframe object title canvas audio video math".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rt rp s samp small span strike strong sub sup time tt u var".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd td th tr tbody thead tfoot caption".split())
SAME_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[!?/][^>]*>?|<(?=[a-zA-Z])[^>]*\Z""", re.S)
_ATTR = re.compile(r"""(class|id|role|itemprop|aria-label|data-role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PUNCT = re.compile(r"[.,;:!?…]")


class Node:
    __slots__ = ("tag", "tokens", "parent", "children", "depth", "texts", "own", "link", "total", "links", "tags", "punct", "paras", "before", "index", "alike")

    def __init__(self, tag: str, tokens: tuple[str, ...], parent: Node | None, before: int):
        self.tag, self.tokens, self.parent, self.before = tag, tokens, parent, before
        self.children: list[Node] = []
        self.depth = parent.depth + 1 if parent else 0
        #: (order, text) of runs that belong to this block itself
        self.texts: list[tuple[int, str]] = []
        self.own = self.link = self.total = self.links = self.punct = self.paras = self.index = 0
        self.tags = 1
        self.alike = 1.0


def attribute_tokens(attrs: str) -> tuple[str, ...]:
    if "=" not in attrs:
        return ()
    return tuple(p.lower() for _, v in _ATTR.findall(attrs) for p in _PIECE.findall(v))


def parse(page: str) -> list[Node]:
    """Nodes in page order; the first is the root. A text run keeps the order in which it was met."""
    root = Node("#root", (), None, 0)
    nodes, open_, order, seen, at, n = [root], [root], 0, 0, 0, len(page)
    in_link = 0

    def close(k: int) -> None:
        del open_[k:]

    def text(run: str) -> None:
        nonlocal order, seen
        if not run:
            return
        node = open_[-1]
        if "&" in run:
            run = html.unescape(run)
        node.texts.append((order, run))
        order += 1
        size = len(run.strip())
        node.own += size
        seen += size
        if in_link:
            node.link += size
        node.punct += len(_PUNCT.findall(run))

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in INLINE:
                if tag == "a":
                    in_link = 0
                open_[-1].tags += 1
                continue
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    close(k)
                    order += 1
                    break
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
                at = end.start() if end else n
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 1
            open_[-1].tags += 1
            continue
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                open_[-1].texts.append((order, " " if tag != "wbr" else ""))
                order += 1
            if tag != "hr":
                continue
        if tag in ENDS_P:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == "p":
                    close(k)
                    break
                if open_[k].tag not in INLINE and open_[k].tag in ("table", "td", "th", "caption"):
                    break
        if tag in VOID:
            continue
        if tag in SAME_ENDS:
            same, stop = SAME_ENDS[tag]
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag in same:
                    close(k)
                    break
                if open_[k].tag in stop:
                    break
        node = Node(tag, attribute_tokens(m[3]), open_[-1], seen)
        node.texts.append((order, ""))
        order += 1
        open_[-1].children.append(node)
        open_[-1].texts.append((order, "\n"))  # what follows the child is another block
        order += 1
        nodes.append(node)
        if not m[3].endswith("/") or tag not in VOID:
            open_.append(node)
        in_link = 0
    for node in reversed(nodes):
        node.total += node.own
        node.links += node.link
        node.paras += node.tag == "p"
        if node.parent:
            up = node.parent
            up.total += node.total
            up.links += node.links
            up.tags += node.tags
            up.punct += node.punct
            up.paras += node.paras
    return nodes


TAGS = ("article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "nav", "header", "footer", "aside", "form", "table", "tr", "td", "blockquote", "pre", "figure", "figcaption", "body", "html", "dl", "fieldset")
_TAG_AT = {t: k for k, t in enumerate(TAGS)}
ABOVE = ("article", "main", "nav", "header", "footer", "aside", "form", "li")
BASIC = 19
FEATURES = BASIC + len(TAGS) + len(ABOVE)


def features(nodes: list[Node], token_score: dict[str, float]) -> np.ndarray:
    """One row per node: density, links, place, siblings, attribute tokens (own and of ancestors), tag and ancestors' tags."""
    out = np.zeros((len(nodes), FEATURES), np.float32)
    root = nodes[0]
    page = max(1, root.total)
    low, high, above = {}, {}, {}
    for k, n in enumerate(nodes):
        p = n.parent
        score = sum(token_score.get(t, 0.0) for t in n.tokens)
        if p is None:
            low[id(n)] = high[id(n)] = 0.0
            above[id(n)] = 0
            n_sib, mean, index, p_link = 1, n.total, 0.0, 0.0
        else:
            low[id(n)], high[id(n)] = min(low[id(p)], score), max(high[id(p)], score)
            above[id(n)] = above[id(p)] | (1 << ABOVE.index(p.tag) if p.tag in ABOVE else 0)
            n_sib = len(p.children)
            mean = (p.total - p.own) / n_sib
            index = n.index / n_sib
            p_link = p.links / max(1, p.total)
        if n.children:
            kinds = Counter(c.tag for c in n.children)
            for i, c in enumerate(n.children):
                c.index, c.alike = i, kinds[c.tag] / len(n.children)
        own = [
            n.depth, math.log1p(n.total), math.log1p(n.own), n.links / max(1, n.total), math.log1p(n.total / n.tags), math.log1p(n.tags),
            math.log1p(n_sib), index, n.alike, math.log1p(n.total / (1 + mean)), n.total / page, n.punct / (1 + n.total),
            score, low[id(p)] if p else 0.0, high[id(p)] if p else 0.0, p_link, math.log1p(n.paras), n.before / page, n.own / max(1, n.total),
        ]
        row = out[k]
        row[:BASIC] = own
        t = _TAG_AT.get(n.tag)
        if t is not None:
            row[BASIC + t] = 1
        bits = above[id(n)]
        for j in range(len(ABOVE)):
            if bits >> j & 1:
                row[BASIC + len(TAGS) + j] = 1
    return out


def block_texts(nodes: list[Node], keep: list[bool]) -> str:
    """The text of kept nodes: blocks in page order, white space inside a block as one space, joined by one line end."""
    runs = sorted((order, k, run) for k, n in enumerate(nodes) if keep[k] for order, run in n.texts)
    blocks, now, last = [], [], None
    for _, k, run in runs:
        if k != last or run == "\n":
            blocks.append("".join(now))
            now, last = [], k
        if run != "\n" or k == last:
            now.append(run)
    blocks.append("".join(now))
    return "\n".join(x for b in blocks if (x := " ".join(b.split())))
