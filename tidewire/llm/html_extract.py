"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded top-down.

The trees are trained here, on generated pages whose main text is known (``generated_page``: many layouts, class
names, adverts, notices, forms and comments, inside and outside the article), with a fixed seed; no page of the
input is a training page.  They give every node the odds of lying in the main text.  A Viterbi pass over the tree
then picks one state per node - above the main text, in it, or cut out of it - where only above -> in -> cut
may follow from parent to child.  So no node is main text inside something cut out, and none of two nested nodes
can contradict the other.

Defined results: a null or empty page has the empty text; text outside all elements belongs to the root;
repeated rows give repeated results; character references are decoded, also unfinished ones as browsers do.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import spread
from tidewire.llm.html_nodes import Node, block_texts, features, parse

TRAINING_PAGES, SEED = 500, 17
TREES, DEPTH, RATE, LEAF, CUTS = 40, 4, 0.25, 20, 32

# -- training pages ------------------------------------------------------------------------------------------------
MAIN = [("article", ""), ("main", ""), ("article", 'class="post"'), ("div", 'class="content"'), ("div", 'id="content"'), ("div", 'class="article-body"'), ("div", 'class="entry-content"'), ("section", 'class="story"'), ("div", 'class="post-text"'), ("div", 'role="main"'), ("div", 'itemprop="articleBody"'), ("article", 'class="news-item"'), ("td", 'class="text"')]
MENU = [("nav", ""), ("div", 'class="menu"'), ("div", 'class="navbar"'), ("ul", 'class="nav"'), ("div", 'class="breadcrumb"'), ("nav", 'class="top-menu"'), ("div", 'role="navigation"'), ("div", 'id="navigation"')]
HEAD = [("header", ""), ("div", 'class="header"'), ("div", 'id="masthead"'), ("div", 'role="banner"'), ("div", 'class="site-title"'), ("div", 'class="top-bar"')]
SIDE = [("aside", ""), ("div", 'class="sidebar"'), ("div", 'class="widget"'), ("aside", 'class="related"'), ("div", 'class="recommended"'), ("div", 'id="side-column"'), ("div", 'class="trending"'), ("section", 'class="more-stories"')]
FOOT = [("footer", ""), ("div", 'class="footer"'), ("div", 'id="colophon"'), ("div", 'class="copyright"'), ("div", 'role="contentinfo"'), ("div", 'class="legal"')]
AD = [("div", 'class="ad"'), ("div", 'class="ads-box"'), ("div", 'class="advert"'), ("div", 'class="sponsored"'), ("div", 'class="promo"'), ("div", 'id="banner-ad"'), ("ins", 'class="adsbygoogle"'), ("div", 'class="advertisement"'), ("section", 'class="sponsor"'), ("div", 'class="ad-slot"')]
NOTICE = [("div", 'class="cookie-notice"'), ("div", 'id="gdpr"'), ("div", 'class="consent"'), ("div", 'class="popup"'), ("div", 'class="alert"'), ("div", 'class="notice"'), ("div", 'class="cookie-banner"'), ("div", 'role="dialog"'), ("div", 'class="paywall"')]
FORM = [("form", ""), ("form", 'class="search"'), ("form", 'class="newsletter"'), ("div", 'class="subscribe"'), ("form", 'id="login"'), ("div", 'class="signup-form"')]
TALK = [("section", 'class="comments"'), ("div", 'id="comments"'), ("div", 'class="comment-list"'), ("ul", 'class="comments"'), ("div", 'class="discussion"'), ("div", 'id="disqus"'), ("div", 'class="responses"'), ("section", 'id="reader-comments"')]
SHARE = [("div", 'class="share"'), ("ul", 'class="social"'), ("div", 'class="tags"'), ("div", 'class="sharing-buttons"')]


def _sentence(r: random.Random, low: int = 4, high: int = 22) -> str:
    words = ["".join(r.choice("aeiourstnlmdhcpbgéöñ") for _ in range(r.randint(2, 10))) for _ in range(r.randint(low, high))]
    words = [w + "," if r.random() < 0.07 else w for w in words]
    return " ".join(words).capitalize() + r.choice([".", ".", ".", "!", "?"])


def _para(r: random.Random, most: int = 7) -> str:
    return " ".join(_sentence(r) for _ in range(r.randint(1, most)))


def _wrap(r: random.Random, kind: list[tuple[str, str]], inner: str) -> str:
    tag, attrs = r.choice(kind)
    if tag == "td":
        return f"<table><tr><td {attrs}>{inner}</td></tr></table>"
    if tag == "ul" and "<li" not in inner:
        inner = f"<li>{inner}</li>"
    return f"<{tag} {attrs}>{inner}</{tag}>" if attrs else f"<{tag}>{inner}</{tag}>"


def _links(r: random.Random, n: int) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">{_sentence(r, 1, 3)[:-1]}</a></li>' for i in range(n)) + "</ul>"


def _junk(r: random.Random, inside: bool) -> str:
    """One piece of what is not main text; bare words stand in a block of their own or right in the wrapper."""
    kind = r.choice(["ad", "ad", "notice", "form", "share", "side"] if inside else ["menu", "head", "side", "ad", "notice", "form", "talk", "share"])
    bare = lambda s: s if r.random() < 0.5 else f"<p>{s}</p>"
    return {
        "ad": lambda: _wrap(r, AD, bare(_para(r, 3)) if r.random() < 0.8 else f'<a href="/x">{_sentence(r)}</a>'),
        "notice": lambda: _wrap(r, NOTICE, bare(_para(r, 3)) + ("<button>OK</button>" if r.random() < 0.5 else "")),
        "form": lambda: _wrap(r, FORM, f"<label>{_sentence(r, 1, 4)}</label><input name=q><button>Go</button>" + (bare(_sentence(r)) if r.random() < 0.5 else "")),
        "share": lambda: _wrap(r, SHARE, _links(r, r.randint(2, 5))),
        "side": lambda: _wrap(r, SIDE, f"<h3>{_sentence(r, 1, 4)[:-1]}</h3>" + (_links(r, r.randint(2, 8)) if r.random() < 0.6 else bare(_para(r, 3)))),
        "menu": lambda: _wrap(r, MENU, _links(r, r.randint(2, 9))),
        "head": lambda: _wrap(r, HEAD, f"<h1>{_sentence(r, 1, 4)[:-1]}</h1>" * (r.random() < 0.4) + bare(_sentence(r, 2, 8))),
        "talk": lambda: _wrap(r, TALK, f"<h3>{r.randint(1, 90)} comments</h3>" * (r.random() < 0.6) + "".join(f'<div class="comment"><b>{_sentence(r, 1, 2)[:-1]}</b>{bare(_para(r, 4))}</div>' if r.random() < 0.6 else f"<li>{bare(_para(r, 3))}</li>" for _ in range(r.randint(1, 6)))),
    }[kind]()


def generated_page(r: random.Random) -> str:
    """A page with ``data-role="x-main"`` on its main element and ``data-role="x-cut"`` on what is to be cut out of it."""
    title = _sentence(r, 3, 12)[:-1]
    body = [f"<h1>{title}</h1>"] if r.random() < 0.8 else []
    if body and r.random() < 0.2:
        body = [f"<header>{body[0]}<p>{_sentence(r, 2, 6)}</p></header>"]
    for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
        kind = r.random()
        if kind < 0.78:
            text = _para(r)
            body.append(f"<p>{text}</p>" if r.random() < 0.8 else f"<p><b>{text}<br>" if r.random() < 0.5 else f"<div>{text}</div>")
        elif kind < 0.86:
            body.append(f"<h2>{_sentence(r, 2, 7)[:-1]}</h2>")
        elif kind < 0.92:
            body.append("<ul>" + "".join(f"<li>{_sentence(r)}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
        elif kind < 0.96:
            body.append(f"<blockquote>{_para(r, 2)}</blockquote>")
        else:
            body.append("<table>" + "".join(f"<tr><td>{_sentence(r, 1, 4)}</td><td>{r.randint(1, 999)}</td></tr>" for _ in range(3)) + "</table>")
    for _ in range(r.choice([0, 0, 0, 1, 2])):
        cut = _junk(r, True)
        body.insert(r.randint(0, len(body)), cut.replace(">", ' data-role="x-cut">', 1))
    tag, attrs = r.choice(MAIN[:3] * 3 + MAIN)
    inner = "".join(body)
    main = f'<{tag} {attrs} data-role="x-main">{inner}</{tag}>'
    if tag == "td":
        main = f"<table><tr>{main}</tr></table>"
    for _ in range(r.choice([0, 0, 1, 2])):
        main = _wrap(r, [("div", ""), ("div", 'class="wrap"'), ("div", 'id="page"'), ("section", ""), ("div", 'class="container"'), ("main", "")], main)
    before = [_wrap(r, MENU, _links(r, r.randint(2, 9)))] * (r.random() < 0.8) + [_junk(r, False) for _ in range(r.randint(0, 3))]
    after = [_junk(r, False) for _ in range(r.randint(0, 3))] + [_wrap(r, FOOT, f"&copy; {_sentence(r, 2, 14)}")] * (r.random() < 0.85)
    r.shuffle(before)
    ends = "</body></html>" if r.random() < 0.85 else ""
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>'</script></head><body>" + "".join(before) + main + "".join(after) + ends


def _labelled(page: str) -> tuple[list[Node], list[bool]]:
    nodes = parse(page)
    inside: dict[int, bool] = {}
    truth = []
    for n in nodes:
        t = n.tokens
        marked = t[-2:] if len(t) >= 2 else ()
        value = True if marked == ("x", "main") else False if marked == ("x", "cut") else inside[id(n.parent)] if n.parent else False
        if marked in (("x", "main"), ("x", "cut")):
            n.tokens = t[:-2]
        inside[id(n)] = value
        truth.append(value)
    return nodes, truth


# -- boosted trees -------------------------------------------------------------------------------------------------
class Trees:
    """Binary logistic gradient boosting over binned features, trees of fixed depth stored as arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 1)[1:-1])) for j in range(x.shape[1])]
        bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        score = np.full(len(y), self.base)
        self.trees = []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree, value = self._grow(bins, y - p, p * (1 - p))
            self.trees.append(tree)
            score += value

    def _grow(self, bins: np.ndarray, grad: np.ndarray, hess: np.ndarray):
        feature, cut = np.zeros(2**DEPTH - 1, np.int32), np.full(2**DEPTH - 1, np.inf, np.float32)
        node, width = np.zeros(len(grad), np.int64), CUTS + 1
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-6)
            at = (node - first) * width
            for j in range(bins.shape[1]):
                if not len(self.cuts[j]):
                    continue
                key = at + bins[:, j]
                g, h, n = (np.bincount(key, w, count * width).reshape(count, width).cumsum(axis=1) for w in (grad, hess, None))
                gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(n < LEAF) | (n[:, -1:] - n < LEAF)] = 0
                gain = gain[:, : len(self.cuts[j])]
                top = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(count), top] > best):
                    best[k] = gain[k, top[k]]
                    feature[first + k], cut[first + k] = j, self.cuts[j][top[k]]
            split = np.array([np.searchsorted(self.cuts[f], c, side="left") if np.isfinite(c) else width for f, c in zip(feature, cut, strict=True)])
            node = 2 * node + 1 + (bins[np.arange(len(node)), feature[node]] > split[node])
        leaf = node - (2**DEPTH - 1)
        g, h = (np.bincount(leaf, w, 2**DEPTH) for w in (grad, hess))
        value = (RATE * g / (h + 1)).astype(np.float32)
        return (feature, cut, value), value[leaf]

    def logit(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - (2**DEPTH - 1)]
        return out


class Model:
    """Token scores and trees, trained on generated pages."""

    def __init__(self, pages: int = TRAINING_PAGES, seed: int = SEED):
        r = random.Random(seed)
        seen = [_labelled(generated_page(r)) for _ in range(pages)]
        good, bad = Counter(), Counter()
        for nodes, truth in seen:
            for n, t in zip(nodes, truth, strict=True):
                (good if t else bad).update(set(n.tokens))
        self.token_score = {t: float(np.clip(np.log((good[t] + 0.5) / (bad[t] + 0.5)), -4, 4)) for t in good | bad if good[t] + bad[t] >= 3}
        x = np.concatenate([features(n, self.token_score) for n, _ in seen])
        self.trees = Trees(x, np.concatenate([t for _, t in seen]).astype(float))


def decode(nodes: list[Node], logit: np.ndarray) -> list[bool]:
    """States of the nodes by a Viterbi pass: 0 above the main text, 1 in it, 2 cut out; from parent to child 0 -> 0, 1, 1 -> 1, 2 and 2 -> 2."""
    place = {id(n): k for k, n in enumerate(nodes)}
    # a node counts by the text that its own state decides on
    weight = np.array([0.2 + np.log1p(n.own) for n in nodes])
    gain = weight * np.clip(logit, -8, 8)  # of being in the main text, against not
    best = np.zeros((len(nodes), 3))
    best[:, 1] = gain
    for k in range(len(nodes) - 1, 0, -1):
        up = place[id(nodes[k].parent)]
        s = best[k]
        best[up] += (max(s[0], s[1]), max(s[1], s[2]), s[2])
    state = [0] * len(nodes)
    state[0] = int(best[0, 1] > best[0, 0])
    for k in range(1, len(nodes)):
        up = state[place[id(nodes[k].parent)]]
        s = best[k]
        state[k] = int(s[1] > s[0]) if up == 0 else (2 if s[2] > s[1] else 1) if up == 1 else 2
    return [s == 1 for s in state]


_model: list[Model] = []


def trained() -> Model:
    if not _model:
        _model.append(Model())
    return _model[0]


def main_text(page: str, model: Model) -> str:
    nodes = parse(page)
    return block_texts(nodes, decode(nodes, model.trees.logit(features(nodes, model.token_score))))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page. The model (some 60 KB) goes out with the function."""
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts: list[str] = []
            for lo in range(0, b.num_rows, 256):
                trees = [parse(t.as_py() or "") for t in b.column(2)[lo : lo + 256]]
                logit = model.trees.logit(np.concatenate([features(t, model.token_score) for t in trees]))
                ends = np.cumsum([len(t) for t in trees])
                texts += [block_texts(t, decode(t, logit[e - len(t) : e])) for t, e in zip(trees, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page of ``pages``."""
    return extract(spread(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")))
