"""Facts that several publishers report: same-fact tests, number conflicts, greedy merge, sentence gates, LexRank, choice.

The comparisons of one issue run in one grouped task. Issues are bounded (a few hundred articles); two bounds on
the similarity ratio (length and letter counts) stand before every full comparison."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidewire.operators.stance import split

STRICT, RELAXED, TFIDF = 0.8, 0.45, 0.33
REDUNDANT, EDGE, DAMPING, ROUNDS, TOLERANCE, LIMIT = 0.65, 0.1, 0.85, 100, 1e-6, 3

# Patterns of uncertain and boilerplate sentences, words that name no topic.
UNCERTAIN = (r"(?:것|중)으로\s+(?:알려|전해)", r"것으로\s+(?:보인다|예상된다|전망된다)", r"가능성(?:이|도)?\s+(?:거론|제기)", r"관측(?:이|도)?\s+(?:나오|제기)")
BOILERPLATE = (r"저작권자", r"무단\s*전재", r"재배포\s*금지", r"^(?:사진|영상|자료)\s*[=:]", r"^[가-힣A-Za-z·\s]{2,20}\s+기자$", r"\((?:왼쪽|오른쪽|가운데)\)")
OUTLET = r"[가-힣A-Za-z0-9·]{2,20}(?:뉴스|신문|일보|방송|통신)"
TOPIC_STOPWORDS = ("대통령", "정부", "관련", "논의", "발표", "대한", "대해", "이번", "이날", "했다", "한다", "밝혔다", "말했다", "전했다", "추진", "검토")
TRIM = " \t\r\n.,·:;()[]{}<>\"'“”‘’"
NUMBER = r"\d+(?:,\d{3})*(?:\.\d+)?"


def normalize(sentence: str) -> str:
    """NFKC, lower case, no quotation marks, no lone total word, single spaces; numbers as one sign."""
    s = unicodedata.normalize("NFKC", sentence).lower()
    s = re.sub(r"[\"'“”‘’]", "", s)
    s = re.sub(r"(?<!\S)총(?!\S)", "", s)
    return re.sub(NUMBER, "<NUM>", re.sub(r"\s+", " ", s).strip())


def numbers(sentence: str) -> list[str]:
    return re.findall(NUMBER, re.sub(r"\(\s*\d{1,3}\s*[·,/]\s*\d{1,3}\s*기?\s*\)", "", sentence))


def ratio(a: str, b: str, least: float = 0.0) -> float:
    """Matching-blocks ratio of two normalized sentences; 0 where an upper bound already lies under ``least``."""
    if a == b:
        return 1.0
    total = len(a) + len(b)
    if 2 * min(len(a), len(b)) < least * total:
        return 0.0
    m = SequenceMatcher(None, a, b)
    return m.ratio() if least == 0 or m.quick_ratio() >= least else 0.0


def gram_matrix(texts: list[str], sizes: tuple[int, ...] = (2, 3, 4)) -> np.ndarray:
    """Cosines of TF-IDF vectors of letters inside padded words; zeros where no text has any."""
    bags = []
    for t in texts:
        bag: Counter[str] = Counter()
        for w in t.lower().split():
            w = f" {w} "
            for k in sizes:
                bag.update(w[i : i + k] for i in range(max(1, len(w) - k + 1)))
                if len(w) <= k:
                    break
        bags.append(bag)
    df = Counter(g for b in bags for g in b)
    place = {g: i for i, g in enumerate(df)}
    x = np.zeros((len(texts), max(1, len(place))))
    for r, bag in enumerate(bags):
        for g, n in bag.items():
            x[r, place[g]] = n * (np.log((1 + len(texts)) / (1 + df[g])) + 1)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    x = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
    return x @ x.T


def same_fact(a: str, b: str, cosine: float) -> bool:
    r = ratio(a, b, RELAXED)
    return r >= STRICT or (r >= RELAXED and cosine >= TFIDF)


def without_conflicts(evidence: list[dict]) -> list[dict]:
    """Both of two sentences that tell one fact with different numbers go."""
    norm, nums = [normalize(e["sentence"]) for e in evidence], [numbers(e["sentence"]) for e in evidence]
    cos, bad = gram_matrix(norm), set()
    for i in range(len(evidence)):
        for j in range(i + 1, len(evidence)):
            if nums[i] and nums[j] and nums[i] != nums[j] and same_fact(norm[i], norm[j], cos[i, j]):
                bad |= {i, j}
    return [e for i, e in enumerate(evidence) if i not in bad]


def merged(evidence: list[dict]) -> list[dict]:
    """Each sentence joins the first group whose first sentence tells the same with the same (or no) numbers; sources unite."""
    norm, nums = [normalize(e["sentence"]) for e in evidence], [numbers(e["sentence"]) for e in evidence]
    cos = gram_matrix(norm)
    groups: list[tuple[int, dict]] = []
    known: dict[int, set] = {}
    for i, e in enumerate(evidence):
        fits = lambda k, i=i: same_fact(norm[i], norm[k], cos[i, k]) and not (nums[i] and nums[k] and nums[i] != nums[k])
        home = next(((k, g) for k, g in groups if fits(k)), None)
        if home is None:
            groups.append((i, {"sentence": e["sentence"], "sources": list(e["sources"])}))
            known[i] = {s["article_id"] for s in e["sources"]}
        else:
            ids = known[home[0]]
            home[1]["sources"] += [s for s in e["sources"] if s["article_id"] not in ids]
            ids |= {s["article_id"] for s in e["sources"]}
    return [g for _, g in groups]


def publishers(e: dict) -> int:
    return len({s["publisher_name"] for s in e["sources"]})


def common_facts(evidence: list[dict], limit: int | None = None) -> list[dict]:
    """Facts of at least two publishers without number conflicts, most publishers first."""
    found = [e for e in merged(without_conflicts(evidence)) if publishers(e) >= 2]
    return sorted(found, key=publishers, reverse=True)[:limit]


def issue_evidence(articles: list[dict]) -> list[dict]:
    """Distinct sentences in order of first sight, each with its distinct articles."""
    out: dict[str, dict] = {}
    seen: dict[str, set] = {}
    for a in articles:
        for s in split(a["content"]):
            e, ids = out.setdefault(s, {"sentence": s, "sources": []}), seen.setdefault(s, set())
            if a["article_id"] not in ids:
                ids.add(a["article_id"])
                e["sources"].append({"article_id": a["article_id"], "publisher_name": a["publisher_name"]})
    return list(out.values())


def topic_words(titles: list[str]) -> set[str]:
    """Words of two letters and more in at least two titles, or all where no word repeats."""
    n = Counter(w for t in titles for w in {x.lower() for x in re.findall(r"[0-9A-Za-z가-힣]{2,}", t)} - set(TOPIC_STOPWORDS))
    return {w for w, c in n.items() if c >= 2} or set(n)


def passes_gates(sentence: str, outlets: set[str], topic: set[str]) -> bool:
    """Certain, with balanced curly quotes, no boilerplate, about the topic."""
    bare = sentence.strip(TRIM)
    if any(re.search(p, sentence) for p in UNCERTAIN) or sentence.count("“") != sentence.count("”") or sentence.count("‘") != sentence.count("’"):
        return False
    if len(re.sub(r"\s+", "", bare)) < 6 or bare in outlets or re.fullmatch(OUTLET, bare) or any(re.search(p, bare) for p in BOILERPLATE):
        return False
    plain = re.sub(r"[^0-9A-Za-z가-힣]+", "", sentence).lower()
    return sum(w in plain for w in topic) >= min(2, len(topic))


def lexrank(texts: list[str]) -> np.ndarray:
    """Centrality by a damped random walk over similar sentences; sentences without neighbours spread evenly."""
    n = len(texts)
    if n < 2:
        return np.ones(n)
    w = gram_matrix(texts)
    np.fill_diagonal(w, 0)
    w[w < EDGE] = 0
    out = w.sum(axis=1)
    step = np.divide(w, out[:, None], out=np.full_like(w, 1 / n), where=out[:, None] > 0)
    score = np.full(n, 1 / n)
    for _ in range(ROUNDS):
        new = (1 - DAMPING) / n + DAMPING * score @ step
        moved, score = np.abs(new - score).sum(), new
        if moved < TOLERANCE:
            break
    return score


def summary(articles: list[dict], limit: int = LIMIT) -> list[str]:
    """At most ``limit`` facts: by rank, without those that repeat a chosen one."""
    outlets = {str(a["publisher_name"] or "").strip() for a in articles} - {""}
    topic = topic_words([str(a["title"] or "") for a in articles])
    texts = [e["sentence"] for e in common_facts(issue_evidence(articles)) if passes_gates(e["sentence"], outlets, topic)]
    rank = lexrank(texts)
    chosen: list[str] = []
    for i in sorted(range(len(texts)), key=lambda i: -rank[i]):
        if len(chosen) < limit and all(ratio(normalize(texts[i]), normalize(c)) < REDUNDANT for c in chosen):
            chosen.append(texts[i])
    return chosen


def summaries(rows: DataFrame, group: str) -> DataFrame:
    """(group, facts) of article rows (group, article_id, title, content, publisher_name)."""
    kind = rows.schema[group].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("article_id")
        return pd.DataFrame({group: [pdf[group].iloc[0]], "facts": [summary(pdf[["article_id", "title", "content", "publisher_name"]].to_dict("records"))]})

    return rows.select(group, "article_id", "title", "content", "publisher_name").groupBy(group).applyInPandas(run, f"{group} {kind}, facts array<string>")
