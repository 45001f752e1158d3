"""Viewpoint groups inside one stance, and the enrichment of whole issues.

Claims are the last evidence sentences without their reporting tails; hard splits follow feelings and wishes, or the
conclusion's act; the rest is grouped by the encoder's similarity. A group is named after the claim that says most."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators.clustering import best_split
from tidewire.operators.vectors import hashed_grams
from tidewire.operators.viewpoint_labels import act, claim, feeling, for_comparison, reason, short_label

MAX_GROUPS, ONE_GROUP, SAME_REASON, DIM = 3, 0.55, 0.75, 256
#: Letters of a claim that count when claims say equally much.
CLAIM_CHARS = 60
#: Texts that are compared with all others at a time.
BLOCK = 512

# Labels of articles without evidence.
FALLBACK = {"positive": "기타 긍정 관점", "neutral": "기타 중립 관점", "negative": "기타 부정 관점"}

Encoder = Callable[[list[str], int], np.ndarray]


def split_by_similarity(texts: list[str], encode_fn: Encoder, most: int) -> list[int]:
    """One group when all pairs are similar enough (of two texts, their reasons too, where both give one); two others split; more
    are split by k-means and silhouette."""
    if len(texts) < 2 or most < 2:
        return [0] * len(texts)
    said = list(dict.fromkeys(texts))
    vectors, place = encode_fn(said, DIM), {t: k for k, t in enumerate(said)}
    at = np.array([place[t] for t in texts])
    near = _all_near(vectors, np.bincount(at))
    if len(texts) > 2:
        return [0] * len(texts) if near else best_split(vectors[at].astype(np.float64), most).tolist()
    reasons = [r for t in texts if (r := reason(t))]
    if near and len(reasons) == 2:
        x = encode_fn(reasons, DIM)
        near = x[0] @ x[1] >= SAME_REASON
    return [0, 0] if near else [0, 1]


def _all_near(vectors: np.ndarray, times: np.ndarray) -> bool:
    """Whether all pairs of different texts, and of a text that comes several times, are similar enough."""
    for lo in range(0, len(vectors), BLOCK):
        near = vectors[lo : lo + BLOCK] @ vectors.T >= ONE_GROUP
        own = np.arange(len(near))
        near[own, lo + own] |= times[lo : lo + BLOCK] < 2
        if not near.all():
            return False
    return True


def group_claims(contents: list[str], encode_fn: Encoder = hashed_grams, most: int = MAX_GROUPS, event: str = "") -> list[int]:
    """Group numbers of evidence texts: one group a feeling where there are two or more, else one an act, if these are two to ``most``;
    texts without one fill the groups that are left or join the text that is most similar. Else all are split by similarity."""
    texts = [for_comparison(c, event) for c in contents]
    keys = [feeling(c) for c in contents]
    if len({k for k in keys if k}) < 2:
        keys = [act(c) for c in contents]
    kinds = list(dict.fromkeys(k for k in keys if k))
    if not 2 <= len(kinds) <= most:
        return split_by_similarity(texts, encode_fn, most)
    out = [kinds.index(k) if k else -1 for k in keys]
    loose = [i for i, g in enumerate(out) if g < 0]
    if loose and most > len(kinds):
        for i, g in zip(loose, split_by_similarity([texts[i] for i in loose], encode_fn, most - len(kinds)), strict=True):
            out[i] = len(kinds) + g
    elif loose:
        first: dict[str, int] = {}
        for t, g in zip(texts, out, strict=True):
            if g >= 0:
                first.setdefault(t, g)
        known, groups, free = encode_fn(list(first), DIM), list(first.values()), list(dict.fromkeys(texts[i] for i in loose))
        nearest = {}
        for lo in range(0, len(free), BLOCK):
            part = free[lo : lo + BLOCK]
            nearest.update(zip(part, (encode_fn(part, DIM) @ known.T).argmax(axis=1), strict=True))
        for i in loose:
            out[i] = groups[nearest[texts[i]]]
    return out


def group_label(contents: list[str], event: str) -> str:
    """The label of the claim with most different words besides the event's; longer, then earlier ones win."""
    claims = list(dict.fromkeys(filter(None, map(claim, contents))))
    said = lambda c: (len({w for w in for_comparison(c, event).split() if len(w) > 1}), min(len(c), CLAIM_CHARS))
    return short_label(max(claims, key=said), event) if claims else short_label("", event)


def labels(articles: list[dict], event: str, encode_fn: Encoder = hashed_grams) -> dict[str, str]:
    """article_id -> label of (article_id, stance, evidence) dicts."""
    out = {}
    by_stance = defaultdict(list)
    for a in articles:
        by_stance[a["stance"]].append((a["article_id"], " ".join(a["evidence"]).strip()))
    for stance, rows in by_stance.items():
        able = [(i, c) for i, c in rows if c]
        # an article without evidence takes the fallback, which counts as a group
        groups = group_claims([c for _, c in able], encode_fn, MAX_GROUPS - (len(able) < len(rows)), event) if able else []
        members = defaultdict(list)
        for (_, c), g in zip(able, groups, strict=True):
            members[g].append(c)
        names = {g: group_label(m, event) for g, m in members.items()}
        out.update((i, FALLBACK[stance]) for i, _ in rows)
        out.update((i, names[g]) for (i, _), g in zip(able, groups, strict=True))
    return out


def enrich(rows: DataFrame, events: DataFrame, group: str = "issue_id") -> DataFrame:
    """(group, article_id, stance, stance_confidence, label) of article rows (group, article_id, content) and events
    (group, title): stance in Arrow batches over all articles, labels in one task an issue."""
    from tidewire.operators.stance import classify

    both = rows.select(group, "article_id", "content").join(events.select(group, F.col("title").alias("event_name")), group)
    found = classify(both).drop("content")
    kind, ids = rows.schema[group].dataType.simpleString(), rows.schema["article_id"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("article_id")
        named = labels(pdf[["article_id", "stance", "evidence"]].to_dict("records"), pdf["event_name"].iloc[0] or "")
        return pdf[[group, "article_id", "stance", "stance_confidence"]].assign(label=pdf["article_id"].map(named))

    return found.groupBy(group).applyInPandas(run, f"{group} {kind}, article_id {ids}, stance string, stance_confidence double, label string")
