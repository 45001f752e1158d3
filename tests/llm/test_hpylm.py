"""The language model: counts, hand-made probabilities, sums to one, split contexts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewire.llm import hpylm

from .test_operators import ODD, empty, odd  # noqa: F401


def test_hpylm_counts_and_probabilities(spark, odd, empty):  # noqa: F811
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(["the", "of", "and", f"w{r.randrange(80)}"]) for _ in range(30))) for i in range(120)] + [(500, None), (501, ""), (502, "New Word")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {x.doc_id: x for x in hpylm.score(df).collect()}
    tok = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in rows}
    c = Counter(w for i, ws in tok.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tok.items():
        base = sum(math.log10((c.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        x = out[i]
        assert x.n_tokens == len(ws) and x.n_known == sum(c.get(w, 0) > 0 for w in ws) and x.train_tokens == n
        assert math.isclose(x.base_score, base, rel_tol=1e-9) and x.score < 0
    assert hpylm.score(odd).count() == len(ODD) and hpylm.score(empty).count() == 0


def test_hpylm_matches_probabilities_worked_out_by_hand(spark):
    # one training document of words met once: every dish has one table, so nothing is left to chance
    train, held = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 5 != 1), next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    rows = [(train, "a b c"), (held, "A b x c")]
    got = {x.doc_id: x for x in hpylm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    (d, d0), (s, s0), v, n = hpylm.DISCOUNT, hpylm.STRENGTH, 4, 4
    end = "\n"
    pairs = {(end, "a"), ("a", "b"), ("b", "c"), ("c", end)}
    seen = {end, "a", "b", "c"}

    def p(u, w):
        root = ((1 - d0 if w in seen else 0) + (s0 + d0 * n) / (v + 1)) / (s0 + n)
        if u not in seen:
            return root
        return ((1 - d if (u, w) in pairs else 0) + (s + d) * root) / (s + 1)

    for i, text in rows:
        words = [*text.lower().split(), end]
        want = sum(math.log10(p(u, w)) for u, w in zip([end, *words], words, strict=False))
        assert got[i].score == pytest.approx(want, rel=1e-12)
    assert got[held].held_out and not got[train].held_out and got[held].n_known == 4


def test_hpylm_probabilities_sum_to_one_and_tables_fit():
    rng = np.random.default_rng(0)
    ctx, word = np.repeat(np.arange(6), 50), np.tile(np.arange(50), 6)
    n = rng.integers(0, 6, 300).astype(float)
    n[::7] = 3000
    s = hpylm.Seating(n, ctx, 6, 0, 1.0, [1])
    for _ in range(3):
        s.sweep(np.full(300, 1 / 50))
    assert (s.t <= n).all() and ((s.t > 0) == (n > 0)).all() and s.t[::7].mean() > 1
    m = np.bincount(word, s.t, 50)
    r = hpylm.Seating(m, np.zeros(50, int), 1, 1, 1.0, [2])
    for _ in range(3):
        r.sweep(1 / 51)
    root = hpylm.predictive(m, r.t, m.sum(), r.t.sum(), 1 / 51, 1)
    unseen = hpylm.predictive(0, 0, m.sum(), r.t.sum(), 1 / 51, 1)
    assert root.sum() + unseen == pytest.approx(1)
    customers, tables = np.bincount(ctx, n, 6), s.tables()
    low = hpylm.predictive(n, s.t, customers[ctx], tables[ctx], root[word], 0)
    for c in range(6):
        assert low[ctx == c].sum() + hpylm.predictive(0, 0, customers[c], tables[c], unseen, 0) == pytest.approx(1)


def test_hpylm_bundles_seat_as_single_customers_do():
    n, new = np.full(400, 20_000.0), np.full(400, 8.0)
    one, _ = hpylm.seat(n, new, 0.85, np.random.default_rng(1), leap=10**9)
    many, _ = hpylm.seat(n, new, 0.85, np.random.default_rng(2))
    assert many.mean() == pytest.approx(one.mean(), rel=0.02) and many.std() == pytest.approx(one.std(), rel=0.2)


def test_hpylm_splits_frequent_contexts(spark, monkeypatch):
    r = random.Random(3)
    docs = [(i, " ".join(r.choice(["the", "of", f"w{r.randrange(60)}"]) for _ in range(50))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    whole = {x.doc_id: x for x in hpylm.score(df).collect()}
    monkeypatch.setattr(hpylm, "HOT_TOKENS", 300)
    asked = []
    find = hpylm._split_contexts
    monkeypatch.setattr(hpylm, "_split_contexts", lambda *a: asked.append(find(*a)) or asked[-1])
    split = {x.doc_id: x for x in hpylm.score(df).collect()}
    assert len(asked[0]) >= 2 and min(of for _, _, of in asked[0].values()) >= 2
    assert split.keys() == whole.keys()
    for i, x in whole.items():
        assert (x.n_known, x.base_score) == (split[i].n_known, split[i].base_score)
    # a document's score is sampled in small restaurants here; the corpus as a whole keeps its own
    assert sum(x.score for x in split.values()) == pytest.approx(sum(x.score for x in whole.values()), rel=0.02)


def test_hpylm_prefers_what_training_repeats(spark):
    r = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    passage = " ".join(r.choices(words, k=40))
    rows = [(i, (passage if i % 2 else " ".join(r.choices(words, k=40)))) for i in range(200)]
    out = [x for x in hpylm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect() if x.held_out]
    per = lambda odd: np.mean([x.score / x.n_tokens for x in out if x.doc_id % 2 == odd])
    assert per(1) > -0.5 and per(0) < -2
