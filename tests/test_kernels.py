"""Clustering and viewpoint kernels: against plain forms, and what they hold in memory."""

import tracemalloc

import numpy as np
import pytest

from tidewire.operators import clustering as K
from tidewire.operators import viewpoints as P
from tidewire.operators.vectors import hashed_grams


def unit(n: int, dim: int, seed: int = 0) -> np.ndarray:
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def peak_mb(f, *a) -> float:
    tracemalloc.start()
    f(*a)
    out = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out


def plain_linkage(x: np.ndarray, cut: float) -> np.ndarray:
    d = 1 - x @ x.T
    np.fill_diagonal(d, np.inf)
    size, label = np.ones(len(x)), np.arange(len(x))
    while True:
        a, b = sorted(divmod(int(d.argmin()), len(x)))
        if not d[a, b] < cut:
            return label
        row = (d[a] * size[a] + d[b] * size[b]) / (size[a] + size[b])
        size[a] += size[b]
        d[a], d[:, a] = row, row
        d[b], d[:, b] = np.inf, np.inf
        d[a, a] = np.inf
        label[label == b] = a


@pytest.mark.parametrize("n, dim, cut", [(200, 3, 0.05), (200, 5, 0.3), (120, 8, 0.3)])
def test_linkage_by_parts(n, dim, cut):
    x = unit(n, dim)
    assert K.average_linkage(x, cut).tolist() == plain_linkage(x, cut).tolist()


def test_linkage_holds_parts_only():
    x = unit(4000, 64)
    assert peak_mb(K.average_linkage, x, 0.3) < 64


def test_tree_and_core_distances_equal_plain_forms(monkeypatch):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(60, 5)) * 0.05 + c for c in rng.normal(size=(60, 5)) * 20])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    seen, partition = [0], np.partition
    monkeypatch.setattr(K.np, "partition", lambda a, *b, **c: (seen.__setitem__(0, seen[0] + a.size), partition(a, *b, **c))[1])
    core = K.core_distances(x, 3, block=64)
    monkeypatch.undo()
    assert np.allclose(core, np.sort(d, axis=1)[:, 2], atol=1e-6) and seen[0] < len(x) ** 2 / 2
    some = slice(0, 700)
    reach = np.maximum(d[some, some], np.maximum(core[some, None], core[None, some]))
    inside, best, total = np.zeros(700, bool), np.full(700, np.inf), 0.0
    at = 0
    for _ in range(699):
        inside[at] = True
        best = np.minimum(best, reach[at])
        at = int(np.where(inside, np.inf, best).argmin())
        total += best[at]
    edges = K.mutual_reachability_tree(x[some], core[some])
    assert len({e[2] for e in edges}) == 699 and abs(sum(e[0] for e in edges) - total) < 1e-6


def test_silhouette_holds_no_square():
    x, label = unit(3000, 16), np.arange(3000) % 3
    assert peak_mb(K.silhouette, x, label) < 20
    u, own = x[:200], label[:200]
    d = 1 - u @ u.T
    plain = []
    for i in range(200):
        a = d[i, own == own[i]].sum() / ((own == own[i]).sum() - 1)
        b = min(d[i, own == k].mean() for k in range(3) if k != own[i])
        plain.append((b - a) / max(a, b))
    assert abs(K.silhouette(u, own) - np.mean(plain)) < 1e-12


def test_equal_claims_are_compared_once():
    texts, sent = ["성공을 기대한다."] * 5000, []

    def encode(t, dim):
        sent.append(len(t))
        return hashed_grams(t, dim)

    assert peak_mb(P.split_by_similarity, texts, encode, 3) < 10 and sent == [1]
    # a text without letters is like no other, nor like itself
    assert P.split_by_similarity(["가"] * 3, lambda t, dim: np.zeros((len(t), dim)), 1) == [0, 0, 0]
    assert not P._all_near(np.zeros((1, 4)), np.array([2])) and P._all_near(np.zeros((1, 4)), np.array([1]))
