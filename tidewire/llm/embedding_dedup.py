"""Embedding near-duplicates by sorted projection passes.

1. Equal vectors of one label are one class; its smallest vec_id stands for it.
2. Each pass orders the classes of a label lexicographically by ``BITS`` concatenated random-hyperplane hashes
   (ties by id), deals the order out in ranges and compares every vector with its next ``WINDOW`` neighbours,
   across range borders too.  Verified pairs are united within a range and across passes (star components).
   The number of passes follows for every label from its size and the angles between its vectors, measured on a
   sample, so that a pair at the threshold is missed by all passes with probability ``MISS`` at most.  A label so
   dense that windows would cost more than all its pairs is compared in full, in blocks; only links leave a block.
3. Windows are bounded, groups are not: every component is then compared within itself, all against all, in
   blocks of ``BLOCK`` vectors; only link counts leave a block, never pairs.  So link counts are exact inside a
   component, whatever its size.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
label, link with nothing; vectors of different length never link; rows of one vec_id count as one vector, the
smallest by (label, components) where they differ; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import cut, table
from tidewire.llm.components import components

COSINE, BITS, WINDOW, BLOCK, MISS, LEAST_PASSES = 0.93, 48, 64, 512, 0.002, 6
#: Rows of a range, and vectors of a group of small components.
RANGE_ROWS, GROUP_ROWS = 20_000, 4_000
#: Vectors of a label whose angles are measured; of them those taken as one of a pair; vectors of a block of a label that is compared
#: in full; how many times cheaper one of its products is than one of a window.
SAMPLE, PROBES, FULL_BLOCK, FULL_GAIN = 1024, 128, 2048, 4
SEED = 5


def passes_for(n: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold among n sorted vectors is missed with probability ``miss`` at most."""
    agree = 1 - math.acos(cosine) / math.pi
    hit = agree ** max(1.0, math.log2(max(2, n) / window) + 1)
    return max(LEAST_PASSES, math.ceil(math.log(miss) / math.log1p(-min(hit, 0.999))))


def passes_measured(n: int, x: np.ndarray, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """As passes_for, with the angles of a sample ``x`` of unit vectors; 0 if all pairs are cheaper than the windows.

    Rows that share j bits with a vector are n times the mean of its (1 - angle / pi) ** j; a pair that agrees on so many
    bits that these fit a window is found. The pairs are missed with ``miss`` on average over the vectors."""
    if n <= window + 1:
        return LEAST_PASSES
    agree = 1 - math.acos(cosine) / math.pi
    probes = x[:PROBES]
    same = 1 - np.arccos(np.clip(probes @ x.T, -1, 1)) / np.pi
    np.fill_diagonal(same[:, : len(probes)], 0)
    bits, power = np.full(len(probes), BITS + 1), np.ones_like(same)
    for j in range(1, BITS + 1):
        power *= same
        bits = np.where((bits > BITS) & (n * power.sum(axis=1) / max(1, len(x) - 1) <= window), j, bits)
    # one bit more, as the two may lie at the edges of what shares the key; beyond the key's bits nothing is found
    hit = np.where(bits < BITS, np.minimum(agree ** (bits + 1.0), 0.999), 0.0)
    most = n // (FULL_GAIN * window) + 1
    least = passes_for(n, cosine, window, miss)
    for passes in range(least, max(least, most) + 1):
        if ((1 - hit) ** passes).mean() <= miss:
            return passes
    return 0


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in col), np.float64).reshape(len(col), -1) if len(col) else np.empty((0, 0))


def _united(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of each of n nodes' component under the edges (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while not (root[root] == root).all():
        root = root[root]
    return root


def _window_edges(group: np.ndarray, ids: np.ndarray, x: np.ndarray, window: int, cosine: float, split: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (smallest id, id) of the components that windows find; with ``split``, of pairs across that place only."""
    a, b = [], []
    for d in range(1, min(window, len(ids) - 1) + 1):
        near = np.flatnonzero(group[:-d] == group[d:])
        if split is not None:
            near = near[(near < split) & (near + d >= split)]
        near = near[np.einsum("ij,ij->i", x[near], x[near + d]) >= cosine]
        a.append(near)
        b.append(near + d)
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    root = _united(np.concatenate(a), np.concatenate(b), len(ids))
    at = np.flatnonzero(root != np.arange(len(ids)))
    return ids[root[at]], ids[at]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _links_in(ids: np.ndarray, weight: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray, cosine: float) -> np.ndarray:
    """For each of ``rows`` the weight of other vectors among ``cols`` that it links with."""
    near = x[rows] @ x[cols].T
    # products of normalised vectors, next to the threshold worked out again pair by pair
    edge = np.argwhere(np.abs(near - cosine) < 1e-9)
    for i, j in edge:
        near[i, j] = float(np.dot(x[rows[i]], x[cols[j]]))
    return ((near >= cosine) & (ids[rows][:, None] != ids[cols][None, :])) @ weight[cols]


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    spark = rows.sparkSession
    src = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    src = cut(src.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select("vec_id", "x.label", "x.v"))
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = src.where(F.col("v").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    good = good.withColumn("set", F.xxhash64("label", F.size("v"))).withColumn("key", F.xxhash64("label", "v"))
    # -0.0 and 0.0 may part equal vectors into two classes; these link through the windows like any others
    classes = cut(good.groupBy("set", "key", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")))
    largest = classes.groupBy("set").agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    own = src.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not largest[0]:
        return own.withColumn("kept", F.lit(True))
    sizes = classes.groupBy("set").agg(F.count("*").alias("total"))
    sampled = classes.join(sizes, "set").where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) * F.col("total") < 2 * SAMPLE * (1 << 30))

    def measure(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _unit(np.array(pdf.sort_values("id")["v"].tolist(), dtype=np.float64))
        x = np.random.default_rng(SEED).permutation(x)[:SAMPLE]
        return pd.DataFrame({"set": [pdf["set"].iloc[0]], "passes": [passes_measured(int(pdf["total"].iloc[0]), x, cosine)]})

    plan = cut(sizes.join(sampled.groupBy("set").applyInPandas(measure, "set long, passes int").withColumnRenamed("set", "s"), F.col("set") == F.col("s"), "left").select("set", "total", F.coalesce("passes", F.lit(0)).alias("passes")))
    work = plan.agg(F.max("passes"), F.sum(F.col("passes") * F.col("total"))).first()
    ranges = max(1, math.ceil(work[1] / RANGE_ROWS))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        place = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        for b in batches:
            sets, ids, vectors, passes = b.column(0), b.column(1), b.column(2), np.array(b.column(3))
            size = np.array([len(v) for v in vectors])
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                x = np.array([vectors[int(i)].as_py() for i in at], dtype=np.float64)
                x = _unit(x / np.abs(x).max(axis=1)[:, None])
                raw = pa.array([r.tobytes() for r in x], pa.binary())
                for p in range(int(passes[at].max())):
                    if (int(dim), p) not in planes:
                        planes[int(dim), p] = np.random.default_rng([SEED, int(dim), p]).standard_normal((int(dim), BITS))
                    mine = np.flatnonzero(passes[at] > p)
                    key = ((x[mine] @ planes[int(dim), p]) > 0) @ place
                    take = pa.array(at[mine])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), p), pa.int32()), sets.take(take), pa.array(key), ids.take(take), raw.take(pa.array(mine))], names=["pass", "set", "key", "id", "x"])

    keyed = classes.join(plan.where("passes > 0"), "set").select("set", "id", "v", "passes").mapInArrow(project, "pass int, set long, key long, id long, x binary")
    order = ["pass", "set", "key", "id"]
    dealt = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edges within the range; its first and last WINDOW rows go on, with the number of the border they lie at."""
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        t = pa.Table.from_batches(list(batches), dealt_schema)
        if not t.num_rows:
            return
        t = t.combine_chunks()
        group = np.array(t.column(0)) * np.int64(0x9E3779B97F4A7C1) ^ np.array(t.column(1))
        ids, raw = np.array(t.column(3)), t.column(4)
        size = np.array([len(v.as_py()) for v in raw])
        for dim in np.unique(size):
            at = np.flatnonzero(size == dim)
            a, b = _window_edges(group[at], ids[at], _matrix([raw[int(i)] for i in at]), WINDOW, cosine)
            yield out(a, b, None, None, None, len(a))
        n = t.num_rows
        for border, lo, hi in ((part, 0, min(WINDOW, n)), (part + 1, max(0, n - WINDOW), n)):
            yield out(group[lo:hi], ids[lo:hi], np.full(hi - lo, border), np.arange(hi - lo) + (1_000_000 if border == part else 0), raw.slice(lo, hi - lo), hi - lo)

    def out(a, b, border, place, x, n) -> pa.RecordBatch:
        none = [None] * n
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(none if border is None else border, pa.int64()), pa.array(none if place is None else place, pa.int64()), pa.array(none, pa.binary()) if x is None else pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x],
            names=["a", "b", "border", "place", "x"],
        )

    dealt_schema = pa.schema([("pass", pa.int32()), ("set", pa.int64()), ("key", pa.int64()), ("id", pa.int64()), ("x", pa.binary())])
    found = cut(dealt.mapInArrow(compare, "a long, b long, border long, place long, x binary"))

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", kind="stable", ignore_index=True)
        split = int((pdf["place"] < 1_000_000).sum())
        size = pdf["x"].map(len)
        a, b = [], []
        for dim in size.unique():
            at = np.flatnonzero(size == dim)
            x = np.frombuffer(b"".join(pdf["x"].iloc[at]), np.float64).reshape(len(at), -1)
            e = _window_edges(pdf["a"].to_numpy()[at], pdf["b"].to_numpy()[at], x, WINDOW, cosine, int((at < split).sum()))
            a.append(e[0])
            b.append(e[1])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    edges = found.where("border is null").select("a", "b").unionByName(found.where("border is not null").groupBy("border").applyInPandas(across, "a long, b long"))
    parts = F.ceil(F.col("total") / FULL_BLOCK)
    full = classes.join(plan.where("passes = 0"), "set").withColumn("block", F.pmod(F.xxhash64("id"), parts))
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    full = full.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))

    def all_pairs(key, pdf):
        ids, x = pdf["id"].to_numpy(), _unit(np.array(pdf["v"].tolist(), dtype=np.float64))
        low, high = np.flatnonzero(pdf["block"] == key[1]), np.flatnonzero(pdf["block"] == key[2])
        root = np.arange(len(ids))
        for i in range(0, len(low), BLOCK):
            at = low[i : i + BLOCK]
            near = x[at] @ x[high].T
            for r, c in np.argwhere(np.abs(near - cosine) < 1e-9):
                near[r, c] = float(np.dot(x[at[r]], x[high[c]]))
            r, c = np.nonzero(near >= cosine)
            # what is linked so far stays linked; a block of links leaves as stars
            star = np.flatnonzero(root != np.arange(len(ids)))
            root = _united(np.r_[at[r], star], np.r_[high[c], root[star]], len(ids))
        at = np.flatnonzero(root != np.arange(len(ids)))
        return pd.DataFrame({"a": np.minimum(ids[root[at]], ids[at]), "b": np.maximum(ids[root[at]], ids[at])})

    edges = edges.unionByName(full.select("set", "lo", "hi", "block", "id", "v").groupBy("set", "lo", "hi").applyInPandas(all_pairs, "a long, b long"))
    comp = cut(components(edges))
    members = classes.select("id", "v", "weight").join(comp, "id")
    sizes = comp.groupBy("component").agg(F.count("*").alias("n"))
    members = cut(members.join(sizes, "component"))
    groups = max(1, math.ceil(members.count() / GROUP_ROWS))

    small = members.where(f"n <= {BLOCK}").withColumn("group", F.pmod(F.xxhash64("component"), F.lit(groups)))

    def within(pdf: pd.DataFrame) -> pd.DataFrame:
        got = []
        for _, g in pdf.groupby("component"):
            ids, w, x = g["id"].to_numpy(), g["weight"].to_numpy(), _unit(np.array(g["v"].tolist(), dtype=np.float64))
            at = np.arange(len(ids))
            got.append(pd.DataFrame({"id": ids, "linked": _links_in(ids, w, x, at, at, cosine)}))
        return pd.concat(got) if got else pd.DataFrame({"id": [], "linked": []})

    blocks = F.ceil(F.col("n") / BLOCK)
    large = members.where(f"n > {BLOCK}").withColumn("block", F.pmod(F.xxhash64("id"), blocks))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    large = large.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))

    def between(key, pdf):
        ids, w, x = pdf["id"].to_numpy(), pdf["weight"].to_numpy(), _unit(np.array(pdf["v"].tolist(), dtype=np.float64))
        low, high = np.flatnonzero(pdf["block"] == key[1]), np.flatnonzero(pdf["block"] == key[2])
        got = [pd.DataFrame({"id": ids[low], "linked": _links_in(ids, w, x, low, high, cosine)})]
        if key[1] != key[2]:
            got.append(pd.DataFrame({"id": ids[high], "linked": _links_in(ids, w, x, high, low, cosine)}))
        return pd.concat(got)

    linked = small.groupBy("group").applyInPandas(within, "id long, linked long").unionByName(large.groupBy("component", "lo", "hi").applyInPandas(between, "id long, linked long"))
    linked = linked.groupBy("id").agg(F.sum("linked").alias("linked"))
    by_class = classes.select("id", "key", "v", "set", "weight").join(linked, "id", "left").join(comp, "id", "left")
    by_class = by_class.select("id", "weight", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("component", "id").alias("component"))
    member = good.select("vec_id", "set", "key", "v").join(classes.select("set", "key", "v", "id"), ["set", "key", "v"]).select("vec_id", "id")
    result = member.join(by_class, "id").select("vec_id", (F.col("weight") - 1 + F.col("linked")).alias("n"), "component")
    result = src.select("vec_id").join(result, "vec_id", "left")
    return result.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True))
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of every row of ``embeddings``, within labels."""
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
