"""Vector operators: dot products, group centroids, nearest centroid, bounded top pairs, encoders, incremental embedding."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Centroids are broadcast up to this many numbers (some 64 MB as doubles); more are compared by a block join.
BROADCAST_NUMBERS = 8_000_000
CENTROID_BLOCK = 2_000


@dataclass(frozen=True)
class EncoderConfig:
    prefix: str = "passage: "
    body_chars: int = 500
    batch: int = 32
    dim: int = 256
    model: str = "hashed-char-ngrams"


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def centroids(rows: DataFrame, group: str, vector: str = "vector") -> DataFrame:
    """(group, centroid): mean of the members' vectors, made a unit vector; groups with a zero mean are left out.

    Sums run by (group, dimension) with partial aggregates, so a hot group costs one row a dimension and task."""
    flat = rows.select(group, F.posexplode(vector).alias("d", "x")).groupBy(group, "d").agg(F.avg(F.col("x").cast("double")).alias("m"))
    mean = flat.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "m"))), lambda e: e["m"]).alias("mean"))
    return mean.withColumn("len", norm(F.col("mean"))).where("len > 0").select(group, F.transform("mean", lambda x: x / F.col("len")).alias("centroid"))


def nearest(points: DataFrame, cents: DataFrame, group: str, min_sim: float, id_col: str = "article_id", vector: str = "vector") -> DataFrame:
    """(id, group, sim): each point's most similar centroid with sim >= min_sim; of equal ones the smallest group.

    Centroids travel as one broadcast row list when small (their count is checked); else in blocks, whose
    best answers are reduced by a maximum."""
    n = cents.count()
    dim = len(cents.select("centroid").first()[0]) if n else 0
    blocks = max(1, -(-n // CENTROID_BLOCK)) if n * dim > BROADCAST_NUMBERS else 1
    packed = cents.withColumn("block", F.pmod(F.xxhash64(group), F.lit(blocks))).groupBy("block").agg(F.collect_list(F.struct(group, "centroid")).alias("cs"))
    best_of = lambda cs: F.aggregate(
        F.transform(F.array_sort(cs), lambda c: F.struct(dot(F.col(vector), c["centroid"]).alias("sim"), c[group].alias("g"))),
        F.struct(F.lit(float("-inf")).alias("sim"), F.lit(None).cast(cents.schema[group].dataType).alias("g")),
        lambda a, c: F.when(c["sim"] > a["sim"], c).otherwise(a),
    )
    if blocks == 1:
        both = points.select(id_col, vector).join(F.broadcast(packed.select("cs")))
        found = both.select(id_col, best_of(F.col("cs")).alias("b")).select(id_col, F.col("b.g").alias(group), F.col("b.sim").alias("sim"))
    else:
        copies = points.select(id_col, vector, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).cast("long").alias("block"))
        found = copies.join(packed, "block").select(id_col, best_of(F.col("cs")).alias("b")).groupBy(id_col).agg(F.max(F.struct(F.col("b.sim"), F.col("b.g"))).alias("b")).select(id_col, F.col("b.g").alias(group), F.col("b.sim").alias("sim"))
    return found.where(F.col("sim") >= min_sim)


def pairs_above(rows: DataFrame, label: str, min_sim: float, id_col: str = "article_id", vector: str = "vector", block: int = 512) -> DataFrame:
    """(a, b, sim) of pairs of one label with cosine of unit vectors >= min_sim: blocks of rows against blocks, in numpy."""
    n = rows.groupBy(label).agg(F.count("*").alias("n"))
    dealt = rows.select(label, F.col(id_col).alias("id"), F.col(vector).alias("v")).join(n, label).withColumn("bs", F.ceil(F.col("n") / block)).withColumn("blk", F.pmod(F.xxhash64("id"), F.col("bs")))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bs") - 1))).withColumn("lo", F.least("blk", "o")).withColumn("hi", F.greatest("blk", "o"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(key, pdf):
        lo, hi = pdf[pdf["blk"] == key[1]], pdf[pdf["blk"] == key[2]]
        if lo.empty or hi.empty:
            return pd.DataFrame({"a": [], "b": [], "sim": []})
        sim = np.array(lo["v"].tolist(), dtype=np.float64) @ np.array(hi["v"].tolist(), dtype=np.float64).T
        i, j = np.nonzero(sim >= min_sim)
        a, b = lo["id"].to_numpy()[i], hi["id"].to_numpy()[j]
        keep = a < b if key[1] == key[2] else a != b
        return pd.DataFrame({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep], "sim": sim[i, j][keep]})

    return dealt.groupBy(label, "lo", "hi").applyInPandas(run, f"a {kind}, b {kind}, sim double")


def encoder_input(title: Column, body: Column, config: EncoderConfig = EncoderConfig()) -> Column:
    return F.concat(title, F.lit("\n"), F.substring(body, 1, config.body_chars))


def input_digest(text: Column, config: EncoderConfig = EncoderConfig()) -> Column:
    return F.sha1(F.concat(F.lit(config.prefix), text))


def hashed_grams(texts: list[str], dim: int) -> np.ndarray:
    """The default encoder: counts of character 3- to 5-grams in hashed places with hashed signs, as unit vectors."""
    import xxhash

    out = np.zeros((len(texts), dim))
    for i, t in enumerate(texts):
        t = f" {t.lower()} "
        for k in (3, 4, 5):
            for j in range(len(t) - k + 1):
                h = xxhash.xxh64_intdigest(t[j : j + k])
                out[i, h % dim] += 1 if h >> 63 else -1
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def encode(rows: DataFrame, text: str = "input", config: EncoderConfig = EncoderConfig(), encode_fn: Callable[[list[str], int], np.ndarray] = hashed_grams) -> DataFrame:
    """``rows`` with a unit ``vector``, ``dim``, ``model``; the encoder is a plug-in that gets lists of texts."""
    from pyspark.sql import types as T

    names = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vectors = [v.tolist() for k in range(0, len(pdf), config.batch) for v in encode_fn([config.prefix + (t or "") for t in pdf[text].iloc[k : k + config.batch]], config.dim)]
            yield pdf.assign(vector=vectors, dim=config.dim, model=config.model)[[*names, "vector", "dim", "model"]]

    schema = T.StructType([*rows.schema.fields, T.StructField("vector", T.ArrayType(T.FloatType())), T.StructField("dim", T.IntegerType()), T.StructField("model", T.StringType())])
    return rows.mapInPandas(run, schema)


def embedding_plan(wanted: DataFrame, existing: DataFrame, model: str) -> DataFrame:
    """(article_id, action): keep where model and input digest are the same; new, changed or remove else."""
    e = existing.select("article_id", F.col("input_sha1").alias("old"), F.col("model").alias("old_model"))
    both = wanted.select("article_id", "input_sha1").join(e, "article_id", "full_outer")
    action = F.when(F.col("input_sha1").isNull(), "remove").when(F.col("old").isNull(), "new").when((F.col("old") == F.col("input_sha1")) & (F.col("old_model") == model), "keep").otherwise("changed")
    return both.select("article_id", action.alias("action"))
