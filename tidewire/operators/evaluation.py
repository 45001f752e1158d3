"""Scores against human labels: consensus groups, adjusted Rand index, pair strata, precision and recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.session import cut
from tidewire.operators.clustering import ClusterConfig, cluster_window
from tidewire.operators.graph import components
from tidewire.operators.issues import previous_ids, succeed, votes, winners, with_sizes
from tidewire.operators.vectors import cosine


def _rate(hit: Column, among: Column) -> Column:
    return F.round(F.avg(F.when(among, hit.cast("double"))), 4)


def consensus(labels: DataFrame, min_agree: int) -> DataFrame:
    """(article_id, component) of (labeler, article_id, cluster): articles that ``min_agree`` labelers put together."""
    x, y = labels.alias("x"), labels.alias("y")
    same = (F.col("x.labeler") == F.col("y.labeler")) & (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.article_id") < F.col("y.article_id"))
    pairs = x.join(y, same).groupBy(F.col("x.article_id").alias("a"), F.col("y.article_id").alias("b")).agg(F.count("*").alias("n")).where(F.col("n") >= min_agree)
    comp = components(pairs)
    ids = labels.select("article_id").distinct()
    return ids.join(comp, ids.article_id == comp.id, "left").select("article_id", F.coalesce("component", "article_id").alias("component"))


def adjusted_rand(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n and the adjusted Rand index of two labellings, from the contingency table; 1.0 when both are trivial."""
    cell = pairs.groupBy(a, b).agg(F.count("*").alias("n"))
    c2 = lambda c: F.sum(c * (c - 1) / 2)
    n = F.col("n")
    whole = cell.agg(c2(n).alias("both"), F.sum("n").alias("n"))
    rows = cell.groupBy(a).agg(F.sum("n").alias("n")).agg(c2(n).alias("ra"))
    cols = cell.groupBy(b).agg(F.sum("n").alias("n")).agg(c2(n).alias("rb"))
    x = whole.join(F.broadcast(rows)).join(F.broadcast(cols))  # one row each
    total = n * (n - 1) / 2
    expected = F.col("ra") * F.col("rb") / total
    most = (F.col("ra") + F.col("rb")) / 2
    return x.select("n", F.round(F.when(most == expected, 1.0).otherwise((F.col("both") - expected) / (most - expected)), 6).alias("ari"))


def labeler_agreement(labels: DataFrame) -> DataFrame:
    """One row: pairs of labelers with two articles or more in common, and the mean of their adjusted Rand indices; null without any."""
    x, y = labels.select("article_id", F.col("labeler").alias("la"), F.col("cluster").alias("ca")), labels.select("article_id", F.col("labeler").alias("lb"), F.col("cluster").alias("cb"))
    cell = x.join(y, "article_id").where("la < lb").groupBy("la", "lb", "ca", "cb").agg(F.count("*").alias("n"))
    c2 = F.sum(F.col("n") * (F.col("n") - 1) / 2)
    by = ["la", "lb"]
    both = cell.groupBy(*by).agg(c2.alias("both"), F.sum("n").alias("n")).where("n >= 2")
    for side, name in (("ca", "ra"), ("cb", "rb")):
        both = both.join(cell.groupBy(*by, side).agg(F.sum("n").alias("n")).groupBy(*by).agg(c2.alias(name)), by)
    expected, most = F.col("ra") * F.col("rb") / (F.col("n") * (F.col("n") - 1) / 2), (F.col("ra") + F.col("rb")) / 2
    ari = F.when(most == expected, 1.0).otherwise((F.col("both") - expected) / (most - expected))
    return both.agg(F.count("*").alias("pairs"), F.round(F.avg(ari), 4).alias("ari"))


def noise_as_singletons(rows: DataFrame, label: str, id_col: str) -> DataFrame:
    """``label`` as text, every noise row a cluster of its own."""
    return rows.withColumn(label, F.when(F.col(label) >= 0, F.col(label).cast("string")).otherwise(F.concat(F.lit("noise-"), F.col(id_col).cast("string"))))


def pair_strata(pairs: DataFrame, boundary: float = 0.75) -> DataFrame:
    """One row of rates over (label_a, label_b, sim, same): precision of pairs put together, oversplit rate of near pairs that
    were kept apart, rate of the rest, recall in the sample."""
    together = (F.col("label_a") == F.col("label_b")) & (F.col("label_a") >= 0)
    near = ~together & (F.col("sim") >= boundary)
    rest = ~together & (F.col("sim") < boundary)
    return pairs.agg(
        F.count("*").alias("scored"), F.count(F.when(together, 1)).alias("same_n"), _rate(F.col("same"), together).alias("precision"),
        F.count(F.when(near, 1)).alias("boundary_n"), _rate(F.col("same"), near).alias("oversplit_rate"),
        F.count(F.when(rest, 1)).alias("random_n"), _rate(F.col("same"), rest).alias("human_same_rate"), _rate(together, F.col("same")).alias("recall_in_sample"),
    )


def precision_recall(rows: DataFrame, predicted: str, actual: str) -> DataFrame:
    """One row: tp, fp, fn, tn, accuracy, precision, recall, f1 of two 0/1 columns."""
    p, a = F.col(predicted) == 1, F.col(actual) == 1
    count = lambda c: F.count(F.when(c, 1))
    x = rows.agg(count(p & a).alias("tp"), count(p & ~a).alias("fp"), count(~p & a).alias("fn"), count(~p & ~a).alias("tn"))
    ratio = lambda u, v: F.round(F.when(v > 0, u / v), 6)
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    return x.select("*", ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def merge_verdicts(votes: DataFrame, least: int = 4) -> DataFrame:
    """(pair_id, o, x, gold) of (pair_id, verdict): O or X with at least ``least`` votes, else ambiguous."""
    n = votes.groupBy("pair_id").agg(F.count(F.when(F.col("verdict") == "O", 1)).alias("o"), F.count(F.when(F.col("verdict") == "X", 1)).alias("x"))
    return n.withColumn("gold", F.when(F.col("o") >= least, "O").when(F.col("x") >= least, "X").otherwise("ambiguous"))


#: Bins of a pass over values, and how many of them are sorted on the driver.
BINS, FEW = 1 << 16, 100_000


def _at_ranks(values: DataFrame, column: str, ranks: list[int]) -> list[float]:
    """The values at these places (from 0) of all values in order: counted in bins, the bin of a place in bins again until few are left."""
    x = F.col(column)
    low, high, n = values.agg(F.min(x), F.max(x), F.count(x)).first()
    if n <= FEW or low == high:
        own = [low] * n if low == high and n > FEW else sorted(r[0] for r in values.where(x.isNotNull()).select(x).collect())
        return [own[min(max(k, 0), n - 1)] for k in ranks]
    place = F.least(F.floor((x - low) / (high - low) * BINS), F.lit(BINS - 1))
    counts = values.where(x.isNotNull()).groupBy(place.alias("bin")).count().orderBy("bin").collect()
    wanted: dict[int, list[tuple[int, int]]] = {}
    for at, k in enumerate(ranks):
        before = 0
        for r in counts:
            if before + r["count"] > k:
                break
            before += r["count"]
        wanted.setdefault(r["bin"], []).append((at, k - before))
    out = [0.0] * len(ranks)
    for bin_, inside in wanted.items():
        for (at, _), v in zip(inside, _at_ranks(values.where(place == bin_), column, [k for _, k in inside]), strict=True):
            out[at] = v
    return out


def exact_percentile(values: DataFrame, column: str, share: float) -> float | None:
    """Percentile with linear interpolation, as F.percentile gives it, but no task holds more than ``BINS`` counts; null without values.

    ``values`` is read once for its size and twice or more for the places."""
    n = values.agg(F.count(column)).first()[0]
    if not n:
        return None
    at = share * (n - 1)
    lo, hi = int(at), min(int(at) + 1, n - 1)
    a, b = _at_ranks(values, column, [lo, hi])
    return a if a == b else (lo + 1 - at) * a + (at - lo) * b


def separation(similar: DataFrame, random: DataFrame) -> DataFrame:
    """One row: 10th percentile of similar pairs' sims, 90th of random pairs', and their difference (linear interpolation)."""
    found = (exact_percentile(similar, "sim", 0.1), exact_percentile(random, "sim", 0.9))
    x = similar.sparkSession.createDataFrame([found], "p10 double, p90 double")
    return x.select(F.round("p10", 6).alias("p10"), F.round("p90", 6).alias("p90"), F.round(F.col("p10") - F.col("p90"), 6).alias("separation"))


def labeling_sheet(pairs: DataFrame, n: int, seed: int, bands: tuple[float, float] = (0.75, 0.85)) -> DataFrame:
    """A 2:1:1 sample of n pairs (a, b, sim) from above, between and below the bands, in a seeded order.

    A sampling operator: the limit is its purpose."""
    low, high = bands
    order = F.xxhash64("a", "b", F.lit(seed))
    part = lambda cond, k, name: pairs.where(cond).orderBy(order, "a", "b").limit(k).withColumn("stratum", F.lit(name))
    return part(F.col("sim") >= high, n // 2, "same").unionByName(part((F.col("sim") >= low) & (F.col("sim") < high), n // 4, "boundary")).unionByName(part(F.col("sim") < low, n // 4, "random"))


def pair_labels(pairs: DataFrame, labels: DataFrame, vectors: DataFrame) -> DataFrame:
    """(label_a, label_b, sim, same) of judged pairs (article_id_a, article_id_b, same) whose articles both have a label and a vector."""
    one = labels.select("article_id", F.col("issue_local").alias("label")).join(vectors.select("article_id", "vector"), "article_id")
    both = pairs.join(one.toDF("article_id_a", "label_a", "va"), "article_id_a").join(one.toDF("article_id_b", "label_b", "vb"), "article_id_b")
    return both.select("label_a", "label_b", cosine(F.col("va"), F.col("vb")).alias("sim"), "same")


def sweep(vectors: DataFrame, pairs: DataFrame, sizes: tuple[int, ...] = (3, 5, 8), neighbours: tuple[int, ...] = (15, 30, 50), reduce_fn=None) -> DataFrame:
    """One row a setting (least cluster size, neighbours of the reducer): issues, noise, the largest issue, rates of judged pairs.

    ``reduce_fn(neighbours)`` gives the reducer of that setting; without it the map does not depend on neighbours."""
    out = None
    for nn in neighbours:
        for size in sizes:
            config = ClusterConfig(min_cluster_size=size, neighbours=nn)
            labels = cut(cluster_window(vectors, config, reduce_fn(nn) if reduce_fn else None))
            n = labels.groupBy("issue_local").agg(F.count("*").alias("n"))
            shape = n.agg(F.count(F.when(F.col("issue_local") >= 0, 1)).alias("issues"), F.coalesce(F.max(F.when(F.col("issue_local") < 0, F.col("n"))), F.lit(0)).alias("noise"), F.coalesce(F.max(F.when(F.col("issue_local") >= 0, F.col("n"))), F.lit(0)).alias("largest"))
            rates = pair_strata(pair_labels(pairs, labels, vectors)).select("precision", "same_n", "oversplit_rate", "recall_in_sample")
            row = shape.join(F.broadcast(rates)).select(F.lit(size).alias("min_cluster_size"), F.lit(nn).alias("neighbours"), "*")  # one row each
            out = row if out is None else out.unionByName(row)
    return out.orderBy(F.desc_nulls_last("recall_in_sample"), "min_cluster_size", "neighbours")


def churn(vectors: DataFrame, cuts: list, config: ClusterConfig = ClusterConfig(), points_of=None) -> list[dict]:
    """What each step of a window that fills up (rows with ``arrived_at`` before each cut) does to issue ids: issues, noise, ids created,
    carried on by several issues (splits) and retired. ``points_of(rows)`` gives the points of a fixed map; else each step fits anew."""
    log, own, top = [], None, -1
    for step, until in enumerate(cuts):
        rows = cut(vectors.where(F.col("arrived_at") < F.lit(until)))
        labels = with_sizes(cluster_window(rows, config, points=points_of(rows) if points_of else None)).join(rows.select("article_id", "published_date"), "article_id")
        labels = cut(labels)
        won = cut(winners(votes(labels, previous_ids(None, own)))) if own is not None else None
        ids = cut(succeed(labels, None, own, top))
        issues = ids.select("issue_id", "issue_local").distinct()
        created = issues.where(F.col("issue_id") > top).count()
        log.append({
            "step": step, "rows": rows.count(), "issues": issues.count(), "noise": labels.where("issue_local < 0").count(), "created": created,
            "splits": 0 if won is None else won.groupBy("prev_id").count().where("count > 1").count(),
            "retired": 0 if own is None else own.select("issue_id").distinct().join(issues, "issue_id", "left_anti").count(),
        })
        top = max(top, ids.agg(F.coalesce(F.max("issue_id"), F.lit(-1))).first()[0])
        own = ids
    return log


def round_robin(rows: DataFrame, labelers: int, each: int = 3, place: str = "place") -> DataFrame:
    """``rows`` with ``labelers``: the ``each`` labelers of a row, in turn by its place."""
    return rows.withColumn("labelers", F.transform(F.sequence(F.lit(0), F.lit(each - 1)), lambda k: F.pmod(F.col(place) + k, F.lit(labelers)) + 1))
