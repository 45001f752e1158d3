"""Issues: structured flags, noise rescue, incremental placement, succession of ids, feed rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.operators.vectors import centroids, dot, nearest

NOISE = -1


@dataclass(frozen=True)
class QualityConfig:
    max_publishers: int = 3
    min_size: int = 10
    rescue_sim: float = 0.85
    assign_sim: float = 0.85


@dataclass(frozen=True)
class SuccessionConfig:
    min_shared: int = 2
    min_overlap: float = 0.5


@dataclass(frozen=True)
class FeedConfig:
    publisher_weight: float = 2.0
    tau_hours: float = 24.0


def structured_issues(issue: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """(issue_local, size, publishers) of template issues: few publishers, many articles."""
    rolled = issue.where(F.col("issue_local") >= 0).groupBy("issue_local").agg(F.count("*").alias("size"), F.countDistinct("publisher_id").alias("publishers"))
    return rolled.where((F.col("publishers") <= config.max_publishers) & (F.col("size") >= config.min_size))


def with_sizes(rows: DataFrame) -> DataFrame:
    """issue_size by a pre-aggregated count joined back: no window holds a whole issue."""
    return rows.join(rows.groupBy("issue_local").agg(F.count("*").cast("int").alias("issue_size")), "issue_local")


def qualify(issue: DataFrame, vectors: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """article_id, publisher_id, issue_local, issue_size, structured, rescued, rescue_sim.

    Flags use sizes before the rescue; noise goes to the nearest centroid of an issue that is not structured."""
    flags = structured_issues(issue, config).select("issue_local", F.lit(True).alias("structured"))
    member = issue.select("article_id", "publisher_id", "issue_local")
    free = member.where(F.col("issue_local") >= 0).join(flags, "issue_local", "left_anti").join(vectors.select("article_id", "vector"), "article_id")
    cents = centroids(free, "issue_local")
    lost = member.where(F.col("issue_local") < 0).join(vectors.select("article_id", "vector"), "article_id")
    saved = nearest(lost, cents, "issue_local", config.rescue_sim).withColumnRenamed("issue_local", "to").withColumnRenamed("sim", "rescue_sim")
    out = member.join(saved, "article_id", "left").withColumn("rescued", F.col("to").isNotNull())
    out = with_sizes(out.withColumn("issue_local", F.coalesce("to", "issue_local")).drop("to"))
    return out.join(flags, "issue_local", "left").withColumn("structured", F.coalesce("structured", F.lit(False)))


def assign(issue: DataFrame, vectors: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame | None:
    """The issue rows with new articles placed at their nearest open issue or as noise; None when nothing is new."""
    new = vectors.join(issue.select("article_id"), "article_id", "left_anti")
    if new.isEmpty():
        return None
    flags = structured_issues(issue, config).select("issue_local")
    free = issue.where(F.col("issue_local") >= 0).join(flags, "issue_local", "left_anti").select("article_id", "issue_local").join(vectors.select("article_id", "vector"), "article_id")
    placed = nearest(new, centroids(free, "issue_local"), "issue_local", config.assign_sim).select("article_id", "issue_local")
    added = new.select("article_id", "publisher_id").join(placed, "article_id", "left").withColumn("issue_local", F.coalesce("issue_local", F.lit(NOISE)))
    return with_sizes(issue.select("article_id", "publisher_id", "issue_local").unionByName(added))


# -- succession ----------------------------------------------------------------------------------------------------
def previous_ids(previous: DataFrame | None, own: DataFrame | None) -> DataFrame:
    """(article_id, prev_id): of the window before, overridden by an earlier run of this window."""
    parts = [d.select("article_id", F.col("issue_id").alias("prev_id"), F.lit(k).alias("p")) for k, d in enumerate((previous, own)) if d is not None]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.groupBy("article_id").agg(F.max(F.struct("p", "prev_id")).alias("x")).select("article_id", F.col("x.prev_id").alias("prev_id"))


def votes(issue: DataFrame, prev: DataFrame) -> DataFrame:
    """(issue_local, prev_id, shared, first): members by former id; ``first`` orders ties by (published_date, article_id)."""
    m = issue.where(F.col("issue_local") >= 0).select("issue_local", "article_id", "published_date")
    return m.join(prev, "article_id").groupBy("issue_local", "prev_id").agg(F.count("*").alias("shared"), F.min(F.struct("published_date", "article_id")).alias("first"))


def winners(tally: DataFrame, config: SuccessionConfig = SuccessionConfig()) -> DataFrame:
    """(issue_local, prev_id, shared): the former id with most votes, if shared and its part of all votes suffice."""
    top = tally.groupBy("issue_local").agg(F.sum("shared").alias("overlap"), F.max("shared").alias("shared"))
    best = tally.join(top, ["issue_local", "shared"]).groupBy("issue_local", "shared", "overlap").agg(F.min_by("prev_id", "first").alias("prev_id"))
    ok = (F.col("shared") >= config.min_shared) & (F.col("shared") / F.col("overlap") >= config.min_overlap)
    return best.where(ok).select("issue_local", "prev_id", "shared")


def split_claims(won: DataFrame) -> DataFrame:
    """(issue_local, prev_id): of several issues that claim one id the one with most votes, then the larger label."""
    return won.groupBy("prev_id").agg(F.max(F.struct("shared", "issue_local")).alias("x")).select(F.col("x.issue_local").alias("issue_local"), "prev_id")


def mint(labels: DataFrame, assigned: DataFrame, max_id: int) -> DataFrame:
    """(issue_local, issue_id, status): inherited ids, and new ones above ``max_id`` by ascending label.

    Labels are one row an issue; numbers run over ranges of labels, so no task holds them all."""
    new = labels.join(assigned, "issue_local", "left_anti").select("issue_local").distinct()
    n = max(1, -(-new.count() // 100_000))
    ranged = new.repartitionByRange(n, "issue_local").sortWithinPartitions("issue_local").withColumn("p", F.spark_partition_id())
    if n == 1:
        numbered = ranged.withColumn("issue_id", F.row_number().over(Window.orderBy("issue_local")) + F.lit(max_id))
    else:
        before = ranged.groupBy("p").agg(F.count("*").alias("c")).withColumn("b", F.coalesce(F.sum("c").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        numbered = ranged.join(before, "p").withColumn("issue_id", F.row_number().over(Window.partitionBy("p").orderBy("issue_local")) + F.col("b") + F.lit(max_id))
    numbered = numbered.select("issue_local", F.col("issue_id").cast("long").alias("issue_id"), F.lit("new").alias("status"))
    kept = labels.select("issue_local").distinct().join(assigned, "issue_local").select("issue_local", F.col("prev_id").cast("long").alias("issue_id"), F.lit("inherited").alias("status"))
    return kept.unionByName(numbered)


def succeed(issue: DataFrame, previous: DataFrame | None, own: DataFrame | None, max_id: int, config: SuccessionConfig = SuccessionConfig()) -> DataFrame:
    """article_id, published_date, issue_local, issue_id, status; a rerun of a window keeps the status an id had in it."""
    member = issue.where(F.col("issue_local") >= 0)
    if previous is None and own is None:
        assigned = issue.sparkSession.createDataFrame([], "issue_local int, prev_id long")
    else:
        assigned = split_claims(winners(votes(member, previous_ids(previous, own)), config))
    ids = mint(member.select("issue_local"), assigned, max_id)
    if own is not None:
        old = own.select("issue_id", F.col("status").alias("old")).distinct()
        ids = ids.join(old, "issue_id", "left").withColumn("status", F.when(F.col("status") == "inherited", F.coalesce("old", "status")).otherwise(F.col("status"))).drop("old")
    return member.select("article_id", "published_date", "issue_local").join(ids, "issue_local")


def retired(base: DataFrame, assigned: DataFrame) -> DataFrame:
    """Former ids (issue_id) that no issue carries on."""
    return base.select("issue_id").distinct().join(assigned.select(F.col("prev_id").alias("issue_id")), "issue_id", "left_anti")


# -- feed ----------------------------------------------------------------------------------------------------------
# Category vocabulary and its aliases.
CATEGORIES = ("정치", "경제", "사회", "국제", "연예", "스포츠", "문화", "IT/과학")
OTHER = "OTHER"
ALIASES = {"산업": "경제", "IT과학": "IT/과학"}


def normalize_category(c: Column) -> Column:
    out = F.when(F.coalesce(c, F.lit("")) == "", OTHER)
    for old, new in ALIASES.items():
        out = out.when(c == old, new)
    return out.otherwise(c)


def hot_score(size: Column, publishers: Column, hours: Column, config: FeedConfig = FeedConfig()) -> Column:
    """(log2(1 + size) + weight * log2(1 + publishers)) * exp(-hours / tau), to 4 places."""
    return F.round((F.log2(1 + size) + config.publisher_weight * F.log2(1 + publishers)) * F.exp(-F.greatest(hours, F.lit(0.0)) / config.tau_hours), 4)


def representatives(members: DataFrame) -> DataFrame:
    """(issue_local, representative) of (issue_local, article_id, published_at, vector?): most similar to the centroid, within
    1e-6 of the best the earliest; without vectors the earliest."""
    have = members.where(F.col("vector").isNotNull())
    sims = have.join(centroids(have, "issue_local"), "issue_local").select("issue_local", "article_id", "published_at", dot(F.col("vector"), F.col("centroid")).alias("sim"))
    best = sims.groupBy("issue_local").agg(F.max("sim").alias("best"))
    near = sims.join(best, "issue_local").where(F.col("best") - F.col("sim") < 1e-6).groupBy("issue_local").agg(F.min(F.struct("published_at", "article_id")).alias("r"))
    first = members.groupBy("issue_local").agg(F.min(F.struct("published_at", "article_id")).alias("e"))
    return first.join(near, "issue_local", "left").select("issue_local", F.coalesce(F.col("r.article_id"), F.col("e.article_id")).alias("representative"))


def majority_category(members: DataFrame, fallback: DataFrame) -> DataFrame:
    """(issue_local, category) of (issue_local, article_id, published_date, category): the mode without OTHER; a tie that holds
    the representative's value (issue_local, fallback) is that, else the first seen by (published_date, article_id)."""
    named = members.withColumn("c", normalize_category(F.col("category")))
    tally = named.where(F.col("c") != OTHER).groupBy("issue_local", "c").agg(F.count("*").alias("n"), F.min(F.struct("published_date", "article_id")).alias("first"))
    top = tally.groupBy("issue_local").agg(F.max("n").alias("n"))
    tied = tally.join(top, ["issue_local", "n"]).groupBy("issue_local").agg(F.collect_set("c").alias("cs"), F.min_by("c", "first").alias("c0"))
    f = fallback.select("issue_local", normalize_category(F.col("fallback")).alias("f"))
    both = members.select("issue_local").distinct().join(tied, "issue_local", "left").join(f, "issue_local", "left")
    return both.select("issue_local", F.when(F.col("cs").isNull(), F.coalesce("f", F.lit(OTHER))).when(F.array_contains("cs", F.coalesce("f", F.lit(""))), F.col("f")).otherwise(F.col("c0")).alias("category"))


def summarize(quality: DataFrame, vectors: DataFrame, gold: DataFrame, registry: DataFrame | None, config: FeedConfig = FeedConfig()) -> DataFrame:
    """One feed row an issue. The reference time is the latest publication of all gold rows, folded and noise ones too."""
    facts = gold.select("article_id", "published_at", "published_date", "category")
    m = quality.where(F.col("issue_local") >= 0).select("article_id", "publisher_id", "issue_local", "structured").join(facts, "article_id").join(vectors.select("article_id", "vector"), "article_id", "left")
    rolled = m.groupBy("issue_local").agg(
        F.count("*").alias("issue_size"), F.countDistinct("publisher_id").alias("publishers"), F.max("structured").alias("structured"),
        F.min("published_at").alias("first_published_at"), F.max("published_at").alias("last_published_at"),
    )
    rep = representatives(m)
    fallback = rep.join(facts.select(F.col("article_id").alias("representative"), F.col("category").alias("fallback")), "representative", "left").select("issue_local", "fallback")
    out = rolled.join(rep, "issue_local").join(majority_category(m, fallback), "issue_local")
    now = gold.agg(F.max("published_at").alias("now"))
    out = out.join(F.broadcast(now))  # one row
    hours = (F.unix_micros("now") - F.unix_micros("last_published_at")) / 3.6e9
    out = out.withColumn("hot_score", hot_score(F.col("issue_size"), F.col("publishers"), hours, config)).drop("now")
    if registry is None:
        return out.withColumn("issue_id", F.lit(-1).cast("long"))
    ids = registry.select("issue_local", "issue_id").distinct()
    return out.join(ids, "issue_local", "left").withColumn("issue_id", F.coalesce("issue_id", F.lit(-1).cast("long")))
