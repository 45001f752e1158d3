"""Export of issues: joins, reuse of unchanged lines, nested messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import is_blank
from tidewire.operators.keywords import STANCES
from tidewire.operators.viewpoint_labels import MAX_LABEL


def export_rows(quality: DataFrame, registry: DataFrame, gold: DataFrame, clean: DataFrame) -> DataFrame:
    """Articles of issues that are neither noise nor structured, with id, facts and a text that is not blank."""
    q = quality.where((F.col("issue_local") >= 0) & ~F.col("structured")).select("article_id", "issue_local")
    r = registry.select("article_id", "issue_id")
    g = gold.select("article_id", "publisher_id", "url", "title", "published_at", "category")
    c = clean.select("article_id", "content_clean").where(~is_blank(F.col("content_clean")))
    return q.join(r, "article_id").join(g, "article_id").join(c, "article_id")


def links_of(rows: DataFrame) -> DataFrame:
    """(issue_id, links): the sorted distinct links of every issue."""
    return rows.groupBy("issue_id").agg(F.array_sort(F.collect_set("url")).alias("links"))


def reusable(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(issue_id, reuse): whether links, title and category are the previous message's; a changed text alone is no change."""
    p = previous.select("issue_id", F.col("links").alias("l"), F.col("title").alias("t"), F.col("category").alias("c"))
    both = current.join(p, "issue_id", "left")
    same = (F.col("links") == F.col("l")) & F.col("title").eqNullSafe(F.col("t")) & F.col("category").eqNullSafe(F.col("c"))
    return both.select("issue_id", F.coalesce(same, F.lit(False)).alias("reuse"))


def checked_rows(rows: DataFrame) -> DataFrame:
    """Article rows of issues before enrichment: the needed columns must be there and ids be text and not null; a bad row fails the job."""
    needed = {"issue_id", "article_id", "title", "content", "publisher_name"}
    if missing := sorted(needed - set(rows.columns)):
        raise ValueError(f"issue articles lack {missing}")
    if rows.schema["article_id"].dataType.simpleString() != "string":
        raise TypeError("article_id must be a string")
    return rows.withColumn("article_id", F.when(F.col("article_id").isNotNull() & F.col("issue_id").isNotNull(), F.col("article_id")).otherwise(F.raise_error(F.lit("an issue's article has no id"))))


def checked_views(views: DataFrame) -> DataFrame:
    """Enriched articles: a known stance, a label of one to eight letters, a confidence from 0 to 1 or null; a bad row fails the job."""
    c = F.col("stance_confidence")
    fault = (
        F.when(~F.coalesce(F.col("stance").isin(*STANCES), F.lit(False)), "stance is invalid")
        .when(F.col("label").isNull() | is_blank(F.col("label")), "label is empty").when(F.length("label") > MAX_LABEL, f"label is longer than {MAX_LABEL} letters")
        .when(c.isNotNull() & (F.isnan(c) | (c < 0) | (c > 1)), "stance_confidence is not from 0 to 1")
    )
    told = F.concat(F.col("article_id").cast("string"), F.lit(": "), fault)
    return views.withColumn("stance", F.when(fault.isNull(), F.col("stance")).otherwise(F.raise_error(told)))


def messages(issues: DataFrame, articles: DataFrame, zone: str = "Asia/Seoul") -> DataFrame:
    """One JSON text an issue: articles (issue_id, url, label, stance, published_at) nested in order of publication."""
    nested = articles.groupBy("issue_id").agg(F.array_sort(F.collect_list(F.struct("published_at", "url", "label", "stance"))).alias("a"))
    items = F.transform("a", lambda x: F.struct(x["url"].alias("link"), x["label"].alias("viewpointGroupLabel"), x["stance"].alias("stance")))
    local = F.concat(F.date_format(F.from_utc_timestamp("clustered_at", zone), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))
    both = issues.join(nested, "issue_id")
    body = F.struct(F.col("issue_id").alias("clusterId"), "category", F.col("fact_summary").alias("factSummary"), F.col("briefing").alias("commonFactsBriefing"), local.alias("clusteredAt"), items.alias("articles"))
    return both.select("issue_id", F.to_json(body).alias("value"))
