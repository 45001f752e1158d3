"""Sentences of articles: evidence with its sources, fact numbers, cross-validated facts, speech."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import is_opinion, is_reported, quotes, sentences, speech_type


def explode_sentences(rows: DataFrame, text: str = "content", *keep: str) -> DataFrame:
    """keep..., pos (from 0), sentence."""
    return rows.select(*keep, F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))


def without_opinions(rows: DataFrame) -> DataFrame:
    """Sentence rows without opinions of the writer; reported ones stay."""
    return rows.where(~is_opinion(F.col("sentence")))


def typed_speech(rows: DataFrame) -> DataFrame:
    """Sentence rows that quote or report, with ``speech`` and their quotes."""
    return rows.withColumn("speech", speech_type(F.col("sentence"))).where("speech is not null").withColumn("quotes", quotes(F.col("sentence"))).withColumn("reported", is_reported(F.col("sentence")))


def evidence(rows: DataFrame, group: str) -> DataFrame:
    """(group, sentence, sources, publishers, first): equal sentences with the distinct articles they come from.

    ``first`` is the place of the first one, by (article, position); sources are ordered by article."""
    src = F.struct("article_id", "publisher_name")
    return rows.groupBy(group, "sentence").agg(
        F.array_sort(F.collect_set(src)).alias("sources"), F.countDistinct("publisher_name").alias("publishers"), F.min(F.struct("article_id", "pos")).alias("first")
    )


def cross_validated(found: DataFrame, group: str, limit: int | None = None) -> DataFrame:
    """Evidence of at least two publishers, ranked by their number, then by first place."""
    from pyspark.sql import Window

    out = found.where("publishers >= 2")
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("publishers"), "first", "sentence")))
    return ranked if limit is None else ranked.where(F.col("rank") <= limit)
