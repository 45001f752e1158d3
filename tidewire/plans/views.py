"""The reference's tables as views of the test tables, for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.session import spread

START = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as articles: published doc_id minutes after the start, first line as title, language as category."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(START)) + F.col("doc_id") * 60)
    return d.select(
        F.format_string("a%09d", "doc_id").alias("article_id"), "doc_id", F.col("source").alias("publisher_id"), F.col("source").alias("publisher_name"),
        F.split("text", "\n")[0].alias("title"), F.col("text").alias("content"), F.col("lang").alias("category"), at.alias("published_at"), F.date_format(at, "yyyy-MM-dd").alias("published_date"),
    )


def issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as an issue table: label is the issue, every seventh vector is noise, publishers by id."""
    e = spread(table(spark, sf_dir, "embeddings"))
    noise = F.col("vec_id") % 7 == 0
    publishers = F.when(F.col("label") < 3, F.lit(2)).otherwise(F.lit(9))
    return e.select(
        F.col("vec_id").alias("article_id"), F.concat(F.lit("p"), (F.col("vec_id") % publishers).cast("string")).alias("publisher_id"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("vec_id") % 3).cast("int")), "yyyy-MM-dd").alias("published_date"),
        F.when(noise, -1).otherwise(F.col("label")).cast("int").alias("issue_local"), F.col("embedding").alias("vector"),
    )
