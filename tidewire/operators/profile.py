"""Data-set profile: counts, lengths, frequent first and last lines, repeated links, dates, group samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.text import is_blank, trim_unicode

LENGTH_BUCKETS = (100, 300, 500, 1000, 2000, 5000)


def profile(articles: DataFrame) -> DataFrame:
    """One row of counts."""
    return articles.agg(
        F.count("*").alias("articles"), F.countDistinct("publisher_id").alias("publishers"), F.min("published_date").alias("first_date"), F.max("published_date").alias("last_date"),
        F.count(F.when(is_blank(F.col("content")), 1)).alias("empty_contents"), F.min(F.length("content")).alias("min_len"), F.max(F.length("content")).alias("max_len"), F.round(F.avg(F.length("content")), 4).alias("avg_len"),
    )


def length_bucket(c: Column) -> Column:
    out = F.lit(f">={LENGTH_BUCKETS[-1]}")
    for b in reversed(LENGTH_BUCKETS):
        out = F.when(F.length(c) < b, f"<{b}").otherwise(out)
    return out


def length_buckets(articles: DataFrame) -> DataFrame:
    return articles.groupBy(length_bucket(F.col("content")).alias("bucket")).agg(F.count("*").alias("n"))


def edge_lines(articles: DataFrame, top: int = 20) -> DataFrame:
    """(place, line, n): the most frequent first and last lines that are not blank; a top-k report."""
    lines = F.filter(F.transform(F.split("content", "\n"), trim_unicode), lambda x: x != "")
    got = articles.select(lines.alias("l")).where(F.size("l") > 0).select(F.explode(F.array(F.struct(F.lit("first").alias("place"), F.element_at("l", 1).alias("line")), F.struct(F.lit("last").alias("place"), F.element_at("l", -1).alias("line")))).alias("e")).select("e.*")
    n = got.groupBy("place", "line").agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("place").orderBy(F.desc("n"), "line"))).where(F.col("r") <= top).drop("r")


def repeated(rows: DataFrame, *cols: str) -> DataFrame:
    """(cols..., n) of values that several rows have."""
    return rows.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def parse_date(c: Column, zone: str = "Asia/Seoul") -> Column:
    """Four written forms, the Korean AM/PM one among them, read as local time of ``zone``, as UTC."""
    text = trim_unicode(c)
    korean = F.replace(F.replace(text, F.lit("오전"), F.lit("AM")), F.lit("오후"), F.lit("PM"))
    forms = [F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")), F.try_to_timestamp(text, F.lit("yyyy.MM.dd HH:mm")), F.try_to_timestamp(korean, F.lit("yyyy.MM.dd. a h:mm"))]
    return F.to_utc_timestamp(F.coalesce(*forms), zone)


def sample_groups(rows: DataFrame, group: str, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """n rows of each group in a seeded order: a sampling operator."""
    w = Window.partitionBy(group).orderBy(F.xxhash64(id_col, F.lit(seed)), id_col)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")
