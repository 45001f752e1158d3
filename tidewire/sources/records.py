"""Readers of raw records: JSON lines, JSON files, piped CSV and label sheets, each with provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions.text import trim_unicode

#: Endings of files that hold records.
LINE_FILES, WHOLE_FILES = ("jsonl", "ndjson"), ("json",)
#: Columns of the piped article export, in file order.
CSV_COLUMNS = ("publisher_name", "published", "title", "category", "reporter", "link", "article", "extra")


def _bom(c):
    return F.regexp_replace(c, "\\A\ufeff", "")



def read_jsonl(spark: SparkSession, paths: list[str], names: str = "*.{jsonl,ndjson}") -> DataFrame:
    """record (JSON text), source_ref (file:line), source_file, source_place (line number), error: one row a line that is not
    blank; a bad line is an error, not a failure.

    Files are split as usual; a line's number is its place in its split plus the lines of the splits before, which are
    summed in a window of one row a split."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names).text(paths)
    placed = lines.select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    splits = placed.groupBy("f", "b").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = placed.join(splits.select("f", "b", (before - F.col("first") + 1).alias("shift")), ["f", "b"])
    rows = rows.select("f", (F.col("i") + F.col("shift")).alias("n"), trim_unicode(_bom(F.col("value"))).alias("s")).where("s <> ''")
    return _parsed(rows.select("s", F.concat(_path("f"), F.lit(":"), F.col("n").cast("string")).alias("source_ref"), _path("f").alias("source_file"), F.col("n").alias("source_place")), "JSON line is not an object")


def read_json(spark: SparkSession, paths: list[str]) -> DataFrame:
    """record, source_ref, error of whole-file JSON: an object is one row, an array one row an item with ``file[i]``."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(paths, wholetext=True)
    one = files.select(F.input_file_name().alias("f"), F.trim(_bom(F.col("value"))).alias("s"))
    ok = F.try_parse_json("s").isNotNull()
    kind = F.when(~ok, "bad").when(F.col("s").startswith("["), "array").when(F.col("s").startswith("{"), "object").otherwise("other")
    one = one.withColumn("kind", kind)
    items = one.where("kind = 'array'").select("f", F.posexplode(F.from_json("s", "array<string>")).alias("i", "item"))
    items = _parsed(items.select(F.col("item").alias("s"), F.concat(_path("f"), F.lit("["), F.col("i").cast("string"), F.lit("]")).alias("source_ref"), _path("f").alias("source_file"), F.col("i").cast("long").alias("source_place")), "array item is not an object")
    rest = one.where("kind <> 'array'").select(
        F.when(F.col("kind") == "object", F.col("s")).alias("record"), _path("f").alias("source_ref"), _path("f").alias("source_file"), F.lit(0).cast("long").alias("source_place"),
        F.when(F.col("kind") == "bad", "invalid JSON").when(F.col("kind") == "other", "top-level JSON is neither object nor array").alias("error"),
    )
    return items.unionByName(rest)


def _path(c):
    return F.regexp_replace(F.col(c), r"\Afile:/*", "/")


def _parsed(rows: DataFrame, not_object: str) -> DataFrame:
    """s -> record or error."""
    ok = F.coalesce(F.try_parse_json("s").isNotNull(), F.lit(False))
    is_object = ok & F.col("s").startswith("{")
    return rows.select(F.when(is_object, F.col("s")).alias("record"), "source_ref", "source_file", "source_place", F.when(~ok, "invalid JSON").when(~is_object, not_object).alias("error"))


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All records of JSON and JSON-lines files under ``paths``."""
    return read_jsonl(spark, paths).unionByName(read_json(spark, paths))


def read_piped_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The piped export: quoted fields may hold line ends; rows with another number of fields are dropped."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS])
    return spark.read.schema(schema).csv(paths, sep="|", quote='"', escape='"', multiLine=True, header=True, mode="DROPMALFORMED", enforceSchema=True)


def read_pairs(spark: SparkSession, path: str, verdict_prefix: str = "판정") -> DataFrame:
    """article_id_a, article_id_b, same: rows marked O or X in the column whose name begins with the prefix."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    raw = raw.toDF(*[c.lstrip("\ufeff") for c in raw.columns])
    column = next(c for c in raw.columns if c.startswith(verdict_prefix))
    mark = F.upper(trim_unicode(F.col(column)))
    return raw.where(mark.isin("O", "X")).select("article_id_a", "article_id_b", (mark == "O").alias("same"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """article_id, labeler, cluster; of repeated (labeler, article) rows the last in the file holds."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    raw = raw.toDF(*[c.lstrip("\ufeff") for c in raw.columns]).withColumn("_n", F.monotonically_increasing_id())
    w = Window.partitionBy("labeler", "article_id").orderBy(F.desc("_n"))
    return raw.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("article_id", "labeler", "cluster")
