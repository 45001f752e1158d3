"""Partitioned tables on shared storage: range scans, atomic partition rewrites, idempotent upsert, exports."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the stored tables.
SCHEMAS = {
    "articles": "article_id string, schema_version string, publisher_id string, publisher_name string, source_type string, url string, title string, content string, author string, category string, category_str string, thumbnail_url string, language string, published_at timestamp, published_date string, content_len int, article_id_verified boolean, ingested_at timestamp, source_ref string",
    "clean": "article_id string, publisher_id string, published_date string, content_clean string, content_clean_len int, clean_status string, rules_applied array<string>, removed_chars int, rules_version string, cleaned_at timestamp",
    "dedup": "article_id string, publisher_id string, published_date string, duplicate_of string, duplicate_count int, method string, window_start string, window_end string, deduped_at timestamp",
    "dedup_sig": "article_id string, published_date string, text_sha1 string, shingle_size int, num_perm int, seed int, scheme string, shingle_count int, hashvalues array<bigint>, computed_at timestamp",
    "embedding": "article_id string, publisher_id string, published_date string, vector array<float>, dim int, model string, input_sha1 string, encoded_at timestamp",
    "issue": "article_id string, publisher_id string, published_date string, issue_local int, issue_size int, window_start string, window_end string, clustered_at timestamp",
    "issue_registry": "window_start string, window_end string, article_id string, published_date string, issue_local int, issue_id bigint, status string, succeeded_at timestamp",
    "issue_quality": "article_id string, publisher_id string, published_date string, issue_local int, issue_size int, structured boolean, rescued boolean, rescue_sim float, window_start string, window_end string, qualified_at timestamp",
    "issue_summary": "window_start string, window_end string, issue_local int, issue_id bigint, issue_size int, publishers int, structured boolean, category string, representative string, first_published_at timestamp, last_published_at timestamp, hot_score float, summarized_at timestamp",
}
#: Rows of one task, and file, when a partition is written.
ROWS_PER_FILE = 1_000_000
#: Letters of one task, and file, when a partition is written.
LETTERS_PER_FILE = 128_000_000
BY_WINDOW = ("issue_registry", "issue_summary")


class Table:
    """One table under ``root``, partitioned by date (or window start); partitions are rewritten whole.

    A rewrite goes to a staging folder first and is read from there, so a plan may read the partitions that it
    rewrites; the commit replaces just the partitions that have rows (dynamic overwrite)."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name, self.path, self.stage_root = spark, name, f"{root}/{name}", f"{root}/_staging"
        self.ddl = SCHEMAS[name]
        self.key = "window_start" if name in BY_WINDOW else "published_date"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self) -> bool:
        fs, p = self._fs(self.path)
        return fs.exists(p)

    def read(self, start: str | None = None, end: str | None = None, columns: list[str] | None = None) -> DataFrame:
        """Rows of an inclusive range of partitions; an empty range or table gives a typed empty frame. Partition and
        column pruning reach the scan; the schema is fixed, so partition values stay strings."""
        if not self.exists():
            df = self.spark.createDataFrame([], self.ddl)
        else:
            df = self.spark.read.schema(self.ddl).parquet(self.path)
        if start is not None:
            df = df.where(F.col(self.key) >= start)
        if end is not None:
            df = df.where(F.col(self.key) <= end)
        return df.select(*columns) if columns else df

    def partitions(self) -> list[str]:
        """Sorted partition values, from folder names."""
        fs, p = self._fs(self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(self.key + "="))

    def conform(self, rows: DataFrame) -> DataFrame:
        """The table's columns in order and type; missing ones are null."""
        typed = self.spark.createDataFrame([], self.ddl).schema
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in typed])

    def write(self, rows: DataFrame, sort: tuple[str, ...] = ("article_id",)) -> None:
        """Replace the partitions that ``rows`` has, in a fixed order inside each."""
        stage = f"{self.stage_root}/{self.name}-{uuid.uuid4().hex}"
        rows = self.conform(rows)
        cols = rows.columns
        rows.write.option("compression", "zstd").parquet(stage)
        staged = self.spark.read.schema(self.ddl).parquet(stage)
        keys = [k for k in sort if k in cols]
        # one number a partition that is written: large ones are dealt over several tasks and files
        letters = sum((F.coalesce(F.length(f.name), F.lit(0)) for f in staged.schema if f.dataType.simpleString() == "string"), F.lit(0))
        found = staged.groupBy(self.key).agg(F.count("*").alias("rows"), F.sum(letters.cast("long")).alias("letters")).collect()
        files = {r[0]: max(-(-r["rows"] // ROWS_PER_FILE), -(-r["letters"] // LETTERS_PER_FILE)) for r in found}
        if not files:
            return self._drop(stage)
        of = F.try_element_at(F.create_map(*[F.lit(x) for kv in files.items() for x in kv]), F.col(self.key)) if max(files.values()) > 1 else F.lit(1)
        share = F.pmod(F.xxhash64(*[c for c in keys if c in cols] or cols[:1]), F.coalesce(of, F.lit(1)))
        dealt = staged.repartition(F.col(self.key), share).sortWithinPartitions(self.key, *keys)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(self.key).parquet(self.path)
        self._drop(stage)

    def remove(self, values: list[str]) -> None:
        for v in values:
            self._drop(f"{self.path}/{self.key}={v}")

    def _drop(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def max_issue_id(self) -> int:
        return self.read(columns=["issue_id"]).agg(F.coalesce(F.max("issue_id"), F.lit(-1))).first()[0]


def upsert_rows(existing: DataFrame, incoming: DataFrame, on_conflict: str = "keep", key: str = "article_id") -> DataFrame:
    """The table after the upsert: keep leaves known ids as they are, replace takes the new row and drops the old one,
    in whatever partition that is."""
    if on_conflict == "keep":
        return existing.unionByName(incoming.join(existing.select(key), key, "left_anti"))
    if on_conflict == "replace":
        return existing.join(incoming.select(key), key, "left_anti").unionByName(incoming)
    raise ValueError(f"on_conflict must be keep or replace, not {on_conflict}")


def upsert(table: Table, incoming: DataFrame, on_conflict: str = "keep") -> dict[str, int]:
    """Upsert into a date-partitioned table: only partitions of new rows, and of rows that moved away, are rewritten.

    Returns written, skipped and replaced counts."""
    from tidewire.functions.session import cut

    incoming = cut(table.conform(incoming))
    known = cut(table.read(columns=["article_id", "published_date"]).join(incoming.select("article_id"), "article_id", "left_semi"))
    n, hit = incoming.count(), known.count()
    if on_conflict == "keep":
        incoming = incoming.join(known.select("article_id"), "article_id", "left_anti")
        moved = []
    elif on_conflict == "replace":
        moved = [r[0] for r in known.select("published_date").distinct().collect()]
    else:
        raise ValueError(f"on_conflict must be keep or replace, not {on_conflict}")
    dates = sorted({r[0] for r in incoming.select("published_date").distinct().collect()} | set(moved))  # one value a partition
    if dates:
        touched = table.read().where(F.col("published_date").isin(*dates))
        after = cut(upsert_rows(touched, incoming, on_conflict))
        table.write(after, ("published_at", "article_id"))
        table.remove([d for d in moved if after.where(F.col("published_date") == d).isEmpty()])
    return {"written": n - hit, "skipped": hit if on_conflict == "keep" else 0, "replaced": hit if on_conflict == "replace" else 0}


def write_rejects(rejects: DataFrame, path: str) -> bool:
    """source_ref, reason, record as JSON lines, only when there are any."""
    if rejects.isEmpty():
        return False
    rejects.select("source_ref", "reason", "record").write.mode("overwrite").json(path)
    return True


def export_lines(messages: DataFrame, path: str, column: str = "value", overwrite: bool = False, dry_run: bool = False) -> int:
    """JSON lines into a folder that appears at once: written beside it and counted there, then renamed; an existing one is an error
    unless ``overwrite``, and stands aside until the new one is in place."""
    if dry_run:
        return messages.count()
    spark = messages.sparkSession
    Path = spark._jvm.org.apache.hadoop.fs.Path
    final, temp = Path(path), Path(f"{path}.tmp-{uuid.uuid4().hex}")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(final) and not overwrite:
        raise FileExistsError(path)
    try:
        messages.select(column).write.text(temp.toString())
        n = spark.read.text(temp.toString()).count()
        aside = Path(f"{path}.old-{uuid.uuid4().hex}")
        if fs.exists(final):
            fs.rename(final, aside)
        fs.rename(temp, final)
        fs.delete(aside, True)
    finally:
        fs.delete(temp, True)
    return n


class RunMarker:
    """Completion marker of a chain: run id, status, mode, window, seconds and result of every step."""

    def __init__(self, mode: str, start: str, end: str):
        self.state = {"run_id": uuid.uuid4().hex, "status": "running", "mode": mode, "window": [start, end], "steps": []}

    def step(self, name: str, run, *args):
        began = time.time()
        try:
            out = run(*args)
        except Exception:
            self.state["steps"].append({"name": name, "seconds": round(time.time() - began, 3), "rc": 1})
            self.state["status"] = "failed"
            raise
        self.state["steps"].append({"name": name, "seconds": round(time.time() - began, 3), "rc": 0})
        return out

    def write(self, spark: SparkSession, path: str) -> None:
        if self.state["status"] == "running":
            self.state["status"] = "done"
        spark.createDataFrame([(json.dumps(self.state, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)
