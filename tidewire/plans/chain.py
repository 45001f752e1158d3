"""The daily chain over stored tables: ingest, clean, fold, embed, cluster or assign, succeed, qualify, summarize, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.session import cut
from tidewire.operators import clean as C
from tidewire.operators import clustering as K
from tidewire.operators import dedup as D
from tidewire.operators import export as O
from tidewire.operators import facts
from tidewire.operators import ingest as I
from tidewire.operators import issues as S
from tidewire.operators import keywords as W
from tidewire.operators import vectors as V
from tidewire.operators import viewpoints as P
from tidewire.operators.fixed_map import MapStore, Reducer
from tidewire.sources.records import read_records
from tidewire.sources.tables import RunMarker, Table, export_lines, upsert, write_rejects


EXPORT_STATE = "issue_id bigint, links array<string>, title string, category string, value string"


class Chain:
    """Stages over one root folder and one inclusive window of dates; every stage may be called alone."""

    def __init__(self, spark: SparkSession, root: str, start: str, end: str):
        self.spark, self.root, self.start, self.end = spark, root, start, end
        t = lambda name: Table(spark, root, name)
        self.articles, self.clean_t, self.dedup_t, self.dedup_sig, self.embedding = t("articles"), t("clean"), t("dedup"), t("dedup_sig"), t("embedding")
        self.issue, self.registry, self.quality, self.summary = t("issue"), t("issue_registry"), t("issue_quality"), t("issue_summary")

    def _in(self, table: Table) -> DataFrame:
        return table.read(self.start, self.end)

    def _window(self, df: DataFrame) -> DataFrame:
        return df.withColumn("window_start", F.lit(self.start)).withColumn("window_end", F.lit(self.end))

    def _dated(self, df: DataFrame, *cols: str) -> DataFrame:
        return df.join(self._in(self.articles).select("article_id", "published_date", *cols), "article_id")

    def ingest(self, paths: list[str], on_conflict: str = "keep") -> dict[str, int]:
        records = cut(read_records(self.spark, paths))
        checked = cut(I.validate(records.where("error is null")))
        bad = records.where("error is not null").select("source_ref", F.col("error").alias("reason"), "record")
        bad = bad.unionByName(checked.where("error is not null").select("source_ref", F.col("error").alias("reason"), "record"))
        write_rejects(bad, f"{self.root}/rejects")
        good = I.first_in_batch(checked.where("error is null"))
        return upsert(self.articles, I.gold_rows(good), on_conflict)

    def preprocess(self) -> None:
        self.clean_t.write(C.clean(self._in(self.articles)).withColumn("cleaned_at", F.current_timestamp()))

    def fold(self, config: D.DedupConfig = D.DedupConfig()) -> None:
        folded = D.fold(self._in(self.articles), self._in(self.clean_t), config, sign=lambda docs: self._signatures(docs, config))
        self.dedup_t.write(self._window(self._dated(folded, "publisher_id")).withColumn("deduped_at", F.current_timestamp()))

    def _signatures(self, docs: DataFrame, config: D.DedupConfig) -> DataFrame:
        """Signatures of docs; those whose text and settings are the stored ones' are not worked out again."""
        stored = cut(self._in(self.dedup_sig))
        signed, fresh = D.refresh_signatures(docs, stored, config)
        signed, fresh = cut(signed), cut(fresh)
        if not fresh.isEmpty():
            settings = {"shingle_size": config.shingle_size, "num_perm": config.num_perm, "seed": config.seed, "scheme": "char-grams"}
            dated = fresh.join(self._in(self.articles).select("article_id", "published_date"), "article_id")
            for name, value in settings.items():
                dated = dated.withColumn(name, F.lit(value))
            kept = stored.join(fresh.select("article_id"), "article_id", "left_anti")
            self.dedup_sig.write(kept.unionByName(self.dedup_sig.conform(dated.withColumn("computed_at", F.current_timestamp()))))
        return signed

    def embed(self, config: V.EncoderConfig = V.EncoderConfig(), encode_fn=V.hashed_grams) -> None:
        """Vectors of what is not folded; those whose input and model are the same stay as they are."""
        folded = self._in(self.dedup_t).where("duplicate_of is not null").select("article_id")
        a = self._in(self.articles).join(folded, "article_id", "left_anti").join(self._in(self.clean_t).select("article_id", "content_clean"), "article_id", "left")
        body = F.coalesce(F.nullif("content_clean", F.lit("")), "content")
        wanted = a.withColumn("input", V.encoder_input(F.col("title"), body, config)).withColumn("input_sha1", V.input_digest(F.col("input"), config))
        have = cut(self._in(self.embedding))
        plan = cut(V.embedding_plan(wanted, have, config.model))
        todo = wanted.join(plan.where("action in ('new', 'changed')").select("article_id"), "article_id", "left_semi")
        fresh = V.encode(todo.select("article_id", "publisher_id", "published_date", "input", "input_sha1"), "input", config, encode_fn).drop("input").withColumn("encoded_at", F.current_timestamp())
        kept = have.join(plan.where("action = 'keep'").select("article_id"), "article_id", "left_semi")
        self.embedding.write(kept.unionByName(fresh))

    def cluster(self, config: K.ClusterConfig = K.ClusterConfig(), reduce_fn=None, fixed: bool = True, reducer: Reducer = Reducer()) -> None:
        """Issues of the window, on the window's fixed map (fitted only where there is none with these settings), or on one fitted anew."""
        vectors = self._in(self.embedding)
        points = None
        if fixed and reduce_fn is None and config.dims and vectors.count() > config.dims:
            points, _ = MapStore(self.spark, self.root, reducer).points(vectors, self.start, config.dims, neighbours=config.neighbours, seed=config.seed)
        labels = K.cluster_window(vectors, config, reduce_fn, points)
        rows = S.with_sizes(labels).join(self._in(self.embedding).select("article_id", "publisher_id", "published_date"), "article_id")
        self.issue.write(self._window(rows).withColumn("clustered_at", F.current_timestamp()))

    def assign(self, config: S.QualityConfig = S.QualityConfig()) -> bool:
        """Place new articles at open issues; False (nothing written) when there is no issue table or nothing new."""
        issue = cut(self._in(self.issue))
        if issue.isEmpty():
            return False
        placed = S.assign(issue, self._in(self.embedding), config)
        if placed is None:
            return True
        rows = placed.drop("publisher_id").join(self._in(self.embedding).select("article_id", "publisher_id", "published_date"), "article_id")
        self.issue.write(self._window(rows).withColumn("clustered_at", F.current_timestamp()))
        return True

    def succeed(self, config: S.SuccessionConfig = S.SuccessionConfig()) -> None:
        starts = self.registry.partitions()
        before = [s for s in starts if s < self.start]
        previous = self.registry.read(before[-1], before[-1]) if before else None
        own = cut(self.registry.read(self.start, self.start)) if self.start in starts else None
        out = S.succeed(self._in(self.issue), previous, own, self.registry.max_issue_id(), config)
        self.registry.write(self._window(out).withColumn("succeeded_at", F.current_timestamp()))

    def qualify(self, config: S.QualityConfig = S.QualityConfig()) -> None:
        out = S.qualify(self._in(self.issue), self._in(self.embedding), config)
        self.quality.write(self._window(self._dated(out)).withColumn("qualified_at", F.current_timestamp()))

    def summarize(self, config: S.FeedConfig = S.FeedConfig()) -> None:
        registry = self.registry.read(self.start, self.start) if self.start in self.registry.partitions() else None
        out = S.summarize(self._in(self.quality), self._in(self.embedding), self._in(self.articles), registry, config)
        self.summary.write(self._window(out).withColumn("summarized_at", F.current_timestamp()), ("issue_local",))

    def messages(self, previous: DataFrame | None = None) -> DataFrame:
        """issue_id, links, title, category, value, reused: one JSON message an issue, with event name, facts, stance and viewpoint of
        its articles. An issue whose links, title and category are those of ``previous`` keeps its message and is not enriched again."""
        rows = O.export_rows(self._in(self.quality), self.registry.read(self.start, self.start), self._in(self.articles), self._in(self.clean_t))
        rows = cut(O.checked_rows(rows.withColumn("content", F.col("content_clean")).withColumn("publisher_name", F.col("publisher_id"))))
        events = cut(W.central_titles(rows.select("issue_id", F.unix_micros("published_at").alias("place"), "title"), "issue_id"))
        top = self.summary.read(self.start, self.start).select("issue_id", "category", F.col("summarized_at").alias("clustered_at"))
        state = cut(O.links_of(rows).join(events.select("issue_id", "title"), "issue_id").join(top, "issue_id"))
        old = state.sparkSession.createDataFrame([], EXPORT_STATE) if previous is None else previous
        same = cut(O.reusable(state, old).where("reuse").select("issue_id"))
        todo = rows.join(same, "issue_id", "left_anti")
        views = O.checked_views(P.enrich(todo, events)).select("article_id", "stance", "label")
        brief = facts.summaries(todo, "issue_id")
        issues = top.join(brief, "issue_id").select("issue_id", "category", F.array_join("facts", " ").alias("fact_summary"), F.col("facts").alias("briefing"), "clustered_at")
        made = O.messages(issues, todo.select("issue_id", "article_id", "url", "published_at").join(views, "article_id")).withColumn("reused", F.lit(False))
        kept = old.join(same, "issue_id", "left_semi").select("issue_id", "value", F.lit(True).alias("reused"))
        return state.drop("clustered_at").join(made.unionByName(kept), "issue_id")

    def export(self, path: str, overwrite: bool = True, reuse: bool = True) -> int:
        """Messages as lines under ``path``; what they were made from is kept beside the tables for the next export."""
        spark, states = self.spark, f"{self.root}/_export"
        fs = (p := spark._jvm.org.apache.hadoop.fs.Path(states)).getFileSystem(spark._jsc.hadoopConfiguration())
        old = spark.read.schema(EXPORT_STATE).parquet(states) if reuse and fs.exists(p) else None
        made = cut(self.messages(old))
        n = export_lines(made, path, overwrite=overwrite)
        made.select("issue_id", "links", "title", "category", "value").write.mode("overwrite").option("compression", "zstd").parquet(states)
        return n


def run_chain(spark: SparkSession, root: str, start: str, end: str, paths: list[str] | None = None, mode: str = "recluster", export_path: str | None = None) -> dict:
    """All stages in order with a completion marker; mode assign falls back to clustering where no issues are stored."""
    c, mark = Chain(spark, root, start, end), RunMarker(mode, start, end)
    try:
        if paths:
            mark.step("ingest", c.ingest, paths)
        for name, stage in (("preprocess", c.preprocess), ("dedup", c.fold), ("embed", c.embed)):
            mark.step(name, stage)
        if mode != "assign" or not mark.step("assign", c.assign):
            mark.step("cluster", c.cluster)
        for name, stage in (("succeed", c.succeed), ("quality", c.qualify), ("feed", c.summarize)):
            mark.step(name, stage)
        if export_path:
            mark.step("export", c.export, export_path)
    finally:
        mark.write(spark, f"{root}/_marker")
    return mark.state
