"""Micro-batches of arriving articles: each is ingested and placed at stored issues; state is the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.operators import ingest as I
from tidewire.plans.chain import Chain
from tidewire.sources.tables import upsert


def arriving(lines: DataFrame, late: str = "3 days") -> DataFrame:
    """Valid articles of a stream of JSON lines (value), once an id within the late horizon."""
    checked = I.validate(lines.select(F.col("value").alias("record"), F.lit("stream").alias("source_ref"))).where("error is null")
    return checked.withWatermark("published_at", late).dropDuplicatesWithinWatermark(["article_id"])


def start_assign(lines: DataFrame, root: str, start: str, end: str, checkpoint: str, every: str = "15 minutes", once: bool = False) -> StreamingQuery:
    """Upsert every micro-batch and run the assign chain on it; a replayed batch changes nothing (the upsert keeps known ids)."""

    def place(batch: DataFrame, _: int) -> None:
        c = Chain(batch.sparkSession, root, start, end)
        upsert(c.articles, I.gold_rows(batch.drop("error")))
        for stage in (c.preprocess, c.fold, c.embed):
            stage()
        if not c.assign():
            c.cluster()
        for stage in (c.succeed, c.qualify, c.summarize):
            stage()

    writer = arriving(lines).writeStream.foreachBatch(place).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
