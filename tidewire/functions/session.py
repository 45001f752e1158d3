"""Session helpers: the shared checkpoint folder, lineage cuts, scans with enough partitions."""

from __future__ import annotations

import math
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the session's own setting. A temporary one only where none is set and driver and
    executors are one process; on a cluster without the setting this is an error, as executors share no local folder."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tidewire-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and read them from there: survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BATCH_ROWS, BATCH_BYTES = "1000", "16m"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of whole texts are kept small, unless the session says otherwise: a Python worker then holds some megabytes
    of texts at a time, however long the partition is."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer partitions than cores is dealt out once; larger inputs keep their splits."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


#: Ids that are broadcast to keep or leave out rows, so that wide rows stay where they are; more are met by a shuffle.
BROADCAST_IDS = 500_000


def small(rows: DataFrame) -> DataFrame:
    """A table of one row a group, to be broadcast unless it is too long."""
    rows = cut(rows)
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def _met(rows: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    ids = cut(ids.select(key).distinct())
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)


def only(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is among the ids."""
    return _met(rows, ids, key, "left_semi")


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is not among the ids."""
    return _met(rows, ids, key, "left_anti")


#: Keys with more rows than HEAVY_ROWS, and more than this share of all, are broadcast with their counts: 1 / HEAVY_SHARE of them at most.
HEAVY_ROWS, HEAVY_SHARE = 1000, 1e-5


def join_counts(rows: DataFrame, counts: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the ``count`` of their key. Frequent keys meet their count by a broadcast of bounded size, so no task gets all
    rows of one; the others by a shuffle. ``rows`` is read twice and should be cut."""
    total = counts.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    heavy = F.col(count) > max(HEAVY_ROWS, math.ceil(total * HEAVY_SHARE))
    both = rows.join(F.broadcast(counts.where(heavy)), key, "left")
    met, rest = both.where(F.col(count).isNotNull()), both.where(F.col(count).isNull()).drop(count)
    return met.unionByName(rest.join(counts.where(~heavy), key))
