"""Helpers shared by the training-data operators.

Rules that every operator here follows: only the columns it names are read from its input (so extra columns
and clashing names do no harm), a null text counts as an empty one, an empty table gives an empty result, and intermediate tables that are read
more than once are cut with ``DataFrame.checkpoint`` into the folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
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


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


BATCH_ROWS, BATCH_BYTES = "1000", "16m"


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer partitions than cores is dealt out once; larger inputs keep their splits (no shuffle).

    Arrow batches of whole texts are kept small, unless the session says otherwise: a worker then holds some megabytes
    of texts at a time, however long the partition is."""
    spark = df.sparkSession
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    want = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df.select(*cols))


def fold(column: str, n: int = 5):
    """crc32 of the id as text, modulo n; null ids fall into fold -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % F.lit(n), F.lit(-1))


def chunks(batch: pa.RecordBatch, chars: int = 2_000_000) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of a batch of (id, text), some ``chars`` at a time; a longer text comes alone, a null one is empty."""
    ids, texts, held = [], [], 0
    for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        text = t.as_py() or ""
        if texts and held + len(text) > chars:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(i)
        texts.append(text)
        held += len(text)
    if texts:
        yield ids, texts


_held: dict[str, Callable[[], None]] = {}


def hold_caches(owner: str, clear: Callable[[], None] = lambda: None) -> None:
    """Called as an operator begins in a Python worker: what other operators have kept in this process is dropped first."""
    for other in [o for o in _held if o != owner]:
        _held.pop(other)()
    _held[owner] = clear
