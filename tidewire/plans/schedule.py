"""When the chain runs: two schedules that share one lock, and what an external scheduler or a loop has to call.

Re-clustering runs hourly, placement of new articles in between. No run is made up for, and two runs of one root never
overlap: the lock is a file that only one of them can create. A lock older than a run may last is taken over."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidewire.plans.chain import run_chain


@dataclass(frozen=True)
class Schedule:
    mode: str
    minutes: tuple[int, ...]
    limit: dt.timedelta


# Minutes of the hour, and how long a run may last.
SCHEDULES = (Schedule("recluster", (5,), dt.timedelta(minutes=30)), Schedule("assign", (20, 35, 50), dt.timedelta(minutes=20)))
WAIT = dt.timedelta(minutes=10)
WINDOW_DAYS = 2


def window_of(now: dt.datetime, days: int = WINDOW_DAYS) -> tuple[str, str]:
    """First and last date of the window that ends today, in UTC."""
    today = now.astimezone(dt.UTC).date()
    return (today - dt.timedelta(days=days - 1)).isoformat(), today.isoformat()


def due(now: dt.datetime) -> Schedule | None:
    """The schedule that begins in this minute."""
    return next((s for s in SCHEDULES if now.minute in s.minutes), None)


def next_run(now: dt.datetime) -> tuple[dt.datetime, Schedule]:
    """The first beginning after this minute."""
    at = now.replace(second=0, microsecond=0)
    while True:
        at += dt.timedelta(minutes=1)
        if found := due(at):
            return at, found


class Busy(RuntimeError):
    """Another run holds the lock."""


class RunLock:
    """A file under ``root`` while a run is on. ``wait`` is how long to try, ``limit`` how long a run may hold it."""

    def __init__(self, spark: SparkSession, root: str, limit: dt.timedelta, wait: dt.timedelta = WAIT, pause: float = 5.0):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_lock")
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.limit, self.wait, self.pause, self.own = limit, wait, pause, uuid.uuid4().hex.encode()

    def _age(self) -> float:
        try:
            return time.time() - self.fs.getFileStatus(self.path).getModificationTime() / 1000
        except Exception:  # gone in the meantime
            return 0.0

    def __enter__(self) -> RunLock:
        until = time.time() + self.wait.total_seconds()
        while True:
            try:
                out = self.fs.create(self.path, False)
                out.write(bytearray(self.own))
                out.close()
                return self
            except Exception as e:
                if not self.fs.exists(self.path):
                    raise
                if self._age() > self.limit.total_seconds():
                    self.fs.delete(self.path, False)
                elif time.time() >= until:
                    raise Busy(self.path.toString()) from e
                else:
                    time.sleep(self.pause)

    def __exit__(self, *_) -> None:
        self.fs.delete(self.path, False)


def run_due(spark: SparkSession, root: str, paths: list[str], now: dt.datetime, export_path: str | None = None, run=run_chain) -> dict | None:
    """Run what is due in this minute, if anything, under the lock."""
    found = due(now)
    if found is None:
        return None
    with RunLock(spark, root, found.limit):
        return run(spark, root, *window_of(now), paths, found.mode, export_path)
