"""Command line: ``python -m tidewire.cli STAGE --root R --start D --end D``; exit 1 when there was nothing to do."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from tidewire.plans.chain import Chain, run_chain
from tidewire.plans.schedule import run_due

STAGES = {"preprocess": "preprocess", "dedup": "fold", "embed": "embed", "cluster": "cluster", "assign": "assign", "succeed": "succeed", "quality": "qualify", "feed": "summarize"}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidewire")
    p.add_argument("stage", choices=[*STAGES, "ingest", "export", "chain", "due"])
    p.add_argument("paths", nargs="*")
    p.add_argument("--root", required=True)
    p.add_argument("--start", help="first date; needed but for the stage due")
    p.add_argument("--end", help="last date; needed but for the stage due")
    p.add_argument("--mode", choices=["recluster", "assign"], default="recluster")
    p.add_argument("--on-conflict", choices=["keep", "replace"], default="keep")
    p.add_argument("--out")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("tidewire").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.stage == "due":
        done = run_due(spark, a.root, a.paths, dt.datetime.now(dt.UTC), a.out)
        print(json.dumps(done))
        return 0 if done else 1
    if not (a.start and a.end):
        p.error("--start and --end are needed")
    chain = Chain(spark, a.root, a.start, a.end)
    if a.stage == "ingest":
        done = chain.ingest(a.paths, a.on_conflict)
        print(json.dumps(done))
        return 0 if sum(done.values()) else 1
    if a.stage == "export":
        return 0 if chain.export(a.out or f"{a.root}/export") else 1
    if a.stage == "chain":
        print(json.dumps(run_chain(spark, a.root, a.start, a.end, a.paths, a.mode, a.out)))
        return 0
    return 1 if getattr(chain, STAGES[a.stage])() is False else 0


if __name__ == "__main__":
    sys.exit(main())
