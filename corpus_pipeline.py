"""Corpus pipeline over ``documents``: toxicity, quality rules, near-duplicates, personal data, packing.

Counted as part of the training-data subpackage. Each stage takes (spark, docs, sf_dir) and works on all that its
predecessor kept; all but the last return the columns they were given, extra ones too, whatever their names.

Defined results of all stages: an empty table stays empty; a null or empty text is never toxic, fails the quality rules (no
words), has no near-duplicates, holds no personal data and packs as its end token; a text of any length is read whole;
rows with a null id are kept like others and are copies of nothing; labels without a document teach nothing.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import cut, drop_folder, shared_dir, spread
from tidewire.llm.minhash import BROADCAST_IDS, near_duplicates
from tidewire.llm.packing import pack, pieces
from tidewire.llm.pii import redact_text
from tidewire.llm.quality import cutoffs, judged, with_measures
from tidewire.llm.toxicity import train, with_score

#: Models that SQL cannot train stand in the first two stages; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    docs, score = spread(docs), _free(docs, "_toxicity")
    return with_score(docs, train(docs, labels), score_col=score).where(F.col(score) < 0.5).drop(score)


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base limits or a cutoff of their language go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    docs = spread(docs)
    ids = cut(labels.where("quality is not null and doc_id is not null").select("doc_id").distinct())
    few = ids.count() <= BROADCAST_IDS
    known = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    chosen = cutoffs(with_measures(known, ["doc_id", "lang"]), labels)
    whole = with_measures(docs.select(F.struct(*docs.columns).alias("_row")), ["_row"], "_row.text")
    return judged(whole, chosen, "_row.lang").where("kept").select("_row.*")


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays; of its rows with one text, one (the first by
    a hash of the row). Rows of one id with different texts stay."""
    docs = spread(docs)
    found = cut(near_duplicates(docs))
    gone = found.where("not kept").select("doc_id").distinct()
    few = gone.count() <= BROADCAST_IDS
    kept = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti")
    repeated = cut(found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"))
    if repeated.isEmpty():
        return kept
    row = F.struct(*docs.columns)
    twice = kept.join(repeated, "doc_id", "left_semi").select("doc_id", F.coalesce(F.sha2("text", 256), F.lit("")).alias("_digest"), row.alias("_row"))
    once = twice.groupBy("doc_id", "_digest").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row.*")
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once)


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return redact_text(spread(docs))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 4096."""
    return pack(pieces(spread(docs.select("doc_id", "text")), public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", stage_toxicity),
    ("quality rules", stage_quality),
    ("MinHash near-dedup", stage_near_duplicates),
    ("PII", stage_pii),
    ("best-fit packing", stage_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder, read again and removed after use."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}")
        if k:
            drop_folder(spark, f"{folder}/{k - 1}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
