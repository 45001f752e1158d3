"""Whole texts go to Python in Arrow batches of bounded size."""

import pandas as pd
from pyspark.sql import functions as F

from tidewire.operators import clean as CL


def test_cleaning_takes_small_batches_of_texts(spark):
    limits = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = {k: spark.conf.get(k, None) for k in limits}
    for k in limits:
        spark.conf.unset(k)

    def letters(batches):
        for pdf in batches:
            yield pd.DataFrame({"n": [len(pdf)], "letters": [int(pdf["content"].str.len().sum())]})

    try:
        for n, length in ((6000, 20), (400, 200_000)):
            texts = spark.range(0, n, numPartitions=1).select(F.col("id").cast("string").alias("article_id"), F.lit("p").alias("publisher_id"), F.lit("2024-01-01").alias("published_date"), F.expr(f"repeat('a', {length})").alias("content"))
            cleaned = CL.clean(texts)
            assert length > 20 or cleaned.where(f"content_clean_len = {length}").count() == n
            got = texts.select("content").mapInPandas(letters, "n long, letters long").toPandas()
            assert got["n"].sum() == n and got["n"].max() <= 1000 and got["letters"].max() <= 17_000_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
