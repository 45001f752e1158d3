"""The pipeline on a small fixture against a plain version of its decisions."""

import random

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tidewire.llm import pii, quality, toxicity

from .test_operators import brute_components


def test_stages_keep_what_a_plain_version_keeps(spark, tmp_path):
    r = random.Random(12)
    docs, labels = [], []
    for i in range(400):
        words = [f"w{r.randrange(900)}" for _ in range(80)]
        bad, low = i % 10 == 0, i % 10 == 1
        if bad:
            words[r.randrange(80)] = words[r.randrange(80)] = "blockhead"
        if low:
            words = ["spam", "spam", "eggs"] * 30
        if i % 10 == 2:
            words[5] = "a@b.com"
        docs.append((i, " ".join(words) + ".", "en", "s", 0))
        labels.append((i, 0 if low else 1, int(bad)))
    docs += [(1000 + k, docs[k][1], "en", "s", 0) for k in (3, 4, 5)] + [(2000, None, None, None, None), (2001, "", "en", "s", 0), docs[7]]
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, cols).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.train(df, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    a, w = toxicity.Automaton(model[0], model[1]), np.array(model[2])
    kept = [d for d in docs if w[-1] + np.dot(w[:-1], toxicity.features(d[1] or "", a)) < 0]
    assert not any("blockhead" in (d[1] or "") for d in kept)
    kept = [d for d in kept if not quality.base_failed((m := quality.measure(d[1] or ""))[0], m[4])]
    comp = brute_components({d[0]: d[1] for d in kept})
    kept = {d[0]: d[1] for d in kept if comp[d[0]][0] == d[0]}
    texts = {i: pii.redact(t, pii.spans(t)) for i, t in kept.items()}
    assert any("[EMAIL]" in t for t in texts.values())
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    assert dict(zip(out.doc_id, out.length, strict=True)) == want


def test_stages_return_the_columns_of_documents(spark):
    cols = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    df = spark.createDataFrame([(1, "a b c", "en", "s", 5, "x"), (2, None, None, None, None, None)], cols)
    out = corpus_pipeline.stage_pii(spark, df, "")
    assert out.columns == df.columns and out.count() == 2
    assert corpus_pipeline.stage_near_duplicates(spark, df, "").columns == df.columns


def test_registered_queries_cover_the_operators():
    from tidewire.llm.queries import QUERIES, SQL

    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 11)} and set(SQL) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "MinHash near-dedup", "PII", "best-fit packing"]
