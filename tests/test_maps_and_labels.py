"""Fixed maps and their generations, order of ingest, labels of viewpoints, reuse of exports, checks of enrichment, churn and sweep."""

import json

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewire.operators import evaluation as E
from tidewire.operators import export as O
from tidewire.operators import ingest as I
from tidewire.operators import viewpoint_labels as W
from tidewire.operators import viewpoints as P
from tidewire.operators.fixed_map import MapStore, Reducer
from tidewire.sources import records as R
from tidewire.sources import tables as T


def vectors(spark, ids, dim=3):
    return spark.createDataFrame([(f"a{i:02d}", [float(i), float(i * i % 7), 1.0][:dim]) for i in ids], "article_id string, vector array<float>")


def test_map_stays_until_its_settings_change(spark, tmp_path):
    calls = []
    stub = Reducer(lambda df, dims: calls.append(dims) or {"shift": [100.0]}, lambda x, m: x[:, :2] + m["shift"][0])
    store = MapStore(spark, str(tmp_path), stub)
    assert store.meta("w") is None and store.starts() == []
    first, fitted = store.points(vectors(spark, range(6)), "w", 2)
    kept = {r.article_id: r.point for r in first.collect()}
    assert fitted and len(kept) == 6 and calls == [2]
    again, fitted = store.points(vectors(spark, range(2, 9)), "w", 2)
    got = {r.article_id: r.point for r in again.collect()}
    assert not fitted and calls == [2] and set(got) == {f"a{i:02d}" for i in range(2, 9)} and all(got[k] == kept[k] for k in got.keys() & kept.keys())
    assert spark.read.parquet(f"{store.active('w')}/points").where("transformed").count() == 3
    _, fitted = store.points(vectors(spark, range(6)), "w", 2, neighbours=9)
    assert fitted and store.meta("w")["neighbours"] == 9 and store.starts() == ["w"]
    assert len([p for p in (tmp_path / "map/window_start=w").iterdir() if p.name.startswith("gen=")]) == 1


def test_half_written_generation_is_not_read(spark, tmp_path):
    store = MapStore(spark, str(tmp_path))
    store.points(vectors(spark, range(6)), "w", 2)
    active = store.active("w")
    (tmp_path / "map/window_start=w/gen=zzz").mkdir()
    assert store.active("w") == active
    (tmp_path / "map/window_start=w/.current.crc").unlink()  # the file system's own checksum of the old pointer
    (tmp_path / "map/window_start=w/current").write_text("gen=zzz")
    assert store.active("w") is None


def test_components_are_those_of_the_matrix(spark):
    from tidewire.operators.clustering import pca_map, project
    from tidewire.operators.fixed_map import apply_components, fit_components

    x = np.random.default_rng(1).normal(size=(40, 6)) * [5, 3, 1, 1, 0.5, 0.2]
    df = spark.createDataFrame([(f"a{i}", v.tolist()) for i, v in enumerate(x)], "article_id string, vector array<double>").repartition(5)
    assert np.allclose(apply_components(x, fit_components(df, 2)), project(x, pca_map(x, 2)), atol=1e-6)


def test_first_of_repeated_ids_is_by_line_number(spark, tmp_path):
    lines = [json.dumps({"article_id": f"id{k}"}) for k in range(1, 12)]
    lines[1] = json.dumps({"article_id": "twice", "n": 2})
    lines[9] = json.dumps({"article_id": "twice", "n": 10})
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl").write_text(json.dumps({"article_id": "id1", "n": 99}))
    got = R.read_jsonl(spark, [str(tmp_path)]).select("source_ref", "source_file", "source_place", F.get_json_object("record", "$.article_id").alias("article_id"), F.get_json_object("record", "$.n").alias("n"))
    out = {r.article_id: r.n for r in I.first_in_batch(got).collect()}
    assert out["twice"] == "2" and out["id1"] is None and len(out) == 10


def test_large_dates_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "ROWS_PER_FILE", 10)
    rows = spark.createDataFrame([(f"a{i:03d}", "p", "2024-01-01" if i < 50 else "2024-01-02") for i in range(55)], "article_id string, publisher_id string, published_date string")
    t = T.Table(spark, str(tmp_path), "clean")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else these few rows are put together again
    try:
        t.write(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert t.read().count() == 55 and len(list((tmp_path / "clean/published_date=2024-01-01").glob("*.parquet"))) > 1
    t.write(rows.where("false"))
    assert t.read().count() == 55


def test_labels():
    negative = lambda *texts: [{"article_id": str(k), "stance": "negative", "evidence": [t]} for k, t in enumerate(texts)]
    got = P.labels(negative("재정 부담이 지나치게 크기 때문에 청년주택 정책을 폐기해야 한다는 주장이다.", "절차적 정당성이 부족하기 때문에 청년주택 정책을 폐기해야 한다는 입장이다."), "청년주택 정책")
    assert got["0"] != got["1"]
    got = P.labels(negative("재정 부담이 커서 청년주택 정책을 폐기해야 한다는 주장이다.", "재정 부담을 줄이는 방향으로 청년주택 정책을 수정해야 한다는 주장이다."), "청년주택 정책")
    assert got["0"].endswith("폐기") and got["1"].endswith("수정")
    got = P.labels(negative("대한의사협회는 건강보험료 동결에 우려를 표하는 입장이다.", "보건의료계 노조는 정부의 건강보험료 동결을 규탄했다."), "2027년 건강보험료율 동결")
    assert got == {"0": "동결 우려", "1": "동결 규탄"}
    assert W.bare("강화해야한다") == "강화" and W.bare("정책으로") == "정책" and W.bare("문제이므로") == "문제" and W.short_label("") == "기타 관점"
    assert all(len(v) <= 8 for v in got.values())


def test_reasons_split_two_alike_claims():
    alike = lambda texts, dim: np.ones((len(texts), 1)) if any("해야" in t for t in texts) else np.eye(len(texts))
    with_reasons = ["돈이 없기 때문에 법을 고쳐야 해야", "시간이 없기 때문에 법을 고쳐야 해야"]
    assert P.split_by_similarity(with_reasons, alike, 3) == [0, 1] and P.split_by_similarity(["법을 고쳐야 해야", "법을 고쳐야 해야"], alike, 3) == [0, 0]


def test_enrichment_checks(spark):
    good = spark.createDataFrame([("a", "positive", 1.0, "찬성")], "article_id string, stance string, stance_confidence double, label string")
    assert O.checked_views(good).count() == 1
    for bad in (("a", "maybe", 1.0, "x"), ("a", "neutral", 1.5, "x"), ("a", "neutral", 0.5, ""), ("a", "neutral", 0.5, "아홉글자가넘는라벨임")):
        with pytest.raises(PySparkException):
            O.checked_views(spark.createDataFrame([bad], good.schema)).collect()
    with pytest.raises(ValueError):
        O.checked_rows(good)


def test_labeler_agreement_churn_and_sweep(spark):
    lab = spark.createDataFrame([(a, x, c) for x in "xyz" for a, c in (("a", 1), ("b", 1), ("c", 2))], "article_id string, labeler string, cluster int")
    assert tuple(E.labeler_agreement(lab).first()) == (3, 1.0)
    assert tuple(E.labeler_agreement(lab.where("labeler = 'x'")).first()) == (0, None)
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(12, 4)) * 0.05 + c for c in ([5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 5, 0])])
    rows = [(f"a{i:02d}", v.tolist(), "2024-01-01", i % 3) for i, v in enumerate(x)]
    v = spark.createDataFrame(rows, "article_id string, vector array<double>, published_date string, arrived_at int")
    log = E.churn(v, [2, 3])
    assert [s["rows"] for s in log] == [24, 36] and log[0]["created"] == log[0]["issues"] == 3 and log[1]["created"] == log[1]["retired"] == log[1]["splits"] == 0
    pairs = spark.createDataFrame([("a00", "a01", True), ("a00", "a20", False)], "article_id_a string, article_id_b string, same boolean")
    best = E.sweep(v, pairs, sizes=(3, 20), neighbours=(5,)).collect()
    assert best[0].min_cluster_size == 3 and best[0].issues == 3 and best[0].precision == 1.0
