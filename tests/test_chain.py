"""The chain end to end on a temporary root: recluster, rerun, assign, export, and the streaming wrapper."""

import json

from tidewire.operators.clustering import ClusterConfig
from tidewire.plans.chain import Chain, run_chain
from tidewire.streaming.assign import start_assign

TOPICS = {"간호법": "간호법 제정안이 국회 본회의를 통과했다. 간호사들은 간호법 제정을 환영한다고 밝혔다. ", "반도체": "반도체 공장 건설이 경기도에서 시작됐다. 기업들은 반도체 공장 추진을 지지한다고 말했다. ", "태풍": "태풍이 남해안을 지나며 많은 비가 내렸다. 주민들은 태풍 피해 대책을 촉구했다. "}


def article(k: int, topic: str, n: int) -> dict:
    body = TOPICS[topic] * 3 + f"{topic} 관련 {n}번째 소식이 전해졌다. " + " ".join(f"{topic}{k}낱말{j}" for j in range(8))
    return {
        "schema_version": "1.0", "article_id": f"id{k:03d}", "publisher_id": f"p{k % 5}", "company": f"신문{k % 5}", "source_type": "RSS", "link": f"http://h/{k}?utm_source=x", "title": f"{topic} 소식 {n}",
        "article": body, "category": "사회", "language": "ko", "published": f"2024-01-01T{8 + n:02d}:00:00+09:00",
    }


def test_chain(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "root")
    src.mkdir()
    rows = [article(3 * n + i, t, n) for n in range(5) for i, t in enumerate(TOPICS)]
    (src / "a.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in [*rows, {"x": 1}]), encoding="utf-8")
    state = run_chain(spark, root, "2023-12-31", "2024-01-01", [str(src)], export_path=f"{root}/out")
    assert state["status"] == "done" and [s["name"] for s in state["steps"]] == ["ingest", "preprocess", "dedup", "embed", "cluster", "succeed", "quality", "feed", "export"]
    c = Chain(spark, root, "2023-12-31", "2024-01-01")
    assert c.articles.read().count() == 15 and spark.read.json(f"{root}/rejects").count() == 1
    ids = {r.article_id: r.issue_id for r in c.registry.read().collect()}
    again = run_chain(spark, root, "2023-12-31", "2024-01-01", [str(src)])
    assert again["status"] == "done" and {r.article_id: r.issue_id for r in c.registry.read().collect()} == ids
    before = c.issue.read().count()
    (src / "b.jsonl").write_text(json.dumps(article(90, "태풍", 7), ensure_ascii=False), encoding="utf-8")
    placed = run_chain(spark, root, "2023-12-31", "2024-01-01", [str(src)], mode="assign")
    assert "cluster" not in [s["name"] for s in placed["steps"]] and c.issue.read().count() == before + 1
    for line in spark.read.text(f"{root}/out").collect():
        m = json.loads(line[0])
        assert m["articles"] and all(len(a["viewpointGroupLabel"]) <= 8 for a in m["articles"]) and m["clusteredAt"].endswith("+09:00")


def test_stream_equals_batch(spark, tmp_path):
    src, root = tmp_path / "lines", str(tmp_path / "root")
    src.mkdir()
    rows = [article(3 * n + i, t, n) for n in range(4) for i, t in enumerate(TOPICS)]
    (src / "a.txt").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows + rows[:2]), encoding="utf-8")
    q = start_assign(spark.readStream.text(str(src)), root, "2023-12-31", "2024-01-01", str(tmp_path / "ck"), once=True)
    q.awaitTermination()
    assert q.exception() is None
    c = Chain(spark, root, "2023-12-31", "2024-01-01")
    assert c.articles.read().count() == 12 and c.summary.read().count() >= 1


def test_dims_zero_skips_the_map():
    assert ClusterConfig(dims=0).dims == 0
