"""Reference operators on small literals: results, ties, idempotence."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.functions import text as X
from tidewire.operators import clean as C
from tidewire.operators import clustering as K
from tidewire.operators import dedup as D
from tidewire.operators import evaluation as E
from tidewire.operators import facts, stance, viewpoints
from tidewire.operators import ingest as I
from tidewire.operators import issues as S
from tidewire.operators import keywords as W
from tidewire.operators import vectors as V
from tidewire.operators.graph import components, star_groups
from tidewire.sources.records import read_labels, read_pairs, read_piped_csv, read_records
from tidewire.sources.tables import RunMarker, Table, export_lines, upsert


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} string" for c in cols))
    return df.select(expr.alias("x")).first()[0]


def test_urls(spark):
    cases = {
        "https://A.example/p?b=2&a=1&utm_source=x#top": "https://A.example/p?a=1&b=2",
        "HTTP://h/x?page=2&ref=q": "http://h/x",
        " http://h/?k=a%20b&j=c+d&e ": "http://h/?e=&j=c+d&k=a+b",
        "http://h/?k=~*": "http://h/?k=~%2A",
    }
    for raw, want in cases.items():
        assert one(spark, X.normalize_url(F.col("u")), u=raw) == want


def test_sentences_quotes_numbers(spark):
    assert one(spark, X.sentences(F.col("t")), t="하나다.둘이다. 3.5% 올랐다!\n\n끝") == ["하나다.", "둘이다.", "3.5% 올랐다!", "끝"]
    assert one(spark, X.sentences(F.col("t")), t="  ") == []
    assert one(spark, X.quotes(F.col("t")), t='그는 "좋다" “ 나쁘다 ” "닫지 않음') == ["좋다", "나쁘다"]
    assert one(spark, X.fact_numbers(F.col("t")), t="김씨(58·24기)는 1,000명과 3.5%") == ["1,000", "3.5"]
    assert one(spark, X.word_grams(F.col("t"), (3, 4)), t="A bcd") == [" a ", " bc", "bcd", "cd ", " bcd", "bcd "]
    assert one(spark, X.shingles(F.col("t")), t="abcdabcd") == ["abcd", "bcda", "cdab", "dabc"]
    assert one(spark, X.trim_unicode(F.col("t")), t="　\xa0 x\t\n") == "x"


def test_cleaning_by_scope():
    assert C.clean_text("(서울=뉴스1) 홍길동 기자 = 본문이다.")[0] == "본문이다."
    assert C.clean_text("<앵커> 본문이다.")[1] == ["broadcast_marker"]
    assert C.clean_text("본문이다. 저작권자 ⓒ 어느신문")[0] == "본문이다."
    assert C.clean_text("본문이다.\n\n홍길동 기자\nabc@de.com\n2023/01/02 11:35 송고") == ("본문이다.", ["date_stamp_line", "reporter_email_line", "reporter_signature_line"])
    assert C.clean_text("본문이다. 홍길동 기자 abc@de.com")[0] == "본문이다."
    assert C.clean_text("본문\nAI 추천 뉴스", "mk")[0] == "본문\nAI 추천 뉴스"
    assert C.clean_text("본문\nAI 추천 뉴스", "hankyung")[0] == "본문"
    assert C.clean_text("본문\n많이 본 기사\n다른 것", "kmib")[0] == "본문"
    assert C.clean_text("그는 amp;#39;말amp;#39;했다.다음이다.")[0] == "그는 '말'했다. 다음이다."
    assert C.clean_text("그대로 둔다") == ("그대로 둔다", [])
    assert C.clean_text("") == ("", [])


def test_clean_columns(spark):
    df = spark.createDataFrame([("a", "p", "2024-01-01", "  x \t y\n\n\n\nz  "), ("b", "p", "2024-01-01", None)], "article_id string, publisher_id string, published_date string, content string")
    out = {r.article_id: r for r in C.clean(df).collect()}
    assert out["a"].content_clean == "x y\n\nz" and out["a"].clean_status == "short" and out["b"].clean_status == "empty"
    assert df.select(C.normalize_whitespace(F.col("content"))).first()[0] == "x y\n\nz"


RECORD = {"schema_version": "1.0", "article_id": "x", "publisher_id": "p", "company": "P", "source_type": "RSS", "link": "http://h/1", "title": "t", "article": "본문", "category": "c", "language": "ko", "published": "2024-01-01T00:30:00+09:00"}


def test_records_and_validation(spark, tmp_path):
    lines = [RECORD, RECORD | {"reporter": " "}, RECORD | {"article": " "}, RECORD | {"published": "2024-01-01T00:30:00"}, RECORD | {"company": None, "publisher_name": "ok"}, RECORD | {"language": 5}]
    (tmp_path / "a.jsonl").write_text("﻿" + "\n\n".join(json.dumps(x, ensure_ascii=False) for x in lines) + "\n{broken\n[1]\n", encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps([RECORD, 3]), encoding="utf-8")
    (tmp_path / "c.json").write_text("{", encoding="utf-8")
    (tmp_path / "skip.txt").write_text("{}", encoding="utf-8")
    rows = read_records(spark, [str(tmp_path)])
    by = {r.source_ref.rsplit("/", 1)[-1]: r for r in rows.collect()}
    assert by["a.jsonl:1"].record and by["a.jsonl:13"].error == "JSON line is not an object" and by["a.jsonl:12"].error == "invalid JSON"
    assert by["b.json[0]"].record and by["b.json[1]"].error == "array item is not an object" and by["c.json"].error == "invalid JSON" and len(by) == 11
    checked = {r.source_ref.rsplit("/", 1)[-1]: r for r in I.validate(rows.where("error is null")).collect()}
    assert checked["a.jsonl:1"].error is None and str(checked["a.jsonl:1"].published_at) == "2023-12-31 15:30:00"
    assert checked["a.jsonl:3"].error is None and checked["a.jsonl:3"].author is None
    assert checked["a.jsonl:5"].error == "content: must not be empty"
    assert checked["a.jsonl:7"].error == "published_at: must have a timezone"
    assert checked["a.jsonl:9"].error == "publisher_name: must be a string"
    assert checked["a.jsonl:11"].error == "language: must be a string"


def test_sheets(spark, tmp_path):
    p = tmp_path / "pairs.csv"
    p.write_text("﻿article_id_a,article_id_b,판정(O/X)\na,b, o \nc,d,?\ne,f,X\n", encoding="utf-8")
    assert sorted(map(tuple, read_pairs(spark, str(p)).collect())) == [("a", "b", True), ("e", "f", False)]
    q = tmp_path / "labels.csv"
    q.write_text("﻿article_id,labeler,cluster\na,x,1\na,x,2\n", encoding="utf-8")
    assert [tuple(r) for r in read_labels(spark, str(q)).collect()] == [("a", "x", "2")]
    c = tmp_path / "x.csv"
    c.write_text('h|h|h|h|h|h|h|h\nP|2024-01-01|t|c|r|l|"line one\nline two"|e\nonly|three|fields\n', encoding="utf-8")
    got = read_piped_csv(spark, [str(c)]).collect()
    assert [r.article for r in got] == ["line one\nline two"]


def gold(spark, rows):
    df = spark.createDataFrame(rows, "article_id string, publisher_id string, title string, content string, published string, category string")
    return df.withColumn("published_at", F.to_timestamp("published")).withColumn("published_date", F.date_format("published_at", "yyyy-MM-dd")).withColumn("url", F.concat(F.lit("http://h/"), "article_id"))


def test_table_upsert_moves_and_is_idempotent(spark, tmp_path):
    t = Table(spark, str(tmp_path), "articles")
    assert t.read().count() == 0 and t.partitions() == []
    first = gold(spark, [("a", "p", "t", "x", "2024-01-01 10:00:00", "c"), ("b", "p", "t", "y", "2024-01-02 10:00:00", "c")])
    assert upsert(t, first) == {"written": 2, "skipped": 0, "replaced": 0}
    assert upsert(t, first) == {"written": 0, "skipped": 2, "replaced": 0} and t.read().count() == 2
    moved = gold(spark, [("a", "p", "t", "new", "2024-01-03 10:00:00", "c")])
    assert upsert(t, moved)["skipped"] == 1 and t.read().where("content = 'new'").count() == 0
    assert upsert(t, moved, "replace")["replaced"] == 1
    assert t.partitions() == ["2024-01-02", "2024-01-03"] and t.read("2024-01-03", "2024-01-03").first().content == "new"


def test_export_and_marker(spark, tmp_path):
    df = spark.createDataFrame([('{"a":1}',)], "value string")
    path = str(tmp_path / "out")
    assert export_lines(df, path, dry_run=True) == 1 and export_lines(df, path) == 1
    with pytest.raises(FileExistsError):
        export_lines(df, path)
    assert export_lines(df, path, overwrite=True) == 1 and spark.read.text(path).first()[0] == '{"a":1}'
    m = RunMarker("assign", "a", "b")
    assert m.step("x", lambda: 5) == 5
    with pytest.raises(ZeroDivisionError):
        m.step("y", lambda: 1 / 0)
    assert m.state["status"] == "failed" and [s["rc"] for s in m.state["steps"]] == [0, 1]


def test_components_and_stars(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "a string, b string")
    assert {tuple(r) for r in components(pairs).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
    order = spark.createDataFrame([(c, i) for i, c in enumerate("bacdxyefghijklmn")], "id string, k int")
    got = {r.id: r.representative for r in star_groups(pairs, order).collect()}
    assert got == {"a": "b", "b": "b", "c": "b", "x": "x", "y": "x"}
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "a string, b string")
    by_name = spark.createDataFrame([(c, i) for i, c in enumerate("abcd")], "id string, k int")
    assert {r.id: r.representative for r in star_groups(chain, by_name).collect()} == {"a": "a", "b": "a", "c": "c", "d": "c"}
    star = spark.createDataFrame([("a", c) for c in "efghijklm"], "a string, b string")
    first = spark.createDataFrame([(c, i) for i, c in enumerate("aefghijklm")], "id string, k int")
    got = star_groups(star, first, cap=5).collect()
    assert len(got) == 5 and all(r.size == 5 and r.oversized for r in got)


def test_fold_window(spark):
    r = random.Random(3)
    words = lambda n: " ".join("".join(chr(r.randrange(0xAC00, 0xD7A3)) for _ in range(r.randrange(2, 6))) for _ in range(n))
    base, other = words(150), words(150)
    rows = gold(spark, [
        ("a", "p", "t", base, "2024-01-01 10:00:00", "c"), ("b", "q", "t", base, "2024-01-01 11:00:00", "c"), ("c", "r", "t", base + " 끝말.", "2024-01-01 12:00:00", "c"),
        ("d", "s", "t", base[:400], "2024-01-01 13:00:00", "c"), ("e", "s", "t", other, "2024-01-01 09:00:00", "c"), ("f", "s", "t", "짧다", "2024-01-01 09:00:00", "c"),
    ])
    got = {r.article_id: (r.duplicate_of, r.duplicate_count, r.method) for r in D.fold(rows).collect()}
    assert got == {"a": (None, 4, None), "b": ("a", 0, "sha256"), "c": ("a", 0, "cosine"), "d": ("a", 0, "containment"), "e": (None, 1, None), "f": (None, 1, None)}


def test_fold_of_a_large_bucket(spark):
    r = random.Random(7)
    words = ["".join(chr(r.randrange(0xAC00, 0xD7A3)) for _ in range(4)) for _ in range(54)]
    swapped = lambda i, j: " ".join([*words[:i], words[j], *words[i + 1 : j], words[i], *words[j + 1 :]])
    texts = [swapped(i, i + d) for d in range(1, 5) for i in range(50)]
    rows = gold(spark, [(f"a{i:03}", "p", "t", x, f"2024-01-01 {10 + (i * 37 % 200) // 60}:{(i * 37 % 200) % 60:02}:00", "c") for i, x in enumerate(texts)])
    by = lambda c: {tuple(x) for x in D.fold(rows, config=D.DedupConfig(candidates=c)).collect()}
    banded, exact = by("banded"), by("exact")
    assert sum(x[1] is not None for x in banded) >= 190 and banded == exact


def test_stars_in_a_task_and_in_rounds(spark, monkeypatch):
    from tidewire.operators import graph

    r = random.Random(5)
    pairs = spark.createDataFrame([(f"n{i:02}", f"n{j:02}") for i in range(40) for j in range(i) if r.random() < 0.2], "a string, b string")
    order = spark.createDataFrame([(f"n{i:02}", i * 17 % 40) for i in range(40)], "id string, k int")
    at_once = {tuple(x) for x in star_groups(pairs, order, cap=5).collect()}
    monkeypatch.setattr(graph, "TASK_EDGES", 0)
    assert at_once == {tuple(x) for x in star_groups(pairs, order, cap=5).collect()}


def test_signature_cache(spark):
    docs = spark.createDataFrame([("a", "some text here"), ("b", "other text there")], "article_id string, text string")
    sigs = D.minhash_signatures(docs)
    cached = sigs.where("article_id = 'a'").withColumn("shingle_size", F.lit(4)).withColumn("num_perm", F.lit(128)).withColumn("seed", F.lit(1))
    all_, fresh = D.refresh_signatures(docs, cached)
    assert {r.article_id for r in fresh.collect()} == {"b"}
    assert {r.article_id: r.hashvalues for r in all_.collect()} == {r.article_id: r.hashvalues for r in sigs.collect()}


def test_quality_and_assign(spark):
    rows = [(f"s{i}", "one", 0, [1.0, 0.0]) for i in range(10)] + [(f"m{i}", f"p{i}", 1, [0.0, 1.0]) for i in range(4)] + [("close", "q", -1, [0.05, 1.0]), ("far", "q", -1, [0.7, -0.7]), ("bot", "q", -1, [1.0, 0.02])]
    df = spark.createDataFrame(rows, "article_id string, publisher_id string, issue_local int, vector array<float>")
    out = {r.article_id: r for r in S.qualify(df, df).collect()}
    assert out["close"].issue_local == 1 and out["close"].rescued and out["close"].issue_size == 5
    assert out["far"].issue_local == -1 and out["bot"].issue_local == -1 and out["s0"].structured and not out["m0"].structured
    known = df.where("article_id not in ('close', 'far')")
    placed = {r.article_id: r for r in S.assign(known, df).collect()}
    assert placed["close"].issue_local == 1 and placed["m0"].issue_size == 5 and placed["far"].issue_local == -1
    assert S.assign(df, df) is None


def test_succession_ties_and_reruns(spark):
    w1 = [(f"a{i}", "d1", 0) for i in range(1, 4)] + [(f"b{i}", "d1", 1) for i in range(1, 5)]
    w2 = [("a2", "d2", 5), ("a3", "d2", 5), ("c3", "d2", 5), ("b1", "d2", 7), ("b2", "d2", 7), ("e1", "d2", 7), ("b3", "d2", 8), ("b4", "d2", 8), ("f1", "d2", 8), ("c1", "d2", 9), ("c2", "d2", 9), ("n", "d2", -1)]
    schema = "article_id string, published_date string, issue_local int"
    first = S.succeed(spark.createDataFrame(w1, schema), None, None, -1)
    ids = {r.issue_local: (r.issue_id, r.status) for r in first.collect()}
    assert ids == {0: (0, "new"), 1: (1, "new")}
    second = S.succeed(spark.createDataFrame(w2, schema), first, None, 1)
    got = {r.issue_local: (r.issue_id, r.status) for r in second.collect()}
    assert got == {5: (0, "inherited"), 8: (1, "inherited"), 7: (2, "new"), 9: (3, "new")}
    again = S.succeed(spark.createDataFrame(w2, schema), first, second, 3)
    assert {r.issue_local: (r.issue_id, r.status) for r in again.collect()} == got


def test_feed(spark):
    rows = [("m1", "p", 1, [0.0, 1.0], "2024-01-01 12:00:00", ""), ("m2", "q", 1, [0.2, 0.98], "2024-01-01 09:00:00", "산업"), ("m3", "r", 1, [-0.2, 0.98], "2024-01-01 10:00:00", "경제"), ("z", "r", -1, [1.0, 0.0], "2024-01-02 12:00:00", "정치")]
    df = spark.createDataFrame(rows, "article_id string, publisher_id string, issue_local int, vector array<float>, at string, category string")
    df = df.withColumn("published_at", F.to_timestamp("at")).withColumn("published_date", F.lit("2024-01-01")).withColumn("structured", F.lit(False))
    r = S.summarize(df, df, df, None).first()
    assert (r.representative, r.category, r.issue_size, r.publishers, r.issue_id) == ("m1", "경제", 3, 3, -1)
    assert abs(r.hot_score - round((2 + 2 * 2) * np.exp(-1), 4)) < 1e-9


def test_clustering():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.1, (4, 2)), rng.normal(5, 0.1, (3, 2)), [[20.0, -20.0]]])
    assert K.hdbscan(x, 3).tolist() == [0, 0, 0, 0, 1, 1, 1, -1]
    assert K.hdbscan(x[:2], 3).tolist() == [-1, -1]
    u = np.array([[1, 0, 0], [1, 0.1, 0], [1, 0, 0.1], [0, 1, 0], [0, 1, 0.1], [0, 0.9, 0.1]], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    assert K.attach_new(u, np.array([0, 0, 0, -1, -1, -1])).tolist() == [0, 0, 0, 1, 1, 1]
    assert len(set(K.average_linkage(u, 0.3).tolist())) == 2
    assert len(set(K.best_split(u, 3).tolist())) == 2


def test_cluster_window_refuses_mixed_models(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0], "m"), ("b", [0.0, 1.0], "n")], "article_id string, vector array<float>, model string")
    with pytest.raises(ValueError):
        K.cluster_window(df)


def test_evaluation(spark):
    lab = spark.createDataFrame([(a, x, c) for x in "xyz" for a, c in (("a", 1), ("b", 1), ("c", 2))], "article_id string, labeler string, cluster int")
    assert {r.article_id: r.component for r in E.consensus(lab, 2).collect()} == {"a": "a", "b": "a", "c": "c"}
    same = spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "a int, b int")
    assert E.adjusted_rand(same, "a", "b").first().ari == 1.0
    pairs = spark.createDataFrame([(0, 0, 0.9, True), (0, 1, 0.9, True), (1, -1, 0.1, False)], "label_a int, label_b int, sim double, same boolean")
    r = E.pair_strata(pairs).first()
    assert (r.precision, r.oversplit_rate, r.recall_in_sample) == (1.0, 1.0, 0.5)


def test_stance():
    t = "간호법 제정"
    assert stance.stance_of(t, "간호사들은 간호법 제정을 촉구했다.")[:2] == ("positive", 1.0)
    assert stance.stance_of(t, "의사들은 간호법 제정에 반대한다고 말했다.")[0] == "negative"
    assert stance.stance_of(t, "간호법은 찬성 179표, 반대 3표로 표결에서 가결됐다.")[0] == "neutral"
    assert stance.stance_of(t, "간호법에 대한 거부권을 규탄했다.")[0] == "positive"
    assert stance.stance_of(t, "간호법에 대한 거부권 행사를 건의했다.")[0] == "negative"
    assert stance.stance_of(t, "날씨가 맑다.") == ("neutral", 0.0, [])
    assert stance.stance_of("", "x") == ("neutral", 0.0, [])


def test_facts():
    src = lambda *ps: [{"article_id": p, "publisher_name": p} for p in ps]
    ev = [{"sentence": "정부는 내일 새로운 대책을 발표한다고 밝혔다.", "sources": src("a", "b")}, {"sentence": "정부는 내일 새로운 대책을 발표한다 밝혔다.", "sources": src("c")}, {"sentence": "예산은 모두 100억원이 들어간다고 했다.", "sources": src("a", "b")}, {"sentence": "예산은 모두 200억원이 들어간다고 했다.", "sources": src("c", "d")}]
    got = facts.common_facts(ev)
    assert [g["sentence"] for g in got] == [ev[0]["sentence"]] and facts.publishers(got[0]) == 3
    assert facts.ratio("abc", "abc") == 1 and facts.ratio("a", "b" * 50, 0.45) == 0
    assert facts.lexrank([]).tolist() == [] and abs(facts.lexrank(["가나다 라마", "가나다 라바", "전혀 다른 말"]).sum() - 1) < 1e-6
    arts = [{"article_id": str(i), "publisher_name": f"p{i}", "title": "간호법 제정 국회 통과", "content": "간호법 제정안이 국회 본회의를 통과했다. 무단 전재 금지"} for i in range(3)]
    assert facts.summary(arts) == ["간호법 제정안이 국회 본회의를 통과했다."]


def test_keywords_and_titles(spark):
    assert one(spark, W.tokens(F.col("t")), t="https://a.b/c 정부는 간호법을 2024년 추진한다 naver.com") == ["정부", "간호법", "추진"]
    rows = [("g", "1", "positive", "찬성 이유 안전"), ("g", "2", "positive", "찬성 안전 도로"), ("g", "3", "negative", "반대 비용 도로")]
    df = spark.createDataFrame(rows, "g string, article_id string, stance string, content string")
    got = {(r.stance, r["rank"]): r.term for r in W.contrastive(df, "g", W.tokens(F.col("content"))).collect()}
    assert got["positive", 1] == "안전" and got["positive", 2] == "찬성" and got["negative", 1] == "반대"
    t = spark.createDataFrame([("g", 0, "[속보] 간호법 국회 통과"), ("g", 1, "간호법 국회 본회의 통과"), ("g", 2, "LIVE\n전혀 다른 소식")], "g string, place long, title string")
    assert W.central_titles(t, "g").first().title in ("간호법 국회 통과", "간호법 국회 본회의 통과")


def test_viewpoints():
    assert viewpoints.claim("앞 문장. 법안을 폐기해야 한다는 비판이 나왔다.") == "법안을 폐기해야 한다"
    assert viewpoints.act("법안을 폐기해야 한다") == "폐기" and viewpoints.act("좋다") is None
    arts = [{"article_id": "a", "stance": "negative", "evidence": ["법안을 폐기해야 한다."]}, {"article_id": "b", "stance": "negative", "evidence": ["법안을 수정해야 한다."]}, {"article_id": "c", "stance": "neutral", "evidence": []}]
    got = viewpoints.labels(arts, "법안")
    assert got["a"] != got["b"] and got["c"] == "기타 중립 관점" and all(0 < len(v) <= 8 for v in got.values())


def test_vectors(spark):
    df = spark.createDataFrame([("a", 0, [1.0, 0.0]), ("b", 0, [0.0, 1.0]), ("c", 1, [-1.0, 0.0]), ("d", 1, [1.0, 0.0])], "article_id string, g int, vector array<float>")
    c = V.centroids(df, "g")
    assert [r.g for r in c.collect()] == [0]  # the mean of opposite vectors is zero
    near = {r.article_id: (r.g, round(r.sim, 4)) for r in V.nearest(df, c, "g", 0.5).collect()}
    assert near == {"a": (0, 0.7071), "b": (0, 0.7071), "d": (0, 0.7071)}


def test_percentiles_hold_no_values_in_one_task(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tidewire.operators import evaluation as E

    monkeypatch.setattr(E, "FEW", 50)
    monkeypatch.setattr(E, "BINS", 16)
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0.25)).otherwise(F.pmod(F.xxhash64("id"), F.lit(10007)) / 10007.0 - 0.5).alias("sim"))
    for share in (0.0, 0.1, 0.5, 0.77, 0.9, 1.0):
        assert abs(E.exact_percentile(rows, "sim", share) - rows.agg(F.percentile("sim", F.lit(share))).first()[0]) < 1e-12
    assert E.exact_percentile(rows.where("sim > 9"), "sim", 0.1) is None
    plan = E.separation(rows, rows)._jdf.queryExecution().toString()
    assert "percentile" not in plan


def test_facts_of_many_articles_in_linear_time():
    import time

    from tidewire.operators import facts

    rows = [{"article_id": f"a{i}", "content": "국회는 간호법 제정안을 본회의에서 처리했다.", "publisher_name": f"p{i % 3}"} for i in range(20_000)]
    at = time.process_time()
    found = facts.merged(facts.issue_evidence(rows + rows[:50]))
    assert len(found) == 1 and len(found[0]["sources"]) == 20_000 and time.process_time() - at < 8


def test_ingest_stats_check_records_once(spark):
    import json

    from tidewire.operators import ingest as I

    good = {n: "2024-01-01T00:00:00Z" if n == "published_at" else "RSS" if n == "source_type" else "x" for n in I.FIELDS}
    records = [json.dumps(good | {"article_id": i}) for i in ("a", "a", "b", "c")] + ["{}", json.dumps(good | {"title": " "})]
    checked = I.validate(spark.createDataFrame([(r,) for r in records], "record string"))
    stats = I.ingest_stats(checked, spark.createDataFrame([("b",), ("z",)], "article_id string"))
    assert tuple(stats.first()) == (6, 2, 4, 1, 1, 2)
    assert stats._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2  # records and known ids, once each
    assert tuple(I.ingest_stats(checked.limit(0), spark.createDataFrame([], "article_id string")).first()) == (0, 0, 0, 0, 0, 0)


def test_long_rows_are_dealt_over_files(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from tidewire.sources import tables as T

    monkeypatch.setattr(T, "LETTERS_PER_FILE", 20_000, raising=False)
    rows = spark.range(100).select(F.col("id").cast("string").alias("article_id"), F.repeat(F.lit("x"), 1000).alias("content"), F.lit("2024-01-01").alias("published_date"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        T.Table(spark, str(tmp_path), "articles").write(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list(tmp_path.rglob("published_date=*/*.parquet"))) > 1 and T.Table(spark, str(tmp_path), "articles").read().count() == 100
