"""Queries of the language operators, readers and writers: Korean passages dealt over the test tables' rows, with their SQL.

Where the operator's rules are no SQL, the SQL states the rows that follow for each passage, worked out by hand."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions.session import cut, shared_dir, small_batches
from tidewire.operators import clean as C
from tidewire.operators import clustering as L
from tidewire.operators import evaluation as E
from tidewire.operators import facts
from tidewire.operators import keywords as K
from tidewire.operators import stance as S
from tidewire.operators import viewpoint_labels as W
from tidewire.operators import viewpoints as P
from tidewire.operators.fixed_map import MapStore
from tidewire.plans.queries import query
from tidewire.plans.views import articles, issue, table
from tidewire.sources import records as R
from tidewire.sources import tables as T

SQL: dict[str, str] = {}


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/query-{uuid.uuid4().hex}"


def _pick(place: Column, values: list) -> Column:
    """The value at a place of a short list."""
    return F.element_at(F.array(*map(F.lit, values)), (place + 1).cast("int"))


def _values(rows: list[tuple]) -> str:
    show = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int | float) else "'" + str(v).replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(show, r)) + ")" for r in rows) + ")"


# -- stance --------------------------------------------------------------------------------------------------------
EVENT = "간호법 제정"
#: text, stance, confidence, sentences of evidence.
STANCES = (
    ("국회는 간호법 표결에서 찬성 120표, 반대 33표로 가결했다.", "neutral", 0.5, 1),
    ("대통령이 간호법에 거부권을 행사했다.", "neutral", 0.5, 1),
    ("간호사들은 간호법 거부권을 규탄한다고 밝혔다.", "positive", 1.0, 1),
    ("의사단체는 간호법 거부권 행사를 촉구했다.", "negative", 1.0, 1),
    ("간호사들은 간호법 제정을 촉구했다.", "positive", 1.0, 1),
    ("의사들은 간호법 제정에 반대했다.", "negative", 1.0, 1),
    ("간호법 제정은 반드시 필요하다고 그는 말했다.", "positive", 1.0, 1),
    ("간호법이 시행됐다. 환자단체는 이를 환영한다고 밝혔다.", "positive", 1.0, 1),
    ("간호법이 시행됐다. 정부는 산업 정책을 환영한다고 밝혔다.", "neutral", 0.5, 1),
    ("내일은 전국에 비가 온다.", "neutral", 0.0, 0),
    ("간호법 제정을 환영한다고 했다. 간호법 제정에 우려를 나타냈다. 간호법 제정을 지지한다고 했다.", "positive", 0.667, 2),
    ("간호법을 두고 환영한다고 밝힌 쪽과 우려스럽다는 쪽이 맞섰다.", "neutral", 0.5, 1),
)


@query
def stn_classify(spark, sf):
    """Each document behind one of the passages, read whole."""
    d = articles(spark, sf)
    text = F.concat(_pick(F.col("doc_id") % len(STANCES), [t for t, *_ in STANCES]), F.lit("\n"), F.coalesce("content", F.lit("")))
    found = S.classify(d.select("article_id", F.lit(EVENT).alias("event_name"), text.alias("content")))
    return found.select("article_id", "stance", "stance_confidence", F.size("evidence").alias("n_evidence"))


SQL["stn_classify"] = f"""SELECT printf('a%09d', doc_id) AS article_id, stance, CAST(sure AS DOUBLE) AS stance_confidence, n AS n_evidence
FROM documents JOIN {_values([(k, s, c, n) for k, (_, s, c, n) in enumerate(STANCES)])} x(k, stance, sure, n) ON doc_id % {len(STANCES)} = k"""


@query
def stn_majority(spark, sf):
    """Articles' stances from counted directions: every document says something in each of its words of one letter count."""
    d = table(spark, sf, "conversations").select("conv_id", F.pmod(F.length("text"), F.lit(3)).alias("k")).where("k is not null")
    said = d.select("conv_id", F.when(F.col("k") == 0, "positive").when(F.col("k") == 1, "negative").otherwise("neutral").alias("direction"))
    return S.majority(said, "conv_id")


SQL["stn_majority"] = """WITH n AS (SELECT conv_id, count(*) FILTER (WHERE length(text) % 3 = 0) AS p, count(*) FILTER (WHERE length(text) % 3 = 1) AS m FROM conversations WHERE text IS NOT NULL GROUP BY conv_id)
SELECT conv_id, CASE WHEN p > m THEN 'positive' WHEN m > p THEN 'negative' ELSE 'neutral' END AS stance, CASE WHEN p = m THEN 0.5 ELSE round(greatest(p, m) / (p + m), 3) END AS stance_confidence FROM n"""


# -- facts ---------------------------------------------------------------------------------------------------------
BUDGET = "정부는 내년 예산 30조원을 간호 인력 확충에 쓰기로 했다."
PASSED = "국회는 간호법 제정안을 본회의에서 처리했다."
#: What the five kinds of articles of an issue say; publishers go by kind.
REPORTS = (f"{BUDGET} {PASSED}", f"{BUDGET} {PASSED}", f"{BUDGET.replace('30', '50')} {PASSED}", PASSED.replace("처리했다", "처리하였다"), "병원들은 간호 인력 부족을 호소했다.")
TITLES = ("간호법 제정안 국회 처리", "국회 간호법 제정안 통과", "간호법 처리", "국회 본회의", "병원 인력난")
ISSUES = 20


def _reports(spark, sf):
    """An issue has documents of all five kinds, and many of each."""
    d = articles(spark, sf)
    kind = F.expr(f"doc_id div {ISSUES}") % len(REPORTS)
    return d.select(
        (F.col("doc_id") % ISSUES).alias("issue_id"), "article_id", _pick(kind, list(TITLES)).alias("title"), _pick(kind, list(REPORTS)).alias("content"), F.concat(F.lit("p"), kind.cast("string")).alias("publisher_name"),
    )


def _by_issue(rows: DataFrame, f, ddl: str) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("article_id")
        found = f(facts.issue_evidence(pdf[["article_id", "content", "publisher_name"]].to_dict("records")))
        return pd.DataFrame([(pdf["issue_id"].iloc[0], *x) for x in found], columns=[c.split()[0] for c in ddl.split(", ")])

    return rows.groupBy("issue_id").applyInPandas(run, ddl)


@query
def fct_conflicts(spark, sf):
    """What is left of an issue's sentences when those with conflicting numbers are gone."""
    return _by_issue(_reports(spark, sf), lambda ev: [(e["sentence"],) for e in facts.without_conflicts(ev)], "issue_id long, sentence string")


@query
def fct_merge(spark, sf):
    return _by_issue(_reports(spark, sf), lambda ev: [(e["sentence"], facts.publishers(e)) for e in facts.merged(ev)], "issue_id long, sentence string, publishers long")


@query
def fct_summary(spark, sf):
    return facts.summaries(_reports(spark, sf), "issue_id").select("issue_id", F.array_join("facts", "|").alias("facts"))


_ALL = f"(SELECT DISTINCT doc_id % {ISSUES} AS issue_id FROM documents)"
SQL["fct_conflicts"] = f"SELECT issue_id, sentence FROM {_ALL}, {_values([(PASSED,), (REPORTS[3],), (REPORTS[4],)])} x(sentence)"
SQL["fct_merge"] = f"SELECT issue_id, sentence, publishers FROM {_ALL}, {_values([(BUDGET, 2), (BUDGET.replace('30', '50'), 1), (PASSED, 4), (REPORTS[4], 1)])} x(sentence, publishers)"
SQL["fct_summary"] = f"SELECT issue_id, '{PASSED}' AS facts FROM {_ALL}"

#: Sentences beside PASSED and BUDGET, and whether they tell the same.
TWINS = (
    (PASSED, PASSED, True), (PASSED, REPORTS[3], True), (BUDGET, BUDGET.replace("30", "50"), True), (PASSED, BUDGET, False),
    (PASSED, "국회 본회의에서 간호법 제정안이 처리됐다.", True), (BUDGET, "병원들은 간호 인력 부족을 호소했다.", False),
)


@query
def fct_similarity(spark, sf):
    """One comparison for each benchmark item."""
    b = table(spark, sf, "benchmark").select("item_id")
    k = F.col("item_id") % len(TWINS)

    def run(batches):
        for pdf in batches:
            both = [(facts.normalize(a), facts.normalize(b)) for a, b in zip(pdf["a"], pdf["b"], strict=True)]
            yield pdf[["item_id"]].assign(same=[facts.same_fact(a, b, float(facts.gram_matrix([a, b])[0, 1])) for a, b in both])

    return b.select("item_id", _pick(k, [x for x, _, _ in TWINS]).alias("a"), _pick(k, [x for _, x, _ in TWINS]).alias("b")).mapInPandas(run, "item_id long, same boolean")


SQL["fct_similarity"] = f"SELECT item_id, same FROM benchmark JOIN {_values([(k, s) for k, (_, _, s) in enumerate(TWINS)])} x(k, same) ON item_id % {len(TWINS)} = k"


# -- viewpoints ----------------------------------------------------------------------------------------------------
#: text, target, act, label.
CLAIMS = (
    ("건강보험료율 동결에 우려를 표하는 입장이다.", "2027년 건강보험료율 동결", None, "동결 우려"),
    ("용 후보자의 자진 사퇴에 선을 긋는 상황이다.", "김승원 용혜인 인사청문회", "사퇴", "사퇴 거부"),
    ("정부의 건강보험료율 동결을 규탄했다.", "2027년 건강보험료율 동결", None, "동결 규탄"),
    ("야권은 후보자 지명 철회를 요구했다.", "후보자 인사청문회", "철회", "철회 요구"),
    ("올해 다시 한번 대회를 개최하게 되어 기쁘고 영광스럽게 생각한다.", "오픈 개최", None, "개최 환영"),
    ("이번 대회의 성공을 기대한다.", "오픈 개최", None, "성공 기대"),
    ("한국 골프 발전과 골프 대중화에 지속적으로 기여하겠다.", "오픈 개최", None, "발전 기여"),
    ("절차에 문제가 없고 정당하다고 밝혔다.", "개정안", None, "절차 정당"),
    ("수사에 문제가 없다고 말했다.", "수사", None, "문제 없음"),
    ("법안을 폐기해야 한다.", "법안", "폐기", "법안 폐기"),
    ("날씨가 좋다.", "법안", None, "기타 관점"),
)


@query
def vpt_label(spark, sf):
    """Act and short label of a claim for each document."""
    k = F.col("doc_id") % len(CLAIMS)
    d = table(spark, sf, "documents").select("doc_id", _pick(k, [c[0] for c in CLAIMS]).alias("text"), _pick(k, [c[1] for c in CLAIMS]).alias("target"))

    def run(batches):
        for pdf in batches:
            yield pdf[["doc_id"]].assign(act=[W.act(t) for t in pdf["text"]], label=[W.short_label(t, g) for t, g in zip(pdf["text"], pdf["target"], strict=True)])

    return d.mapInPandas(run, "doc_id long, act string, label string")


SQL["vpt_label"] = f"SELECT doc_id, act, label FROM documents JOIN {_values([(k, a, v) for k, (_, _, a, v) in enumerate(CLAIMS)])} x(k, act, label) ON doc_id % {len(CLAIMS)} = k"

PREMIUM = "2027년 건강보험료율 동결"
#: stance, evidence, label.
VIEWS = (
    ("negative", "대한의사협회는 건강보험료 동결에 우려를 표하는 입장이다.", "동결 우려"), ("negative", "보건의료계 노조는 정부의 건강보험료 동결을 규탄했다.", "동결 규탄"),
    ("positive", "이번 결정의 성공을 기대한다.", "성공 기대"), ("neutral", "", "기타 중립 관점"),
)


@query
def vpt_groups(spark, sf):
    kind = F.expr(f"doc_id div {ISSUES}") % len(VIEWS)
    d = table(spark, sf, "documents").select((F.col("doc_id") % ISSUES).alias("issue_id"), "doc_id", _pick(kind, [v[0] for v in VIEWS]).alias("stance"), _pick(kind, [v[1] for v in VIEWS]).alias("said"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        rows = [{"article_id": i, "stance": s, "evidence": [t] if t else []} for i, s, t in zip(pdf["doc_id"], pdf["stance"], pdf["said"], strict=True)]
        return pdf[["doc_id"]].assign(label=pdf["doc_id"].map(P.labels(rows, PREMIUM)))

    return d.groupBy("issue_id").applyInPandas(run, "doc_id long, label string")


SQL["vpt_groups"] = f"SELECT doc_id, label FROM documents JOIN {_values([(k, v[2]) for k, v in enumerate(VIEWS)])} x(k, label) ON (doc_id // {ISSUES}) % {len(VIEWS)} = k"


# -- titles --------------------------------------------------------------------------------------------------------
@query
def evt_clean_title(spark, sf):
    k, first = F.col("doc_id") % 4, F.col("title")
    dressed = F.when(k == 0, F.concat(F.lit("[속보] [단독] "), first)).when(k == 1, F.concat(F.lit("LIVE:\n"), first)).when(k == 2, F.concat(first, F.lit(" 전격 발표"))).otherwise(first)
    return articles(spark, sf).select("article_id", K.clean_title(dressed).alias("title"))


_FIRST = r"trim(regexp_replace(trim(regexp_replace(trim(t, ' ' || chr(9) || chr(13)), '^\s*(\[[^\]]+\]\s*)+', '')), '\s{2,}', ' ', 'g'))"
SQL["evt_clean_title"] = rf"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10))[1] || CASE WHEN doc_id % 4 = 2 THEN ' 발표' ELSE '' END AS t, text IS NULL AS gone FROM documents)
SELECT printf('a%09d', doc_id) AS article_id, CASE WHEN gone THEN '' ELSE {_FIRST} END AS title FROM d"""

SQL["evt_medoid_title"] = rf"""WITH raw AS (SELECT source AS publisher_id, doc_id AS place, string_split(text, chr(10))[1] AS t FROM documents WHERE text IS NOT NULL),
t AS (SELECT publisher_id, place, {_FIRST} AS title FROM raw WHERE upper(regexp_replace(trim(t), ':+$', '')) <> 'LIVE'),
named AS (SELECT * FROM t WHERE title <> ''),
words AS (SELECT publisher_id, place, ' ' || w || ' ' AS w FROM (SELECT publisher_id, place, unnest(regexp_split_to_array(lower(title), '\s+')) AS w FROM named) WHERE w <> ''),
grams AS (SELECT publisher_id, place, unnest([substr(w, i, 2) FOR i IN range(1, length(w))] || [substr(w, i, 3) FOR i IN range(1, length(w) - 1)] || [substr(w, i, 4) FOR i IN range(1, length(w) - 2)]) AS g FROM words),
tf AS (SELECT publisher_id, place, g, count(*) AS tf FROM grams GROUP BY ALL),
n AS (SELECT publisher_id, count(*) AS n FROM named GROUP BY 1),
w0 AS (SELECT *, tf * (ln((1.0 + n) / (1 + count(*) OVER (PARTITION BY publisher_id, g))) + 1) AS w FROM tf JOIN n USING (publisher_id)),
u AS (SELECT publisher_id, place, g, n, w / sqrt(sum(w * w) OVER (PARTITION BY publisher_id, place)) AS u FROM w0),
m AS (SELECT publisher_id, g, sum(u) / any_value(n) AS m FROM u GROUP BY 1, 2),
c AS (SELECT publisher_id, place, round(sum(u * m), 9) AS c FROM u JOIN m USING (publisher_id, g) GROUP BY 1, 2)
SELECT publisher_id, (SELECT title FROM named x LEFT JOIN c USING (publisher_id, place) WHERE x.publisher_id = n.publisher_id ORDER BY coalesce(c, 0) DESC, place LIMIT 1) AS title, n AS titles FROM n"""


# -- cleaning ------------------------------------------------------------------------------------------------------
@query
def cln_squeeze(spark, sf):
    """White space of every document, by the Python step that cleaning uses, beside the column form."""
    small_batches(spark)
    d = articles(spark, sf).select("article_id", "content")

    def run(batches):
        for pdf in batches:
            yield pdf[["article_id"]].assign(text=[C.squeeze(t or "") for t in pdf["content"]])

    return d.mapInPandas(run, "article_id string, text string")


# -- readers and writers -------------------------------------------------------------------------------------------
@query
def src_jsonl(spark, sf):
    """Documents written as JSON lines in several files, some broken, read with provenance."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "source")
    good = F.to_json(F.struct("doc_id", "lang", "source"))
    line = F.when(F.col("doc_id") % 11 == 3, F.lit('{"doc_id": ')).when(F.col("doc_id") % 11 == 5, F.lit("[1, 2]")).otherwise(good)
    folder = _folder(spark)
    d.select((F.col("doc_id") % 4).alias("part"), "doc_id", line.alias("value")).repartition("part").sortWithinPartitions("part", "doc_id").select("part", "value").write.partitionBy("part").text(folder)
    got = R.read_jsonl(spark, [folder], "*.txt")
    return got.select(F.regexp_extract("source_file", r"part=(\d+)", 1).cast("long").alias("part"), "source_place", F.get_json_object("record", "$.doc_id").cast("long").alias("doc_id"), "error")


SQL["src_jsonl"] = """SELECT doc_id % 4 AS part, row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) AS source_place, CASE WHEN doc_id % 11 NOT IN (3, 5) THEN doc_id END AS doc_id,
  CASE doc_id % 11 WHEN 3 THEN 'invalid JSON' WHEN 5 THEN 'JSON line is not an object' END AS error FROM documents"""


@query
def src_json_arrays(spark, sf):
    """A whole-file array for every conversation."""
    c = table(spark, sf, "conversations").select("conv_id", F.struct("turn", "role").alias("m"))
    one = c.groupBy((F.col("conv_id") % 8).alias("part")).agg(F.to_json(F.array_sort(F.collect_list(F.struct("conv_id", "m.turn", "m.role")))).alias("value"))
    folder = _folder(spark)
    one.repartition("part").write.partitionBy("part").text(folder)
    files = spark.read.text(folder, wholetext=True).select("value", "part")
    # the reader takes files by their ending
    paths = _folder(spark)
    _as_files(spark, files, paths)
    got = R.read_json(spark, [paths])
    r = F.from_json("record", "conv_id bigint, turn bigint, role string")
    return got.select("source_place", r.alias("r"), "error").select("r.conv_id", "r.turn", "r.role", "source_place", "error")


def _as_files(spark, rows: DataFrame, folder: str) -> None:
    """One ``.json`` file a row (part, value): a few."""
    fs_of = lambda p: p.getFileSystem(spark._jsc.hadoopConfiguration())
    for r in rows.collect():
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{r['part']}.json")
        out = fs_of(p).create(p, True)
        out.write(bytearray(r["value"].encode()))
        out.close()


SQL["src_json_arrays"] = "SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id % 8 ORDER BY conv_id, turn, role) - 1 AS source_place, CAST(NULL AS VARCHAR) AS error FROM conversations"


@query
def src_piped_csv(spark, sf):
    """Documents as the piped export, quotes and line ends inside fields."""
    d = table(spark, sf, "documents")
    rows = d.select(*[F.coalesce(x.cast("string"), F.lit("")).alias(n) for n, x in zip(R.CSV_COLUMNS, (F.col("source"), F.col("n_chars"), F.col("doc_id"), F.col("lang"), F.lit("r"), F.lit("l"), F.col("text"), F.lit("x")), strict=True)])
    folder = _folder(spark)
    rows.write.option("sep", "|").option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).option("lineSep", "\n").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return R.read_piped_csv(spark, [folder]).select(F.col("title").cast("long").alias("doc_id"), F.col("category").alias("lang"), "publisher_name")


SQL["src_piped_csv"] = "SELECT doc_id, lang, source AS publisher_name FROM documents"


@query
def snk_table(spark, sf):
    """Articles of five dates written to a partitioned table, rewritten for one date, read in a range."""
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 5).cast("int")), "yyyy-MM-dd")
    a = articles(spark, sf).withColumn("published_date", day)
    t = T.Table(spark, _folder(spark), "articles")
    t.write(a.withColumn("category_str", F.lit("old")), ("published_at", "article_id"))
    t.write(a.where("published_date = '2024-01-03'").withColumn("category_str", F.lit("new")), ("published_at", "article_id"))
    return t.read("2024-01-02", "2024-01-04", ["article_id", "published_date", "category_str", "category"])


_A = "SELECT printf('a%09d', doc_id) AS article_id, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%d') AS published_date, doc_id, lang FROM documents"
SQL["snk_table"] = f"""SELECT article_id, d AS published_date, CASE WHEN d = '2024-01-03' THEN 'new' ELSE 'old' END AS category_str, lang AS category
FROM (SELECT *, '2024-01-0' || (1 + doc_id % 5) AS d FROM ({_A})) WHERE d BETWEEN '2024-01-02' AND '2024-01-04'"""


@query
def snk_upsert(spark, sf):
    """Upserts into a stored table: keep, then replace with rows that move to another date."""
    a = articles(spark, sf).select("article_id", "doc_id", "publisher_id", "published_at", "published_date")
    t = T.Table(spark, _folder(spark), "articles")
    T.upsert(t, a.where("doc_id % 3 <> 0").withColumn("category", F.lit("first")))
    T.upsert(t, a.withColumn("category", F.lit("kept")))
    T.upsert(t, a.where("doc_id % 5 = 0").withColumn("published_date", F.lit("2024-03-01")).withColumn("category", F.lit("moved")), "replace")
    return t.read(columns=["article_id", "published_date", "category"])


SQL["snk_upsert"] = f"""SELECT article_id, CASE WHEN doc_id % 5 = 0 THEN '2024-03-01' ELSE published_date END AS published_date,
  CASE WHEN doc_id % 5 = 0 THEN 'moved' WHEN doc_id % 3 <> 0 THEN 'first' ELSE 'kept' END AS category FROM ({_A})"""


@query
def snk_export(spark, sf):
    """Lines written twice under one path: the second export stands alone."""
    d = table(spark, sf, "documents")
    path = _folder(spark)
    T.export_lines(d.select(F.to_json(F.struct("doc_id")).alias("value")), path)
    T.export_lines(d.where("doc_id % 2 = 0").select(F.to_json(F.struct("doc_id", "lang")).alias("value")), path, overwrite=True)
    return spark.read.schema("doc_id bigint, lang string").json(path)


SQL["snk_export"] = "SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 0"


@query
def snk_rejects(spark, sf):
    d = table(spark, sf, "documents")
    path = _folder(spark)
    T.write_rejects(d.select(F.concat(F.lit("f:"), F.col("doc_id").cast("string")).alias("source_ref"), F.lit("bad").alias("reason"), "lang", F.col("source").alias("record")), path)
    return spark.read.schema("source_ref string, reason string, record string").json(path)


SQL["snk_rejects"] = "SELECT 'f:' || doc_id AS source_ref, 'bad' AS reason, source AS record FROM documents"


# -- maps and scores -----------------------------------------------------------------------------------------------
def _vectors(spark, sf):
    return issue(spark, sf).select(F.col("article_id").cast("string").alias("article_id"), "vector", "published_date")


@query
def clu_fixed_map(spark, sf):
    """A map fitted on the even vectors, used for all: which points stay and which go through it."""
    v, store = _vectors(spark, sf), MapStore(spark, _folder(spark))
    store.points(v.where("cast(article_id as long) % 2 = 0"), "w", 5)
    store.points(v, "w", 5)
    return spark.read.parquet(f"{store.active('w')}/points").select("article_id", "transformed", F.size("point").alias("dims"))


SQL["clu_fixed_map"] = "SELECT CAST(vec_id AS VARCHAR) AS article_id, vec_id % 2 = 1 AS transformed, 5 AS dims FROM embeddings"


@query
def clu_window(spark, sf):
    return L.cluster_window(_vectors(spark, sf).select("article_id", "vector"))


@query
def evl_labeler_agreement(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("labeler"), "label")
    return E.labeler_agreement(e.select("article_id", "labeler", F.when((F.col("article_id") * F.col("labeler")) % 5 == 0, F.col("label") + 100).otherwise(F.col("label")).alias("cluster")))


SQL["evl_labeler_agreement"] = """WITH l AS (SELECT vec_id AS id, k AS labeler, CASE WHEN vec_id * k % 5 = 0 THEN label + 100 ELSE label END AS c FROM embeddings, (VALUES (1), (2), (3)) x(k)),
cell AS (SELECT a.labeler AS la, b.labeler AS lb, a.c AS ca, b.c AS cb, count(*) AS n FROM l a JOIN l b ON a.id = b.id AND a.labeler < b.labeler GROUP BY ALL),
whole AS (SELECT la, lb, sum(n * (n - 1) / 2) AS s, sum(n) AS n FROM cell GROUP BY ALL),
r AS (SELECT la, lb, sum(n * (n - 1) / 2) AS s FROM (SELECT la, lb, ca, sum(n) AS n FROM cell GROUP BY ALL) GROUP BY ALL),
q AS (SELECT la, lb, sum(n * (n - 1) / 2) AS s FROM (SELECT la, lb, cb, sum(n) AS n FROM cell GROUP BY ALL) GROUP BY ALL),
x AS (SELECT whole.s AS s, r.s AS a, q.s AS b, r.s * q.s / (whole.n * (whole.n - 1) / 2) AS e FROM whole JOIN r USING (la, lb) JOIN q USING (la, lb))
SELECT count(*) AS pairs, round(avg(CASE WHEN (a + b) / 2 = e THEN 1 ELSE (s - e) / ((a + b) / 2 - e) END), 4) AS ari FROM x"""


def _judged(v: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of neighbours by number, judged by their label."""
    x = labels.select(F.col("article_id").cast("long").alias("i"), "issue_local")
    return x.select(F.col("i").cast("string").alias("article_id_a"), (F.col("i") + 1).cast("string").alias("article_id_b"), (F.col("issue_local") % 2 == 0).alias("same"))


@query
def evl_sweep(spark, sf):
    v = cut(_vectors(spark, sf))
    return E.sweep(v, _judged(v, issue(spark, sf)), sizes=(3, 5), neighbours=(50,))


@query
def evl_churn(spark, sf):
    v = cut(_vectors(spark, sf).withColumn("arrived_at", F.col("article_id").cast("long")))
    n = v.count()
    return spark.createDataFrame(E.churn(v, [n // 2, 3 * n // 4, n]), "step long, rows long, issues long, noise long, created long, splits long, retired long")
