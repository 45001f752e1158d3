"""Queries of the cleaning rules: a passage for every rule, dealt over the documents, with what is left of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators import clean as C
from tidewire.plans.language_queries import SQL, _pick, _values
from tidewire.plans.oracle import SQL as OTHER_SQL
from tidewire.plans.queries import query
from tidewire.plans.views import table

BODY, END = "첫 문단의 본문이다.", "끝 문단도 본문이다."

#: Lines that a rule takes out between two paragraphs: rule, line, publisher.
LINES = (
    ("news1_terms", "뉴스1이 제공하는 기사입니다", None), ("suicide_notice", "※ 우울감 등 말하기 어려운 고민", None), ("photo_credit_line", "[연합뉴스]", None), ("image_caption_marker", "이미지 확대", None),
    ("newsletter_promo", "매일 뉴스레터를 구독하세요", None), ("tip_line", "제보는 카카오톡 아이디로", None), ("ai_notice", "※ 이 기사는 인공지능이 썼다", None), ("weather_source_notice", "기사의 원 데이터인 날씨", "yonhap"),
    ("license_notice", "콘텐츠 사용과 관련해 궁금한 점은", "yonhap"), ("video_notice", "* 해당 내용은 관련 동영상에서", None), ("wowtv_ad", "와우스탁론 안내", "wowtv"), ("series_intro", "[오늘의 사람]은 한 사람을 소개합니다", None),
    ("rt_summary_notice", "인공지능이 자동으로 줄인 것", "yonhap"), ("rt_dispatch_stamp", "송고 2024년 1월", "yonhap"), ("rt_google_promo", "구글 검색에서 더 자주 보기", None), ("rt_hankyung_reco", "AI 추천 뉴스", "hankyung"),
    ("rt_hankyung_ui", "기사 스크랩", "hankyung"), ("rt_mk_ui", "글자 크기", "mk"), ("rt_donga_ui", "- 좋아요", "donga"), ("rt_seoul_summary_label", "세줄 요약", "seoul"), ("rt_ohmynews_motto", "오마이뉴스의 모토는 시민", "ohmynews"),
    ("rt_ad_line", "광고", None), ("rt_image_marker", "▲", None), ("rt_wire_credit_line", "(서울 = 뉴시스)", None), ("rt_google_register", "구글 선호 매체 등록", None), ("rt_donga_wire_list", "- 뉴시스(서울)", "donga"),
    ("rt_etnews_ui", "- ET Events", "etnews"), ("rt_hankyung_signature", "홍길동 한경닷컴 기자 abc@hankyung.com", "hankyung"),
)
#: Lines from which on a rule cuts everything.
CUTS = (("rt_seoul_quiz", "기사를 끝까지 읽으셨나요?", "seoul"), ("rt_kmib_widget", "많이 본 기사", "kmib"), ("rt_hankyung_premium", "한경 프리미엄9의 모든 콘텐츠는 무료", "hankyung"), ("rt_mk_widget", "뉴스퀴즈", "mk"))
#: Last lines that a rule takes away (ad_marker_line never does: rt_ad_line has taken its line before).
TAILS = (
    ("reporter_email_line", "abc@news.com", None), ("reporter_signature_line", "서울 홍길동 기자", None), ("email_then_name_line", "abc@news.com 홍길동 선임기자", None), ("multi_signature_line", "홍길동 전문기자 a@b.com, 김철수 수석기자 c@d.com", None),
    ("credits_line", "취재: 홍길동", None), ("related_line", "▶ 관련 기사", None), ("desk_signature_line", "[어느신문 디지털뉴스부]", None), ("date_stamp_line", "2024/01/02 10:30 송고", None), ("affiliate_signoff", "CJB 홍길동", "sbs"),
    ("kormedi_credit", "◆ 기사 도움: 어느 병원", "kormedi"),
)
#: Rule, text, publisher, what is left.
INSIDE = (
    ("wire_header", f"(서울=뉴스1) 홍길동 기자 = {BODY}", None, BODY), ("dateline_header", f"부산 = 홍길동 기자\n{BODY}", None, BODY), ("outlet_prefix", f"[어느신문] {BODY}", None, BODY), ("broadcast_marker", f"<앵커> {BODY}", None, BODY),
    ("photo_credit", f"{BODY} (사진=어느회사) {END}", None, f"{BODY} {END}"), ("broadcast_signoff", f"{BODY} KBS 뉴스 홍길동입니다.", None, BODY), ("credits_inline", f"{BODY} 영상편집: 홍길동", None, BODY),
    ("copyright", f"{BODY} 저작권자 ⓒ 어느신문", None, BODY), ("photo_credit_tail", f"{BODY} 사진=어느회사", None, BODY), ("provided_credit_tail", f"{BODY} 어느회사 제공", None, BODY), ("reporter_signature_inline", f"{BODY} 홍길동 기자 abc@news.com", None, BODY),
    ("reporter_name_glued", f"{BODY} 홍길동 선임기자", None, BODY), ("newsbot_notice", f"{BODY} [이 기사는 로봇이 작성했습니다.]", "sedaily", BODY), ("factcheck_notice", f"{BODY} ※ JTBC는 시청자 의견을 듣습니다", "jtbc", BODY),
    ("broken_entity", "그는 amp;#39;말amp;#39;했다.", None, "그는 '말'했다."), ("dangling_quote", f"{BODY} “", None, BODY), ("sentence_space", "한 문장이다.다음 문장이다.", None, "한 문장이다. 다음 문장이다."),
    ("", "그대로 둔다 아무 규칙도 없다", None, "그대로 둔다 아무 규칙도 없다"), ("", "", None, ""), ("", f"{BODY}\n광고가 아닌 줄\n{END}", None, f"{BODY}\n광고가 아닌 줄\n{END}"), ("", f"{BODY}\nAI 추천 뉴스\n{END}", "mk", f"{BODY}\nAI 추천 뉴스\n{END}"),
    ("", "긴 본문이 이어진다 " * 11, None, ("긴 본문이 이어진다 " * 11).strip()),
)
#: rule, text, publisher, what is left; all of the above.
PASSAGES = (
    *((r, f"{BODY}\n{x}\n{END}", p, f"{BODY}\n{END}") for r, x, p in LINES), *((r, f"{BODY}\n{x}\n{END}", p, BODY) for r, x, p in CUTS), *((r, f"{BODY}\n{x}", p, BODY) for r, x, p in TAILS), *INSIDE,
)


def _passages(spark, sf) -> DataFrame:
    k = F.col("doc_id") % len(PASSAGES)
    d = table(spark, sf, "documents").select("doc_id", F.format_string("a%09d", "doc_id").alias("article_id"), F.lit("2024-01-01").alias("published_date"))
    return d.select("*", _pick(k, [p or "other" for _, _, p, _ in PASSAGES]).alias("publisher_id"), _pick(k, [t for _, t, _, _ in PASSAGES]).alias("content"))


@query
def cln_rules(spark, sf):
    """Each rule alone: what is left, its name, letters removed, status."""
    got = C.clean(_passages(spark, sf))
    return got.select("article_id", "content_clean", F.array_join("rules_applied", ",").alias("rules"), "removed_chars", "clean_status")


@query
def cln_rule_counts(spark, sf):
    return C.rule_hits(C.clean(_passages(spark, sf)))


def _status(text: str) -> str:
    return "empty" if not text else "short" if len(text) < 100 else "ok"


_KNOWN = _values([(k, rule, left, len(text) - len(left), _status(left)) for k, (rule, text, _, left) in enumerate(PASSAGES)])
SQL["cln_rules"] = f"SELECT printf('a%09d', doc_id) AS article_id, content_clean, rules, removed_chars, clean_status FROM documents JOIN {_KNOWN} x(k, rules, content_clean, removed_chars, clean_status) ON doc_id % {len(PASSAGES)} = k"
SQL["cln_rule_counts"] = f"SELECT rule, count(*) AS hits FROM documents JOIN {_KNOWN} x(k, rule, t, n, s) ON doc_id % {len(PASSAGES)} = k WHERE rule <> '' GROUP BY rule"
SQL["cln_squeeze"] = OTHER_SQL["cln_whitespace"]
