"""Boilerplate patterns of news texts, by scope. All patterns here are fixed values of the cleaning rules."""

from __future__ import annotations

RULES_VERSION = "2026-09-08"

# Entities that lost their ampersand, longest first.
BROKEN_ENTITIES = {
    "amp;#39;": "'",
    "amp;quot;": '"',
    "amp;amp;": "&",
    "apos;": "'",
    "quot;": '"',
    "nbsp;": " ",
    "amp;": "&",
    "lt;": "<",
    "gt;": ">",
}

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"

# Where a copyright tail begins.
COPYRIGHT = (
    r"[“\"\[<(]?\s*(?:GoodNews paper|Copyright\s*[©ⓒⒸ]|저작권자?\s*(?:[ⓒ©Ⓒ]|\(c\))|[ⓒ©Ⓒ]\s*\S|☞"
    r"|무단\s*전재\s*(?:및|[-·,/와과])?\s*(?:수집|재배포|배포|복사|복제|캡처))"
)

# Fixed values: (name, pattern, publishers or None), in the order in which they apply.
INLINE = (
    ("wire_header", r"^\s*[\[(][^\[\]()=]{1,15}=\s*[^\[\]()]{1,12}[\])]\s*[가-힣]{2,5}\s*(?:선임|수석)?기자\s*=\s*", None),
    ("dateline_header", r"^\s*[가-힣]{1,6}\s*=\s*[가-힣]{2,4}\s*(?:선임|수석)?기자\s*\n", None),
    ("outlet_prefix", r"^\s*\[[가-힣A-Za-z]{2,10}(?:뉴스|신문|일보|경제|타임스)\]\s*", None),
    (
        "broadcast_marker",
        r"<\s*(?:앵커|기자|출연자|진행|리포트|앵커멘트|인터뷰)\s*>"
        r"|\[\s*(?:앵커|리포트|기자|인터뷰|녹취|싱크|VCR|CG)\s*\]"
        r"|【\s*(?:앵커멘트|앵커|기자|인터뷰|녹취)\s*】",
        None,
    ),
    ("photo_credit", r"\(\s*사진\s*[=:：][^()]{1,80}\)|\s*사진\s*=\s*[가-힣]{2,4}\s*기자", None),
    ("broadcast_signoff", r"\s*(?:KBS|MBN|SBS|JTBC|YTN|MBC|TV조선|채널A)\s*뉴스\s*[가-힣]{2,4}입니다\.?", None),
    ("credits_inline", r"\s*(?:촬영기자|영상취재|영상편집|그래픽|촬영|편집|CG|화면제공|자료조사)\s*[:：][^\n]*$", None),
)

CUT = (
    ("rt_seoul_quiz", r"^기사를 끝까지 읽으셨나요|^\[\s*내안의 AI 본성 분석|^Q\.$", ("seoul",)),
    ("rt_kmib_widget", r"^클릭! 기사는 어떠셨나요|^많이 본 기사$|^오늘의 추천기사$", ("kmib",)),
    ("rt_hankyung_premium", r"^한경 프리미엄9의 모든 콘텐츠는", ("hankyung",)),
    ("rt_mk_widget", r"^(?:매경에서 선정한 주요뉴스|기사 속 종목 이야기|추천질문|뉴스퀴즈|아직 가입을 안 하셨다면,?)$", ("mk",)),
)

LINE = (
    ("news1_terms", r"뉴스1이 제공하는 기사", None),
    ("suicide_notice", r"^※\s*우울감", None),
    ("photo_credit_line", r"^(?:\(\s*사진\s*[=:：][^()]*\)|[\[<(]\s*(?:연합뉴스|뉴시스|뉴스1|연합|AP|AFP|로이터)\s*[\])>])$", None),
    ("image_caption_marker", r"^(?:이미지\s*확대|사진\s*확대|확대보기)$", None),
    ("newsletter_promo", r"^☞|뉴스레터를 구독", None),
    ("tip_line", r"^(?:기사 문의나\s*)?제보는\s*카카오톡", None),
    ("ai_notice", r"^※\s*이 기사는.*(?:인공지능|자연어|자동)", None),
    ("weather_source_notice", r"^기사의 원 데이터인", ("yonhap",)),
    ("license_notice", r"콘텐츠 사용과 관련해 궁금한 점|저작권법에 따라 보호되는 콘텐츠", ("yonhap",)),
    ("video_notice", r"^\*?\s*해당 내용은 관련 동영상|^※\s*자세한 내용은 동영상|^\(남은 이야기는 스프에서\)$", None),
    ("wowtv_ad", r"와우스탁론", ("wowtv",)),
    ("series_intro", r"^\[[^\]]{2,40}\]?\s*(?:은|는|,)?\s.*(?:다룹니다|코너입니다|소개합니다)", None),
    ("rt_summary_notice", r"^전체 내용을 이해하기 위해서는 기사 본문과 함께|^인공지능이 자동으로 줄인", ("yonhap",)),
    ("rt_dispatch_stamp", r"^송고\s*\d{4}년", ("yonhap",)),
    ("rt_google_promo", r"^(?:구글|Google)\s*검색(?:에서)?\s.*(?:우선적으로|더 자주|선호)", None),
    ("rt_hankyung_reco", r"^AI 추천 뉴스$", ("hankyung",)),
    ("rt_hankyung_ui", r"^(?:기사 스크랩|댓글|공유|프린트|글자크기|-)$", ("hankyung",)),
    ("rt_mk_ui", r"^(?:공유|글자 크기|가|번역|구글 검색 선호 추가|M매경미디어 소개|뉴스 바로가기|햄버거|AI검색|로그인|마이페이지|로그아웃|매일경제\s*\d*)$", ("mk",)),
    ("rt_donga_ui", r"^(?:-|-\s*\d+개|-\s*(?:좋아요|슬퍼요|화나요|후속기사 원해요|추천해요)|글자크기 설정|공유하기(?:\s.*)?)$", ("donga",)),
    ("rt_seoul_summary_label", r"^세줄 요약$", ("seoul",)),
    ("rt_ohmynews_motto", r"^오마이뉴스의 모토는", ("ohmynews",)),
    ("rt_ad_line", r"^광고$", None),
    ("rt_image_marker", r"^▲$", None),
    ("rt_wire_credit_line", r"^[\[(][가-힣]{2,8}\s*=\s*(?:연합뉴스|뉴시스|뉴스1)[\])]$", None),
    ("rt_google_register", r"^구글 선호 매체 등록$", None),
    ("rt_donga_wire_list", r"^-\s*(?:뉴시스|뉴스1|연합뉴스)(?:\s*\([가-힣]{1,6}\))?$", ("donga",)),
    ("rt_etnews_ui", r"^(?:-|-\s*ET\s*Events)$", ("etnews",)),
    ("rt_hankyung_signature", r"^[가-힣]{2,4}\s*한경닷컴\s*기자\s+" + EMAIL + r"$", ("hankyung",)),
)

TAIL = (
    ("reporter_email_line", r"^[\[(]?\s*" + EMAIL + r"\s*[\])]?$", None),
    ("reporter_signature_line", r"^(?:[가-힣/=·]{1,10}\s+){0,3}[가-힣/=·]{2,12}\s*(?:기자|특파원)(?:\s+" + EMAIL + r")?$", None),
    ("email_then_name_line", r"^" + EMAIL + r"\s+[가-힣]{2,4}\s*(?:선임|수석|전문|인턴|객원)?\s*기자$", None),
    ("multi_signature_line", r"^(?:[가-힣]{2,4}\s*(?:선임|수석|전문|인턴|객원)?\s*기자\s+" + EMAIL + r"[,\s]*)+$", None),
    ("credits_line", r"^(?:촬영기자|영상취재|영상편집|그래픽|취재|편집|촬영|CG|화면제공|자료조사)\s*[:：]", None),
    ("ad_marker_line", r"^광고$", None),
    ("related_line", r"^▶\s*관련\s*기사", None),
    (
        "desk_signature_line",
        r"^[\[(]\s*(?:[A-Za-z가-힣]+\s*){1,5}(?:기자|디지털뉴스부|디지털뉴스편집부|온라인뉴스부|온라인뉴스팀)"
        r"(?:\s*/?\s*" + EMAIL + r")?\s*[\])]+[·,\s]*$",
        None,
    ),
    ("date_stamp_line", r"^\d{4}[/.-]\d{2}[/.-]\d{2}(?:\s+\d{2}:\d{2}(?::\d{2})?)?(?:\s*송고)?$", None),
    ("affiliate_signoff", r"^[A-Z]{2,5}\s+[가-힣]{2,4}$", ("sbs",)),
    ("kormedi_credit", r"^◆?\s*기사\s*도움\s*[:：]", ("kormedi",)),
)

TAIL_INLINE = (
    ("photo_credit_tail", r"[,\s]*(?:사진\s*=\s*[^\n,<>]{1,40}|<[^<>\n]{1,40}>)\s*$", None),
    ("provided_credit_tail", r"[,\s]*[가-힣A-Za-z0-9·&]{2,25}(?:\s+[가-힣A-Za-z0-9·&]{1,15}){0,2}\s*제공\s*$", None),
    (
        "reporter_signature_inline",
        r"\s*(?:(?:[가-힣A-Za-z]{2,6}\s*){1,4}기자\s*)?[\[(]?\s*" + EMAIL + r"\s*[\])]?"
        r"(?:\s*\[[^\]]{0,60}\])?(?:\s*\([^()]{1,30}\))?(?:\s*[가-힣]{2,12}(?:부|팀|본부|국))?[,\s]*$",
        None,
    ),
    (
        "reporter_name_glued",
        r"(?<=[.!?“”‘’\"'\)])\s*"
        r"(?:(?:[가-힣]{1,8}(?:\s+[가-힣]{1,8})?\s*[=\s]\s*)?[가-힣]{2,4}\s*"
        r"(?:(?:선임|수석|전문|인턴|객원)?\s*(?:기자|특파원))?\s*[·,]\s*)*"
        r"(?:[가-힣]{1,8}(?:\s+[가-힣]{1,8})?\s*[=\s]\s*)?[가-힣]{2,4}\s*(?:선임|수석|전문|인턴|객원)?\s*(?:기자|특파원)\s*$",
        None,
    ),
    ("newsbot_notice", r"\s*\[이 기사는[^\]]*작성했습니다\.?\]\s*$", ("sedaily",)),
    ("factcheck_notice", r"\s*(?:JTBC\s*팩트체크는[^\n※]*)?※\s*JTBC는\s*시청자[^\n]*$", ("jtbc",)),
)

# Fixed value: a sentence end with the next sentence glued to it.
GLUED = r"(?<=[가-힣])([.!?])(?=[가-힣0-9“‘\"'\[(])"
