"""Text expressions, all built-in functions: Unicode trim, n-grams, sentences, quotes, numbers, URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Python's str.strip: the class of (?U)\s and the four information separators.
SPACE = r"[\s\u001c-\u001f]"

# Sentence ends, opinion and reporting markers.
SENTENCE_ENDS = ".!?。！？"
OPINION_MARKERS = ("것으로 보인다", "필요하다", "해야 한다", "바람직하다", "문제다", "우려된다", "아쉽다")
REPORTING_MARKERS = (
    "라고 밝혔다", "고 밝혔다", "라고 말했다", "고 말했다", "라고 전했다", "고 전했다",
    "라고 설명했다", "고 설명했다", "라고 주장했다", "고 주장했다", "라고 강조했다", "고 강조했다",
)
# Query parameters that only track where a reader came from.
TRACKING_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "igshid", "page", "date", "ref", "from")


def trim_unicode(c: Column) -> Column:
    """Python's strip(): Spark's trim takes plain spaces only."""
    return F.regexp_replace(c, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def is_blank(c: Column) -> Column:
    return trim_unicode(c) == ""


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def shingles(c: Column, k: int = 4) -> Column:
    """Distinct k-letter substrings; empty when the text is shorter. The look-ahead form is linear in the text."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(rf"(?s)(?=(.{{{k}}}))"), F.lit(1)))


def word_grams(c: Column, sizes: tuple[int, ...]) -> Column:
    """Character n-grams inside words, each word padded with one blank on both sides, with repeats.

    A padded word no longer than a size gives itself once, and no larger sizes."""
    padded = F.transform(F.filter(F.split(F.lower(c), rf"(?U){SPACE}+"), lambda w: w != ""), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def of(w: Column) -> Column:
        parts = []
        for k in sizes:
            whole = F.when(F.length(w) == k, F.array(w)) if k > min(sizes) else F.when(F.length(w) <= k, F.array(w))
            parts.append(whole.when(F.length(w) > k, F.regexp_extract_all(w, F.lit(rf"(?s)(?=(.{{{k}}}))"), F.lit(1))).otherwise(F.array().cast("array<string>")))
        return F.concat(*parts)

    return F.flatten(F.transform(padded, of))


def sentences(c: Column) -> Column:
    """Split after an end mark before white space or Hangul, and at line ends; trimmed, no empty ones."""
    cut = F.split(trim_unicode(c), rf"(?U)(?<=[{SENTENCE_ENDS}])(?:{SPACE}+|(?=[가-힣]))|\n+")
    return F.filter(F.transform(F.coalesce(cut, F.array().cast("array<string>")), trim_unicode), lambda s: s != "")


def is_reported(c: Column) -> Column:
    """A straight quotation mark (curly ones do not count) or a reporting marker."""
    return c.contains('"') | c.contains("'") | contains_any(c, REPORTING_MARKERS)


def is_opinion(c: Column) -> Column:
    return ~is_reported(c) & contains_any(c, OPINION_MARKERS)


def quotes(c: Column) -> Column:
    """Texts between straight or curly double quotation marks, trimmed, without empty ones, in order."""
    straight_or_curly = F.regexp_extract_all(c, F.lit(r'("[^"]+"|“[^”]+”)'), F.lit(1))
    inner = F.transform(straight_or_curly, lambda q: trim_unicode(F.substring(q, F.lit(2), F.length(q) - 2)))
    return F.filter(F.coalesce(inner, F.array().cast("array<string>")), lambda q: q != "")


def speech_type(c: Column) -> Column:
    """direct_quote, reported_speech or null."""
    return F.when(F.size(quotes(c)) > 0, "direct_quote").when(contains_any(c, REPORTING_MARKERS), "reported_speech")


def fact_numbers(c: Column) -> Column:
    """Numbers as written, in order, without the age-and-class notes of persons."""
    plain = F.regexp_replace(c, r"(?U)\(\s*\d{1,3}\s*[·,/]\s*\d{1,3}\s*기?\s*\)", "")
    return F.regexp_extract_all(plain, F.lit(r"(?U)(\d+(?:,\d{3})*(?:\.\d+)?)"), F.lit(1))


def normalize_url(c: Column, tracking: tuple[str, ...] = TRACKING_PARAMS) -> Column:
    """Without fragment and tracking parameters; what is left of the query sorted by (key, value) and encoded anew."""
    url = F.split(trim_unicode(c), "#", 2)[0]
    head, query = F.split(url, r"\?", 2)[0], F.coalesce(F.try_element_at(F.split(url, r"\?", 2), F.lit(2)), F.lit(""))
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            F.coalesce(F.try_url_decode(F.split(p, "=", 2)[0]), F.split(p, "=", 2)[0]).alias("k"),
            F.coalesce(F.try_url_decode(F.coalesce(F.try_element_at(F.split(p, "=", 2), F.lit(2)), F.lit(""))), F.try_element_at(F.split(p, "=", 2), F.lit(2)), F.lit("")).alias("v"),
        ),
    )
    kept = F.array_sort(F.filter(pairs, lambda p: ~p["k"].isin(*tracking)))
    enc = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    text = F.array_join(F.transform(kept, lambda p: F.concat(enc(p["k"]), F.lit("="), enc(p["v"]))), "&")
    scheme = F.regexp_extract(head, r"\A([A-Za-z][A-Za-z0-9+.-]*):", 1)
    lowered = F.when(scheme != "", F.concat(F.lower(scheme), F.substring(head, F.length(scheme) + 1, F.length(head)))).otherwise(head)
    return F.when(text == "", lowered).otherwise(F.concat(lowered, F.lit("?"), text))


def article_id(publisher: Column, url: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.concat(publisher, F.lit("|"), normalize_url(url)), 256))


def id_verified(given: Column, publisher: Column, url: Column) -> Column:
    """Whether a given id, prefix optional, equals the one worked out."""
    bare = F.lower(trim_unicode(F.regexp_replace(given, r"\Asha256:", "")))
    return F.concat(F.lit("sha256:"), bare) == article_id(publisher, url)
