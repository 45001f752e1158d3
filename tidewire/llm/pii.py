"""Personal data: patterns propose spans, checksums confirm them, nearby context words adjust the score.

Base kinds (email, ip, card, phone) are fixed by pattern and validator and always stay; their score only
ranks them.  Further kinds (iban by mod-97, ssn) are kept when their score, after context, reaches
``MIN_SCORE``.  All scans are linear in the text: no pattern can rescan a long run from each of its places.

Defined results: null and empty texts have no spans; repeated rows give repeated results; spans of one kind
never overlap, spans of different kinds may; positions are code points with exclusive end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import hold_caches, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
MIN_SCORE = 0.5
CONTEXT_CHARS = 48
CONTEXT = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel", "@"),
    "ip": ("ip", "server", "host", "address", "adresse", "dirección", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "anruf", "téléphone", "teléfono", "whatsapp"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta", "swift", "bic"),
    "ssn": ("ssn", "social", "security", "tax", "insurance", "national"),
}
#: Words that speak against: examples, versions, product and order numbers.
AGAINST = ("example", "test", "version", "isbn", "order", "invoice", "serial")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LUHN = str.maketrans("0123456789", "0246813579")


def luhn(digits: str) -> bool:
    """Check digit of payment cards: every second digit from the right counts double (minus 9 above 9)."""
    return (sum(map(int, digits[-1::-2])) + sum(map(int, digits[-2::-2].translate(_LUHN)))) % 10 == 0


def mod97(iban: str) -> bool:
    """IBAN check: the country and check digits moved to the end, letters as 10 to 35, leave 1 when divided by 97."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and a domain with a dot; each character is looked at a bounded number of times."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four base kinds, by start, then kind in the listed order."""
    found = [(s, e, 0) for s, e in emails(text)] if "@" in text else []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    if "+" in text:
        found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return [(s, e, BASE[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


def context_score(text: str, start: int, end: int, kind: str) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start].lower() + " " + text[end : end + CONTEXT_CHARS].lower()
    score = PRIOR[kind] + 0.25 * any(w in near for w in CONTEXT[kind]) - 0.25 * any(w in near for w in AGAINST)
    return min(1.0, max(0.0, score))


def spans(text: str) -> list[tuple[int, int, str, float]]:
    """All spans with scores, by start, then kind."""
    found = [(s, e, k, context_score(text, s, e, k)) for s, e, k in base_spans(text)]
    more = [(m.start(), m.end(), "iban") for m in _IBAN.finditer(text) if mod97(m[0].replace(" ", ""))]
    more += [(m.start(), m.end(), "ssn") for m in _SSN.finditer(text)]
    found += [(s, e, k, score) for s, e, k in more if (score := context_score(text, s, e, k)) >= MIN_SCORE]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]))) if more else found


def redact(text: str, found: list[tuple[int, int, str, float]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, named after the first."""
    out, at = [], 0
    for start, end, kind, _ in found:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: spans as array of (kind, start, end, score)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_caches("pii")
        for b in batches:
            rows = [[{"kind": k, "start": s, "end": e, "score": v} for s, e, k, v in spans(t.as_py() or "")] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>"
    )


def redact_text(docs: DataFrame, text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in ``text_col`` (and ``count_col`` set to the new length); nulls stay null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_caches("pii")
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(names)}
            texts = [None if (x := t.as_py()) is None else redact(x, spans(x)) for t in cols[text_col]]
            cols[text_col] = pa.array(texts, pa.string())
            if count_col in cols:
                cols[count_col] = pa.array([None if t is None else len(t) for t in texts]).cast(cols[count_col].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=names)

    return docs.mapInArrow(run, docs.schema)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the spans of every document of ``documents``."""
    found = find_pii(table(spark, sf_dir, "documents", "doc_id", "text"))
    mark = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in BASE],
        F.sha2(F.array_join(F.transform(base, mark), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", mark), ",").alias("spans"),
        *[count(k) for k in KINDS if k not in BASE],
        F.coalesce(F.array_max(F.transform("spans", lambda x: x["score"])), F.lit(0.0)).alias("top_score"),
    )
