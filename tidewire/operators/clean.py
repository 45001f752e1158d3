"""Removal of publishers' boilerplate from article texts.

The rules interleave (a cut reveals what a later rule takes, the last line is worked on until nothing changes),
so the whole of them runs in one Arrow pass with Python's own regular expressions, whose Unicode classes the
patterns are written for. The steps that stand alone (white space, status, dropping lines) are also column functions."""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.functions import clean_rules as R
from tidewire.functions.session import small_batches
from tidewire.functions.text import trim_unicode

OK, SHORT, EMPTY = "ok", "short", "empty"
ODD_SPACES = "\t 　​"


@dataclass(frozen=True)
class CleanConfig:
    min_clean_len: int = 100
    rules_version: str = R.RULES_VERSION


@functools.cache
def _rules(scope: str, publisher: str | None) -> list[tuple[str, re.Pattern]]:
    return [(name, re.compile(p)) for name, p, only in getattr(R, scope) if only is None or publisher in only]


@functools.cache
def _pattern(text: str) -> re.Pattern:
    return re.compile(text)


_BROKEN = re.compile("(?<![&A-Za-z])(?:" + "|".join(map(re.escape, R.BROKEN_ENTITIES)) + ")")


def clean_text(text: str, publisher: str | None = None) -> tuple[str, list[str]]:
    """(cleaned text, names of the rules that did something, one for each time)."""
    used: list[str] = []

    def note(name: str, changed: object) -> None:
        if changed:
            used.append(name)

    fixed = html.unescape(_BROKEN.sub(lambda m: R.BROKEN_ENTITIES[m[0]], text))
    note("broken_entity", fixed != text)
    fixed = fixed.translate({ord(c): " " for c in ODD_SPACES})
    for name, p in _rules("INLINE", publisher):
        fixed, n = p.subn("", fixed)
        note(name, n)
    mark = _pattern(R.COPYRIGHT)
    halves = [mark.split(line, maxsplit=1) for line in fixed.split("\n")]
    note("copyright", any(len(h) > 1 for h in halves))
    lines = [h[0] for h in halves]
    for name, p in _rules("CUT", publisher):
        at = next((i for i, line in enumerate(lines) if p.search(line.strip())), None)
        note(name, at is not None)
        lines = lines[:at]
    for name, p in _rules("LINE", publisher):
        rest = [line for line in lines if not p.search(line.strip())]
        note(name, len(rest) < len(lines))
        lines = rest
    tail = _rules("TAIL", publisher)
    while lines:
        last = lines[-1].strip()
        name = next((name for name, p in tail if p.search(last)), None) if last else ""
        if name is None:
            break
        note(name, name)
        lines.pop()
    k = next((i for i in range(len(lines) - 1, -1, -1) if lines[i].strip()), None)
    while k is not None:
        hits = len(used)
        for name, p in _rules("TAIL_INLINE", publisher):
            lines[k], n = p.subn("", lines[k])
            note(name, n)
        if len(used) == hits:
            break
    out = squeeze("\n".join(lines))
    bare = re.sub(r"\s*[“‘]\s*$", "", out)
    note("dangling_quote", bare != out)
    spaced = _pattern(R.GLUED).sub(r"\1 ", bare)
    note("sentence_space", spaced != bare)
    return spaced, used


def squeeze(text: str) -> str:
    """Odd spaces and runs of blanks as one blank, lines trimmed, one empty line at most in a row."""
    text = text.translate({ord(c): " " for c in ODD_SPACES})
    text = "\n".join(re.sub(" {2,}", " ", line).strip() for line in text.split("\n"))
    return re.sub("\n{3,}", "\n\n", text).strip()


# -- column functions ----------------------------------------------------------------------------------------------
def normalize_whitespace(c: Column) -> Column:
    lines = F.transform(F.split(F.translate(c, ODD_SPACES, "    "), "\n"), lambda x: trim_unicode(F.regexp_replace(x, " {2,}", " ")))
    return trim_unicode(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"))


def drop_lines(c: Column, pattern: str) -> Column:
    """Without the lines whose trimmed text matches."""
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: ~trim_unicode(x).rlike(f"(?U){pattern}")), "\n")


def status(c: Column, config: CleanConfig = CleanConfig()) -> Column:
    return F.when(c == "", EMPTY).when(F.length(c) < config.min_clean_len, SHORT).otherwise(OK)


# -- operators -----------------------------------------------------------------------------------------------------
def clean(articles: DataFrame, config: CleanConfig = CleanConfig()) -> DataFrame:
    """article_id, publisher_id, published_date, content_clean, content_clean_len, clean_status, rules_applied, removed_chars, rules_version."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [clean_text(t or "", p) for t, p in zip(pdf["content"], pdf["publisher_id"], strict=True)]
            out = pdf[["article_id", "publisher_id", "published_date"]].copy()
            out["content_clean"] = [t for t, _ in done]
            out["rules_applied"] = [r for _, r in done]
            out["removed_chars"] = [len(raw or "") - len(t) for raw, (t, _) in zip(pdf["content"], done, strict=True)]
            yield out

    small_batches(articles.sparkSession)
    src = articles.select("article_id", "publisher_id", "published_date", "content")
    out = src.mapInPandas(run, "article_id string, publisher_id string, published_date string, content_clean string, rules_applied array<string>, removed_chars int")
    return out.select(
        "article_id", "publisher_id", "published_date", "content_clean", F.length("content_clean").alias("content_clean_len"),
        status(F.col("content_clean"), config).alias("clean_status"), "rules_applied", "removed_chars", F.lit(config.rules_version).alias("rules_version"),
    )


def rule_hits(cleaned: DataFrame) -> DataFrame:
    """(rule, hits), most common first, then by name."""
    return cleaned.select(F.explode("rules_applied").alias("rule")).groupBy("rule").agg(F.count("*").alias("hits")).orderBy(F.desc("hits"), "rule")
