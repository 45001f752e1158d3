"""Quality rules with risk-controlled cutoffs.

Every document gets counts and, from them, one severity in [0, 1] per rule.  Base limits (too few words, too
many repeated word windows) are fixed.  Further cutoffs are chosen per stratum (language) from labelled
rows: one half of the labels (``fit``) picks the most useful rules, the other half (``hold``) picks each
rule's cutoff by fixed-sequence testing, from the mildest cutoff on: a cutoff is taken while the exact
binomial (Clopper-Pearson) upper bound of its rate of good documents rejected stays at or under
``RISK / rules``, at confidence ``1 - DELTA / (strata * rules)`` (Bonferroni; within a rule the fixed sequence
needs no correction).  So with probability 1 - DELTA no stratum loses more than RISK of its good documents to
the learned cutoffs.  A stratum with too few labels gets none.  The bound wants independent rows: labelled documents
that fail the base limits are left out, and so are copies: of documents that share any of ``COPY_KEYS`` shingle minima
one counts, the one with the smallest id (a copy at similarity 0.75 slips through with probability 0.25 ** COPY_KEYS).

Defined results: null and empty texts have no words and fail the base limits; a null language is a stratum of
its own; a document with several labels counts as good only if all are; repeated rows give repeated results; ids
that are repeated or null teach nothing twice, or nothing; without labels only the base limits hold; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import cut, fold, hold_caches, table
from tidewire.llm.minhash import ADD, MUL, forget, shingles

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
RISK, DELTA, RULES_PER_STRATUM, BINS = 0.02, 0.1, 4, 100
#: More strata than this and their cutoffs are joined by a shuffle instead of a broadcast.
BROADCAST_STRATA = 10_000
COPY_KEYS = 4
SYMBOLS = "#*$%&|<>"
RULES = ("symbols", "dup_lines", "repeats", "top_word", "no_letter", "long_words", "short_words", "few_distinct", "pipes", "digits", "open_lines")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LETTERS = re.compile(r"[^\W\d_]")
_DIGITS = re.compile(r"[0-9]")
_ENDS = (".", "!", "?", ":", ";", '"', "”", "»", "。")


def repeated_words(words: list[str]) -> int:
    """Words that lie in a 3-word window found at least twice in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def measure(text: str) -> tuple[int, int, int, int, int, list[float]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the rules' severities."""
    words = _WORD.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if x and _WORD.search(x)]
    chars, symbols = sum(map(len, words)), sum(map(text.count, SYMBOLS))
    dup, repeat = len(lines) - len(set(lines)), repeated_words(words)
    if not n:
        return 0, 0, symbols, 0, 0, [0.0] * len(RULES)
    kinds = Counter(words)
    mean = chars / n
    bare = sum(c for w, c in kinds.items() if not _LETTERS.search(w))
    severity = (
        symbols / n, dup / len(lines), repeat / n, kinds.most_common(1)[0][1] / n, bare / n, (mean - 4) / 16, (6 - mean) / 6,
        1 - len(kinds) / n, text.count("|") / (2 * n), len(_DIGITS.findall(text)) / chars, sum(not x.rstrip().endswith(_ENDS) for x in lines) / len(lines),
    )
    return n, chars, symbols, dup, repeat, [min(1.0, max(0.0, x)) for x in severity]


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper-Pearson: the p at which k or fewer of n have probability delta."""
    if n == 0 or k >= n:
        return 1.0
    i = np.arange(k + 1)
    choose = math.lgamma(n + 1) - np.array([math.lgamma(x + 1) + math.lgamma(n - x + 1) for x in i])
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        if np.exp(choose + i * math.log(p) + (n - i) * math.log1p(-p)).sum() > delta:
            low = p
        else:
            high = p
    return high


def choose_cutoffs(hist: pd.DataFrame, strata: int, risk: float = RISK, delta: float = DELTA, rules: int = RULES_PER_STRATUM) -> list[float]:
    """Cutoffs of one stratum from its histogram (held, rule, bin, good, bad); a rule that is off has 2.0.

    A document is rejected by a rule when its severity is at or above the cutoff."""
    grid = np.zeros((2, len(RULES), BINS + 1, 2))
    for held, rule, b, good, bad in hist[["held", "rule", "bin", "good", "bad"]].itertuples(index=False):
        grid[int(held), rule, b] += (good, bad)
    above = grid[:, :, ::-1].cumsum(axis=2)[:, :, ::-1]  # rejected by the cutoff at each bin
    out = [2.0] * len(RULES)
    gain = []
    for r in range(len(RULES)):
        n_good = above[0, r, 0, 0]
        ok = above[0, r, :, 0] <= risk / rules / 2 * n_good
        gain.append(max(above[0, r, ok, 1], default=0))
    used = [r for r in sorted(range(len(RULES)), key=lambda r: -gain[r])[:rules] if gain[r] > 0]
    for r in used:
        n_good = int(above[1, r, 0, 0])
        for b in range(BINS, 0, -1):
            if upper_bound(int(above[1, r, b, 0]), n_good, delta / (strata * rules)) > risk / rules:
                break
            out[r] = b / BINS
        while out[r] < 1 and not above[:, r, round(out[r] * BINS), 1].any() or (out[r] < 1 and _same_bad(above, r, out[r])):
            out[r] = round(out[r] * BINS + 1) / BINS  # a milder cutoff that rejects the same bad ones
    return out


def _same_bad(above: np.ndarray, rule: int, cutoff: float) -> bool:
    b = round(cutoff * BINS)
    return b < BINS and bool((above[:, rule, b, 1] == above[:, rule, b + 1, 1]).all())


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_FIELDS = [*((c, pa.int64()) for c in COUNTS), ("severity", pa.list_(pa.float64())), ("copy_keys", pa.list_(pa.int64()))]
_DDL = ", ".join(f"{c} long" for c in COUNTS) + ", severity array<double>, copy_keys array<long>"


def copy_keys(text: str) -> np.ndarray | None:
    """Minima of COPY_KEYS orders of the text's shingles; none without words."""
    s = shingles(text)
    return (s[:, None] * MUL[:COPY_KEYS] + ADD[:COPY_KEYS]).min(axis=0).view(np.int64) if len(s) else None


def with_measures(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of docs with counts, severities and copy keys; the text is read whole, once."""
    src = docs.select(*keep, F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_caches("quality", forget)
        for b in batches:
            texts = [t.as_py() or "" for t in b.column(len(keep))]
            rows = [(*measure(t), copy_keys(t)) for t in texts]
            cols = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(_FIELDS)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *cols], names=[*keep, *(n for n, _ in _FIELDS)])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_text")
    return src.mapInArrow(run, f"{kept}, {_DDL}")


def stratum(column: str = "lang"):
    return F.coalesce(F.col(column), F.lit("∅"))


def cutoffs(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", strata_col: str = "lang") -> DataFrame:
    """stratum, cut (array of RULES' cutoffs), from documents with measures and labels (doc_id, quality).

    What reaches a task is a stratum's histogram, of a fixed size at most."""
    good = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    able = measured.where(~_base_failed()).select(F.col(id_col).alias("doc_id"), stratum(strata_col).alias("stratum"), "severity", "copy_keys")
    lab = able.join(good, "doc_id").dropDuplicates(["doc_id"])
    for k in range(COPY_KEYS):
        lab = lab.groupBy("stratum", F.col("copy_keys")[k].alias("_key")).agg(F.min_by(F.struct("doc_id", "severity", "_good", "copy_keys"), "doc_id").alias("x")).select("stratum", "x.*")
    lab = cut(lab)
    held = (fold("doc_id", 2) == 0).cast("int")
    hist = (
        lab.select("stratum", held.alias("held"), F.col("_good").cast("long").alias("_good"), F.posexplode("severity").alias("rule", "s"))
        .groupBy("stratum", "held", "rule", F.floor(F.col("s") * BINS).cast("int").alias("bin"))
        .agg(F.sum("_good").alias("good"), F.sum(F.lit(1) - F.col("_good")).alias("bad"))
    )
    hist = cut(hist)
    strata = max(1, hist.select("stratum").distinct().count())

    def pick(key, pdf):
        return pd.DataFrame({"stratum": [key[0]], "cut": [choose_cutoffs(pdf, strata)]})

    return cut(hist.groupBy("stratum").applyInPandas(pick, "stratum string, cut array<double>"))


def _base_failed():
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def judged(measured: DataFrame, chosen: DataFrame, strata_col: str = "lang") -> DataFrame:
    """``measured`` with base_failed, failed_rules and kept."""
    few = chosen.count() <= BROADCAST_STRATA
    out = measured.withColumn("_stratum", stratum(strata_col)).join(
        (F.broadcast(chosen) if few else chosen).withColumnRenamed("stratum", "_stratum"), "_stratum", "left"
    )
    names = F.array(*map(F.lit, RULES))
    hit = F.zip_with("severity", F.coalesce("cut", F.array_repeat(F.lit(2.0), len(RULES))), lambda s, c: F.floor(s * BINS) >= F.round(c * BINS))
    failed = F.filter(F.zip_with(names, hit, lambda n, h: F.when(h, n)), lambda x: x.isNotNull())
    return (
        out.withColumn("base_failed", _base_failed()).withColumn("failed_rules", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("_stratum", "cut")
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document of ``documents``, cutoffs from ``labels``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    measured = cut(with_measures(docs, ["doc_id", "lang"]))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return judged(measured, cutoffs(measured, labels)).select("doc_id", *COUNTS, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))
