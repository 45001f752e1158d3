"""Toxicity: a learned lexicon, Levenshtein automata over its trie, and context windows.

1. From a bounded sample of labelled documents (``MAX_TOXIC`` and ``MAX_CLEAN`` of them, by a hash of their
   id, one of verified near copies) the document frequencies of words and word beginnings are counted by label; all that
   speaks strongly for a toxic label becomes a term: a whole word, or a stem that stands for every word beginning with it.
2. The terms form a trie. The automaton that accepts words within a term's number of edits (a letter put in, left
   out, changed, or swapped with its neighbour) is intersected with the trie on the fly: a state is a set of (trie
   node, edits so far), and the deterministic automaton over these sets is kept as it is discovered, so a word costs
   one look-up a letter until it is dead. A changed first letter is forgiven where all the rest agrees. Words may
   hold digits, and masking signs between letters. Words that the clean part of the sample uses itself are
   no misspellings, however near to a term.
3. Hits are weighed in their context: inside quotation marks or beside words of report (quotation), beside
   words of address (abuse). A logistic model over these counts, learned on the same sample with a prior mean and with
   the labels' own rates as weights, gives the score. Whole texts are read; label, language, source and id are no inputs.

Defined results: a null or empty text has no hits and gets the model's base score; repeated rows give repeated
results; a document labelled twice counts as toxic if any label says so; without labels nothing is a term; labels
without a document, and null ids, teach nothing; an empty table gives an empty result; a column called like the
score is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.llm.common import cut, fold, hold_caches, table
from tidewire.llm.minhash import band_keys, linked, minima, shingles

#: Bound of the labelled sample that the lexicon and the weights are fitted on.
MAX_TOXIC, MAX_CLEAN = 4000, 8000
STEM_LETTERS = range(3, 9)
MIN_ODDS, MIN_SUPPORT = 30.0, 5
#: A longer beginning replaces a shorter one that it explains to this share.
EXPLAINS = 0.95
CONTEXT_CHARS = 80
CACHE_WORDS = 500_000
#: Clean documents of the sample that must use a word near a term for it to be a word of its own.
OWN_WORD = 2
#: Words of report and of address, in four languages.
REPORT = frozenset("said says wrote writes called quoted quote according sagte schrieb zitat laut dit écrit selon cité dijo escribió según cita".split())
ADDRESS = frozenset("you your youre du dich dein ihr euch tu toi ton vous votre tú usted ustedes vosotros".split())
FEATURES = ("exact", "distinct", "fuzzy_word", "fuzzy_stem", "quoted", "addressed")
#: Prior means of the weights, the intercept last, and the strength with which they hold.
PRIOR, RIDGE = np.array([1.0, 1.0, 1.0, 0.0, -0.5, 0.5, -3.0]), 1.0
#: Letters and digits, with masking signs between them.
_WORD = re.compile(r"[^\W_]+(?:[*$@]+[^\W_]+)*")
#: Marks that open and close a quotation, each with its own list of places; a straight one does both.
_MARKS = re.compile(r'["“”«»„\n]')
_PAIRS = (("“", "”"), ("«", "»"), ("„", "“"))


def edits(letters: int, stem: bool) -> int:
    """Edits that a term of so many letters forgives."""
    return 0 if letters < 5 else 1 if stem or letters < 9 else 2


class Automaton:
    """The union of the terms' Levenshtein automata, made deterministic as words are read.

    A state is a set of (node, edits, what): ``what`` is empty, a letter that must come next (two were swapped), or
    ``STRICT`` (the first letter was wrong, so all others must agree)."""

    NONE, EXACT, WORD, STEM = range(4)
    STRICT = "strict"

    def __init__(self, terms: list[tuple[str, bool]], own_words: list[str] = ()):
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, bool]]] = [[]]
        self.forgives: list[int] = [0]
        self.own_words = frozenset(own_words)
        for text, stem in terms:
            node, k = 0, edits(len(text), stem)
            self.forgives[0] = max(self.forgives[0], k)
            for c in text:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.ends.append([])
                    self.forgives.append(0)
                node = self.child[node][c]
                self.forgives[node] = max(self.forgives[node], k)
            self.ends[node].append((k, stem))
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.verdict: list[tuple[int, int]] = []
        self.dead = self._state(frozenset())
        self.start = self._state(frozenset({(0, 0, "")}))
        self.known: dict[str, int] = {}

    def _closed(self, states: set[tuple[int, int, str]]) -> frozenset:
        """With letters of terms left out (each an edit), of each node the fewest edits only."""
        best: dict[tuple[int, str], int] = {}
        todo = list(states)
        while todo:
            node, e, what = todo.pop()
            if e > self.forgives[node] or best.get((node, what), 99) <= e:
                continue
            best[node, what] = e
            if node and not what:  # the first letter is never left out
                todo += [(n, e + 1, "") for n in self.child[node].values()]
        return frozenset((node, e, what) for (node, what), e in best.items())

    def _state(self, states: frozenset) -> int:
        if states not in self.ids:
            self.ids[states] = len(self.sets)
            self.sets.append(states)
            self.next.append({})
            whole = stems = self.NONE
            for node, e, what in states:
                if what not in ("", self.STRICT):
                    continue
                for k, stem in self.ends[node]:
                    if e <= k:
                        kind = self.EXACT if e == 0 else self.STEM if stem else self.WORD
                        whole = kind if whole == self.NONE else min(whole, kind)
                        if stem:
                            stems = kind if stems == self.NONE else min(stems, kind)
            self.verdict.append((whole, stems))
        return self.ids[states]

    def _step(self, state: int, c: str) -> int:
        out = set()
        for node, e, what in self.sets[state]:
            child = self.child[node]
            if what not in ("", self.STRICT):
                if c == what:
                    out.add((node, e, ""))
                continue
            if c in child:
                out.add((child[c], e, what))
            if what == self.STRICT:
                continue
            if node:
                out.add((node, e + 1, ""))
                out.update((n, e + 1, "") for n in child.values())
            else:
                out.update((n, e + 1, self.STRICT) for x, n in child.items() if x != c)
            # c and the letter before it in the term have changed places
            out.update((self.child[n][c], e + 1, x) for x, n in child.items() if x != c and c in self.child[n])
        self.next[state][c] = to = self._state(self._closed(out))
        return to

    def __call__(self, word: str) -> int:
        """NONE, EXACT, WORD (a misspelled word) or STEM (a word that begins with a misspelled stem)."""
        found = self.known.get(word)
        if found is None:
            state, begun = self.start, self.NONE
            for c in word:
                to = self.next[state].get(c)
                state = self._step(state, c) if to is None else to
                if state == self.dead:
                    break
                stem = self.verdict[state][1]
                if stem:
                    begun = stem if begun == self.NONE else min(begun, stem)
            found = self.verdict[state][0] if state != self.dead else self.NONE
            found = min(x for x in (found, begun) if x) if found or begun else self.NONE
            if found > self.EXACT and word in self.own_words:
                found = self.NONE
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = found
        return found


class Quotations:
    """Where a text has quotation marks and line ends, found in one walk."""

    def __init__(self, text: str):
        self.places: dict[str, list[int]] = {c: [] for c in '"“”«»„\n'}
        for m in _MARKS.finditer(text):
            self.places[m[0]].append(m.start())

    def _last(self, mark: str, before: int, since: int) -> int:
        """The last place of a mark from ``since`` on and before ``before``, or -1."""
        at = self.places[mark]
        k = bisect_left(at, before)
        return at[k - 1] if k and at[k - 1] >= since else -1

    def around(self, start: int, end: int) -> bool:
        """Whether marks of its line enclose the place: an odd number of straight ones before it and one after, or an opening one."""
        line = self._last("\n", start, 0) + 1
        straight, ends = self.places['"'], self.places["\n"]
        before = bisect_left(straight, start)
        if (before - bisect_left(straight, line)) % 2 == 1:
            k, n = bisect_left(straight, end), bisect_left(ends, end)
            if k < len(straight) and (n == len(ends) or straight[k] < ends[n]):
                return True
        return any(self._last(a, start, line) > self._last(b, start, line) for a, b in _PAIRS)


def _near(text: str, start: int, end: int) -> list[str]:
    """Up to four words on each side."""
    return _WORD.findall(text[max(0, start - CONTEXT_CHARS) : start])[-4:] + _WORD.findall(text[end : end + CONTEXT_CHARS])[:4]


def in_quotation(text: str, start: int, end: int, marks: Quotations | None = None) -> bool:
    """Inside quotation marks of its line, or with a word of report close by in it."""
    if (marks or Quotations(text)).around(start, end):
        return True
    before, after = text[max(0, start - CONTEXT_CHARS) : start].rpartition("\n")[2], text[end : end + CONTEXT_CHARS]
    return not REPORT.isdisjoint(_WORD.findall(before.lower())[-4:] + _WORD.findall(after.lower())[:4])


def features(text: str, automaton: Automaton) -> list[float]:
    low = text.lower()
    hits = {w: kind for w in set(_WORD.findall(low)) if (kind := automaton(w))}
    if not hits:
        return [0.0] * len(FEATURES)
    n, marks = Counter(), Quotations(low)
    for m in _WORD.finditer(low):
        kind = hits.get(m[0])
        if kind:
            n[kind] += 1
            if kind != Automaton.STEM:
                n["quoted"] += in_quotation(low, m.start(), m.end(), marks)
                n["addressed"] += not ADDRESS.isdisjoint(_near(low, m.start(), m.end()))
    distinct = sum(kind == Automaton.EXACT for kind in hits.values())
    return [float(x) for x in np.log1p([n[Automaton.EXACT], distinct, n[Automaton.WORD], n[Automaton.STEM], n["quoted"], n["addressed"]])]


def document_terms(text: str) -> set[str]:
    """``=word`` and ``^beginning`` of the text's words."""
    out = set()
    for w in set(_WORD.findall(text.lower())):
        if 4 <= len(w) <= 30:
            out.add("=" + w)
        out.update("^" + w[:k] for k in STEM_LETTERS if len(w) >= k)
    return out


def choose_terms(counts: dict[str, int]) -> list[tuple[str, bool]]:
    """Terms as (letters, is a stem) from the strongly toxic counts: the shortest beginning that qualifies, made as
    long as it can be while still explaining nearly all of its documents, and a whole word where that does."""
    words = [(t[1:], n) for t, n in counts.items() if t[0] == "="]
    stems = {t[1:]: n for t, n in counts.items() if t[0] == "^"}
    out: dict[str, bool] = {}
    for s in sorted(stems, key=lambda s: (len(s), s)):
        if any(s[:k] in stems for k in range(1, len(s))):
            continue
        branches = [s]
        while branches:
            p = branches.pop()
            n = stems[p]
            longer = [q for q in stems if len(q) == len(p) + 1 and q.startswith(p)]
            main = [q for q in longer if stems[q] >= EXPLAINS * n]
            whole = [w for w, m in words if w.startswith(p) and m >= EXPLAINS * n]
            if whole and not main:
                out[whole[0]] = False
            elif main:
                branches += main
            elif len(p) >= 4:
                out[p] = True
            else:
                branches += longer
    for w, _ in sorted(words, key=lambda x: (-x[1], x[0])):
        if not any(w == t or (stem and w.startswith(t)) for t, stem in out.items()):
            out[w] = False
    return sorted(out.items())


def fit(x: np.ndarray, y: np.ndarray, share: np.ndarray | None = None) -> np.ndarray:
    """Logistic weights, the intercept last, by Newton steps from the prior mean; ``share`` weighs the rows."""
    x, w = np.hstack([x, np.ones((len(x), 1))]), PRIOR.copy()
    share = np.ones(len(x)) if share is None else share
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - y)) + RIDGE * (w - PRIOR)
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _roots(n: int, pairs: Iterable[tuple[int, int]], linked: Callable[[int, int], bool] = lambda i, j: True) -> list[int]:
    """The smallest of each of n items' group under the pairs that are linked; pairs within a group are not asked about again."""
    root = list(range(n))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i, j in pairs:
        a, b = sorted((top(i), top(j)))
        if a != b and linked(i, j):
            root[b] = a
    return [top(i) for i in range(n)]


def _shared(keys: list[list[int]], first_only: bool) -> Iterator[tuple[int, int]]:
    """Pairs of items that share a key: with the first of its holders only, or with every one before."""
    held: dict[int, list[int]] = {}
    for i, own in enumerate(keys):
        for k in own:
            at = held.setdefault(k, [])
            yield from ((j, i) for j in at)
            if not (first_only and at):
                at.append(i)


def _one_of_copies(sample: DataFrame) -> DataFrame:
    """(y, text) of one document of each group of near copies with one label: else the words of one text with many copies would
    pass for terms. The sample is bounded, and so is what the driver groups: documents that share a band of the MinHash operator, which a
    task then compares on their full sets. Rows of one id give one of them, by text; documents without words stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [band_keys(minima(s)).tolist() if len(s := shingles(t.as_py())) else [] for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "y", "keys"])

    sample = cut(sample.groupBy("doc_id", "y").agg(F.max(F.coalesce("text", F.lit(""))).alias("text")))
    rows = sorted(sample.mapInArrow(run, "doc_id long, y int, keys array<long>").collect(), key=lambda r: (r["y"], r["doc_id"]))
    keys = [[2 * k + r["y"] for k in r["keys"]] for r in rows]  # Python's integers: labels never share a key
    root = _roots(len(rows), _shared(keys, first_only=True))
    size = Counter(root)
    grouped = [(r["doc_id"], root[i] if size[root[i]] > 1 else -1) for i, r in enumerate(rows)]
    grouped = F.broadcast(sample.sparkSession.createDataFrame(grouped, "doc_id long, group long"))

    def first_copies(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", ignore_index=True)
        sets = [shingles(t) for t in pdf["text"]]
        found = _roots(len(sets), _shared([band_keys(minima(s)).tolist() for s in sets], first_only=False), lambda i, j: linked(sets[i], sets[j]))
        return pdf[["y", "text"]][[i == r for i, r in enumerate(found)]]

    sample = sample.join(grouped, "doc_id")
    alone = sample.where("group < 0").select("y", "text")
    return cut(alone.unionByName(sample.where("group >= 0").groupBy("group").applyInPandas(first_copies, "y int, text string")))


#: Terms, words of their own, weights.
Model = tuple[list[tuple[str, bool]], list[str], list[float]]


def train(docs: DataFrame, labels: DataFrame, test_fold: int | None = 0) -> Model:
    """(terms, words near a term that are none, weights) from documents (doc_id, text) and labels (doc_id, toxic); ids of
    ``test_fold`` are left out. What the driver gathers comes from the bounded sample only."""
    lab = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    if test_fold is not None:
        lab = lab.where(fold("doc_id") != test_fold)
    pick = lambda y, n: lab.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = cut(pick(1, MAX_TOXIC).unionByName(pick(0, MAX_CLEAN)))
    labelled = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    sample = _one_of_copies(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text"))
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return [], [], PRIOR.tolist()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                seen[y].update(document_terms(t.as_py() or ""))
        terms = list(seen[0].keys() | seen[1].keys())
        for k in range(0, len(terms), 50_000):
            part = terms[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([seen[y][t] for t in part], pa.int64()) for y in (0, 1))], names=["term", "n0", "n1"])

    counted = sample.mapInArrow(count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    odds = ((F.col("n1") + 0.5) / (n1 + 1)) / ((F.col("n0") + 0.5) / (n0 + 1))
    strong = counted.where((F.col("n1") >= MIN_SUPPORT) & (odds >= MIN_ODDS))
    terms = choose_terms({r["term"]: r["n1"] for r in strong.collect()})

    def misspelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words near a term and the documents that have them, by label."""
        automaton, seen = Automaton(terms), (Counter(), Counter())
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                seen[y].update(w for w in set(_WORD.findall(t.as_py().lower())) if automaton(w) > Automaton.EXACT)
        words = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([seen[y][w] for w in words], pa.int64()) for y in (0, 1))], names=["word", "n0", "n1"])

    near = sample.mapInArrow(misspelled, "word string, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    own_words = sorted(r["word"] for r in near.where((F.col("n0") >= OWN_WORD) & (F.col("n0") * n1 >= F.col("n1") * n0)).collect())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(terms, own_words)
        for b in batches:
            rows = [features(t.as_py() or "", automaton) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["y", "x"])

    got = sample.mapInArrow(measure, "y int, x array<double>").collect()  # MAX_TOXIC + MAX_CLEAN short rows at most
    y = np.array([float(r["y"]) for r in got])
    # where the sample's bound has cut one label short, its rows stand for more of their kind
    stands_for = {1: labelled[1] / min(labelled[1], MAX_TOXIC), 0: labelled[0] / min(labelled[0], MAX_CLEAN)}
    share = np.where(y == 1, stands_for[1], stands_for[0])
    w = fit(np.array([r["x"] for r in got]), y, share * len(y) / share.sum())
    return terms, own_words, w.tolist()


def with_score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score column; texts pass through only if docs has them among its columns."""
    terms, own_words, weights = model
    docs = docs.drop(score_col)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_caches("toxicity")
        automaton, w = Automaton(terms, own_words), np.array(weights)
        base = float(w[-1])
        for b in batches:
            z = [base + float(np.dot(w[:-1], f)) if any(f := features(t.as_py() or "", automaton)) else base for t in b.column(names.index(text_col))]
            score = 1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score, pa.float64())], names=[*names, score_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document of ``documents``, learned from ``labels`` outside fold 0."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = with_score(docs, train(docs, labels)).drop("text")
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
