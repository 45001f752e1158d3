"""Language-model scores by a hierarchical Pitman-Yor model with Chinese-restaurant seating.

Restaurants: every token is drawn in the restaurant of its context, the whole word before it; all contexts share the
root restaurant as parent, whose base is uniform over the words seen in training and one unseen word.  A customer is a
token (or a context's table), a dish is a word, and every table sends one customer to the root.  Contexts, dishes
and restaurants grow with the corpus; nothing is hashed together or left out.

1. Documents are read once, in blocks of some ``BLOCK_TOKENS`` tokens.  A block writes its words with their training
   counts, its distinct (context, word) pairs with theirs, and its documents as numbers of its words.
2. Pairs are dealt out by their context, so a context's totals are exact; a context with very many tokens is split by
   its words over several parts, each of which takes its own tables times the parts for the context's.  Gibbs sweeps let the customers
   of a pair leave and sit down again one by one, given the context's tables and the root's probability of the word; the
   proposal is kept by a Metropolis step.  Counts above ``LEAP`` sit down in bundles of a 64th of those seated.  A
   pair met once has one table and needs no sampling.  During these sweeps the root's probabilities are those of the
   distinct contexts that the blocks have counted.
3. A word's customers at the root are its training count less what its pairs' tables save, so only pairs met
   twice or more send anything.  Root seatings are sampled for each kept sample, by words.
4. Tables and totals go back to the blocks, which work out predictive probabilities, averaged over samples.

Training documents are those whose fold of the id is not ``TEST_FOLD``; every document is scored whole.
Defined results: a null or empty text is one end token; a null id trains and is not held out; repeated rows count and
score each; an empty table gives an empty result; with no training documents every probability is the base's; other
columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import drop_folder, shared_dir, table

TEST_FOLD, FOLDS = 1, 5
END = b"\n"
BLOCK_TOKENS = 4_000_000
#: Tokens of a row of documents.
CHUNK_TOKENS = 200_000
DISCOUNT, STRENGTH = (0.85, 0.8), (1.0, 1.0)  # contexts, root
BURN_IN, SAMPLES, LEAP, SEED = 2, 3, 1024, 29
#: Parts that contexts and words are hashed into, for each split of the input.
PARTS_PER_SPLIT = 4
#: A context with more training tokens than HOT_TOKENS, and more than a HOT_SHARE-th of all, is split: HOT_SHARE * 2 contexts at most.
HOT_TOKENS, HOT_SHARE = 1_000_000, 500_000
#: Bytes of a word's hash in a pair, and the step of the logarithm in which its root probability goes along.
PAIR_HASH, LOG_STEP = 5, 8.0
LOW = np.uint64((1 << 8 * PAIR_HASH) - 1)


def pack(x: np.ndarray) -> bytes:
    """Compressed bytes of an array, low bytes of all numbers first; ``unpack`` gives it back."""
    import zstandard

    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1) if len(x) else np.empty((0, 1), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unpack(raw: bytes, kind) -> np.ndarray:
    import zstandard

    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(flat.reshape(width, -1).T).reshape(-1).view(kind) if len(flat) else np.empty(0, kind)


def _part_of(low: np.ndarray, parts: int) -> np.ndarray:
    """The part of a word, from the low bytes of its hash."""
    return ((low & LOW) >> np.uint64(8)).astype(np.int64) % parts


_ROW = [*((c, pa.int64()) for c in ("block", "part", "hot", "x")), ("kind", pa.string()), *((c, pa.binary()) for c in "abcdef"), ("ex", pa.list_(pa.int64()))]
_ROW_DDL = "block long, part long, hot long, x long, kind string, a binary, b binary, c binary, d binary, e binary, f binary, ex array<long>"


def _rows(n: int, **cols) -> pa.RecordBatch:
    arrays = [x if isinstance(x := cols.get(name), pa.Array) else pa.nulls(n, kind) if x is None else pa.array(x, kind) for name, kind in _ROW]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in _ROW])


def _pairs(tokens: np.ndarray, length: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct context * words + word, sorted, and each token's place there; documents begin after an end token."""
    key = np.roll(tokens, 1).astype(np.int64)
    key[np.cumsum(length) - length] = tokens[-1]  # every document ends with the end token
    key *= words
    key += tokens
    return np.unique(key, return_inverse=True)


class Block:
    """Tokens of some documents, numbered within the block."""

    def __init__(self):
        self.number: dict[bytes, int] = {END: 0}
        self.docs: list[tuple[int | None, bool]] = []
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str) -> None:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and ASCII white space only
        number = self.number
        for w in words:
            if w not in number:
                number[w] = len(number)
        ids = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
        self.parts.append(np.append(ids, np.int32(0)))
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == TEST_FOLD
        self.docs.append((doc_id, held))
        self.size += len(words) + 1

    def rows(self, block: int, parts: int) -> Iterator[pa.RecordBatch]:
        """``stat``: x training tokens. ``word``, one a part: a hashes, b training counts, x the first one's number. ``pair``, one a part
        of contexts: a hashes of contexts, b followers of each, c their hashes, d training counts, e log of the words' root shares,
        f first context, x first pair. ``doc``: a ids, b flags (1 held out, 2 null id), c lengths, d numbers of words."""
        import xxhash

        w = np.array([xxhash.xxh64_intdigest(x) for x in self.number], dtype=np.uint64)
        part = _part_of(w, parts)
        order = np.lexsort((w, part))
        rank = np.empty(len(w), np.int64)
        rank[order] = np.arange(len(w))
        w, part = w[order], part[order]
        length = np.array([len(p) for p in self.parts])
        tokens = rank.astype(np.int32)[np.concatenate(self.parts)]
        self.parts.clear()
        training = np.repeat(np.array([not h for _, h in self.docs]), length)
        pairs, at = _pairs(tokens, length, len(w))
        count = np.bincount(at[training], minlength=len(pairs)).astype(np.uint32)
        seen = np.bincount(tokens[training], minlength=len(w)).astype(np.uint32)
        context, word = pairs // len(w), pairs % len(w)
        # the root's share of a word, from the distinct contexts that this block has met it in
        kinds = np.bincount(word[count > 0], minlength=len(w)) + 0.5
        share = np.round(-np.log2(kinds / kinds.sum()) * LOG_STEP).clip(0, 255).astype(np.uint8)
        yield _rows(1, block=[block], kind=["stat"], x=[int(training.sum())])
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        ends = np.r_[cuts[1:], len(part)]
        # every word is a context: each document goes on after it, at least with its end token, and the first one follows that
        size = np.bincount(context, minlength=len(w))
        first = np.r_[0, np.cumsum(size)]
        low = w.view(np.uint8).reshape(-1, 8)[:, :PAIR_HASH]
        spans = list(zip(cuts.tolist(), ends.tolist(), strict=True))
        for k in range(0, len(spans), 64):
            some = spans[k : k + 64]
            n = len(some)
            where = {"block": [block] * n, "part": [int(part[i]) for i, _ in some]}
            yield _rows(n, **where, kind=["word"] * n, x=[i for i, _ in some], a=[w[i:j].tobytes() for i, j in some], b=[pack(seen[i:j]) for i, j in some])
            within = [slice(first[i], first[j]) for i, j in some]
            yield _rows(
                n, **where, kind=["pair"] * n, x=[int(s.start) for s in within], a=[w[i:j].tobytes() for i, j in some], b=[pack(size[i:j].astype(np.uint32)) for i, j in some],
                c=[low[word[s]].tobytes() for s in within], d=[pack(count[s]) for s in within], e=[pack(share[word[s]]) for s in within], f=[np.int64(i).tobytes() for i, _ in some],
            )
        starts = np.cumsum(length) - length
        cut = np.flatnonzero(np.r_[True, starts[1:] // CHUNK_TOKENS != starts[:-1] // CHUNK_TOKENS])
        ids = np.array([0 if d is None else d for d, _ in self.docs], np.int64)
        flags = np.array([int(h) + 2 * (d is None) for d, h in self.docs], np.uint8)
        for i, j in zip(cut, np.r_[cut[1:], len(starts)], strict=True):
            text = tokens[starts[i] : starts[j - 1] + length[j - 1]].astype(np.uint32)
            yield _rows(1, block=[block], kind=["doc"], a=[pack(ids[i:j])], b=[pack(flags[i:j])], c=[pack(length[i:j].astype(np.uint32))], d=[pack(text)])


def _block_reader(parts: int):
    def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, k, block = TaskContext.get().partitionId(), 0, Block()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                block.add(doc_id, text.as_py() or "")
                if block.size >= BLOCK_TOKENS:
                    yield from block.rows((task << 24) | k, parts)
                    k, block = k + 1, Block()
        if block.docs:
            yield from block.rows((task << 24) | k, parts)

    return read_blocks


# -- seating -------------------------------------------------------------------------------------------------------
def seat(n: np.ndarray, new: np.ndarray, d: float, rng: np.random.Generator, leap: int = LEAP) -> tuple[np.ndarray, np.ndarray]:
    """Tables after n customers of one dish sat down one by one, and the log weight of the way they did.

    With i seated at t tables the next one opens a table by new / (i - d * t + new)."""
    t, weight = (n > 0).astype(np.float64), np.zeros(len(n))
    live = np.flatnonzero(n > 1)
    i = np.ones(len(live))
    while len(live):
        step = np.minimum(np.where(i < leap, 1, np.floor(i / 64)), n[live] - i)
        total = i - d * t[live] + new[live]
        p = np.clip(new[live] / total, 0, 1)
        t[live] += (rng.random(len(live)) < p) if (step == 1).all() else rng.binomial(step.astype(np.int64), p)
        weight[live] += step * np.log(total)
        i += step
        on = i < n[live]
        live, i = live[on], i[on]
    return t, weight


class Seating:
    """Tables of the dishes of some restaurants, sampled again by each ``sweep``; ``n`` customers a dish."""

    def __init__(self, n: np.ndarray, restaurant: np.ndarray, restaurants: int, level: int, scale: np.ndarray | float, seed: list[int]):
        self.n, self.restaurant, self.restaurants, self.scale = n.astype(np.float64), restaurant, restaurants, scale
        self.d, self.strength, self.rng = DISCOUNT[level], STRENGTH[level], np.random.default_rng([SEED, level, *seed])
        self.t = np.minimum(self.n, 1.0)
        self.many = np.flatnonzero(self.n > 1)
        self.log_weight = np.full(len(self.many), -np.inf)

    def tables(self) -> np.ndarray:
        """Tables of every restaurant, here."""
        return np.bincount(self.restaurant, self.t, self.restaurants)

    def sweep(self, base: np.ndarray | float) -> None:
        """One seating of every dish, ``base`` being the parent's probability of each."""
        n, at = self.n[self.many], self.restaurant[self.many]
        new = (self.strength + self.d * (self.tables() * self.scale)[at]) * (base[self.many] if isinstance(base, np.ndarray) else base)
        t, w = seat(n, np.maximum(new, 1e-300), self.d, self.rng)
        take = np.log(self.rng.random(len(n))) < w - self.log_weight
        self.t[self.many] = np.where(take, t, self.t[self.many])
        self.log_weight = np.where(take, w, self.log_weight)


def predictive(n, t, customers, tables, parent, level: int):
    """The probability of a dish with n customers at t tables in a restaurant of so many customers and tables."""
    d, s = DISCOUNT[level], STRENGTH[level]
    return (n - d * t + (s + d * tables) * parent) / (s + customers)


def _sample_contexts(key, t):
    """Seating of the contexts of one part. ``answer`` rows, one for each row read: a places of pairs, b training counts, c tables of all
    samples, d contexts' numbers, e their customers, f their tables. ``saved`` rows: customers less tables of a word by sample.
    For a split context, one ``split`` row with its tables here by sample; its total is not known here."""
    t = t.sort_by([("block", "ascending"), ("x", "ascending")])
    part, hot = key[0].as_py(), t.column("hot")[0].as_py()
    col = lambda name: [x.as_py() for x in t.column(name)]
    context = np.concatenate([np.frombuffer(x, np.uint64) for x in col("a")])
    sizes = [unpack(x, np.uint32).astype(np.int64) for x in col("b")]
    raw = np.frombuffer(b"".join(col("c")), np.uint8).reshape(-1, PAIR_HASH)
    word = np.zeros((len(raw), 8), np.uint8)
    word[:, :PAIR_HASH] = raw
    word = word.view(np.uint64).reshape(-1)
    count = np.concatenate([unpack(x, np.uint32) for x in col("d")]).astype(np.float64)
    share = np.concatenate([unpack(x, np.uint8) for x in col("e")])
    names, number = np.unique(context, return_inverse=True)
    number = np.repeat(number, np.concatenate(sizes))
    _, first, at = np.unique(names[number] * np.uint64(0x9E3779B97F4A7C15) + word, return_index=True, return_inverse=True)
    n, ctx = np.bincount(at, count, len(first)), number[first]
    base = 2.0 ** (-share[first].astype(np.float64) / LOG_STEP)
    scale = float(t.column("part_count")[0].as_py())
    s = Seating(n, ctx, len(names), 0, scale, [part & 0x7FFFFFFF])
    kept, totals = [], []
    for k in range(BURN_IN + SAMPLES):
        s.sweep(base)
        if k >= BURN_IN:
            kept.append(s.t.copy())
            totals.append(s.tables())
    customers = np.bincount(ctx, n, len(names))
    pair_ends, ctx_ends = np.r_[0, np.cumsum([x.sum() for x in sizes])], np.r_[0, np.cumsum([len(x) for x in sizes])]
    where = np.searchsorted(names, context)
    out: dict[str, list] = {name: [] for name in "bcef"}
    for k in range(t.num_rows):
        mine, own = at[pair_ends[k] : pair_ends[k + 1]], where[ctx_ends[k] : ctx_ends[k + 1]]
        for name, x in (("b", n[mine]), ("c", np.concatenate([x[mine] for x in kept])), ("e", customers[own]), ("f", np.concatenate([x[own] for x in totals]))):
            out[name].append(pack(x.astype(np.int64)))
    rows = [_rows(t.num_rows, block=col("block"), kind=["answer"] * t.num_rows, hot=[hot] * t.num_rows, a=col("f"), d=col("g"), **out)]
    if hot >= 0:
        rows.append(_rows(1, kind=["split"], hot=[hot], ex=[[int(customers.sum()), *(int(x.sum()) for x in totals)]]))
    saved = np.stack([n - x for x in kept])
    some = np.flatnonzero(saved.any(axis=0))
    words, to = np.unique(word[first][some], return_inverse=True)
    by_word = np.stack([np.bincount(to, x[some], len(words)) for x in saved]).astype(np.int64)
    ex = pa.ListArray.from_arrays(np.arange(len(words) + 1, dtype=np.int32) * SAMPLES, by_word.T.reshape(-1))
    rows.append(_rows(len(words), kind=["saved"] * len(words), x=words.astype(np.int64), ex=ex))
    return pa.Table.from_batches(rows)


def _dealer(parts: int, hot: dict[int, tuple[int, int, int]]):
    """Rows of pairs by the part of their context; a split context (hash -> index, first part, parts) goes by its words.

    f becomes places of the pairs in their block, g numbers of the contexts."""
    keys = np.array(sorted(hot), dtype=np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(12)]
            for r in b.to_pylist():
                w, size = np.frombuffer(r["a"], np.uint64), unpack(r["b"], np.uint32).astype(np.int64)
                raw = np.frombuffer(r["c"], np.uint8).reshape(-1, PAIR_HASH)
                count, share = unpack(r["d"], np.uint32), unpack(r["e"], np.uint8)
                numbers = int(np.frombuffer(r["f"], np.int64)[0]) + np.arange(len(w))
                owner = np.repeat(np.arange(len(w)), size)
                split = np.isin(w, keys)

                def put(part, index, of, contexts, pairs):
                    places = (r["x"] + pairs).astype(np.uint32)
                    row = (
                        r["block"], part, index, of, int(places[0]), w[contexts].tobytes(), pack(np.bincount(owner[pairs], minlength=len(w))[contexts].astype(np.uint32)), raw[pairs].tobytes(),
                        pack(count[pairs]), pack(share[pairs]), pack(np.diff(places, prepend=np.uint32(0))), pack(numbers[contexts].astype(np.uint32)),
                    )
                    for column, v in zip(out, row, strict=True):
                        column.append(v)

                rest = np.flatnonzero(~split[owner])
                if len(rest):
                    put(r["part"], -1, 1, np.flatnonzero(~split), rest)
                for i in np.flatnonzero(split):
                    index, start, of = hot[int(w[i])]
                    mine = np.flatnonzero(owner == i)
                    low = np.zeros((len(mine), 8), np.uint8)
                    low[:, :PAIR_HASH] = raw[mine]
                    to = (low.view(np.uint64).reshape(-1) >> np.uint64(3)).astype(np.int64) % of
                    for k in np.unique(to):
                        put(start + int(k), index, of, np.array([i]), mine[to == k])
            kinds = [pa.int64()] * 5 + [pa.binary()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=["block", "part", "hot", "part_count", "x", *"abcdefg"])

    return deal


_DEALT = "block long, part long, hot long, part_count long, x long, a binary, b binary, c binary, d binary, e binary, f binary, g binary"


def _sample_root(key, words, saved):
    """Root seatings of the words of one part. ``root`` rows, one for each row read: x first number, a training counts, b customers of all
    samples, c tables of all samples. One ``total`` row: distinct trained words, then customers and tables by sample."""
    part = key[0].as_py()
    words = words.sort_by([("block", "ascending"), ("x", "ascending")])
    w = [np.frombuffer(x.as_py(), np.uint64) for x in words.column("a")]
    flat = np.concatenate(w) if w else np.empty(0, np.uint64)
    n = np.concatenate([unpack(x.as_py(), np.uint32) for x in words.column("b")]).astype(np.float64) if w else np.empty(0)
    names, at = np.unique(flat, return_inverse=True)
    c = np.bincount(at, n, len(names))
    low = names & LOW
    keys = np.array(saved.column("w").to_pylist(), np.uint64)
    order = np.argsort(keys)
    keys = keys[order]
    customers, tables = [], []
    trained = int((c > 0).sum())
    for k in range(SAMPLES):
        less = np.zeros(len(names))
        if len(keys):
            by = np.array(saved.column(f"e{k}").to_pylist(), np.float64)[order]
            place = np.minimum(np.searchsorted(keys, low), len(keys) - 1)
            less = np.where(keys[place] == low, by[place], 0.0)
        m = np.maximum(c - less, np.minimum(c, 1.0))
        # the root's tables and its base are both in proportion to the words: with this part's words as a sample their product is known
        s = Seating(m, np.zeros(len(m), np.int64), 1, 1, 1.0, [part & 0x7FFFFFFF, k])
        for _ in range(BURN_IN + 1):
            s.sweep(1.0 / (trained + 1))
        customers.append(m)
        tables.append(s.t)
    ends = np.r_[0, np.cumsum([len(x) for x in w])].astype(np.int64)
    out: dict[str, list] = {name: [] for name in "abc"}
    for i, j in zip(ends[:-1], ends[1:], strict=True):
        mine = at[i:j]
        for name, x in (("a", c[mine]), ("b", np.concatenate([y[mine] for y in customers])), ("c", np.concatenate([y[mine] for y in tables]))):
            out[name].append(pack(x.astype(np.int64)))
    total = [trained, *(int(x.sum()) for x in customers), *(int(x.sum()) for x in tables)]
    n_rows = words.num_rows
    return pa.Table.from_batches([_rows(1, kind=["total"], ex=[total]), _rows(n_rows, block=words.column("block").to_pylist(), kind=["root"] * n_rows, x=words.column("x").to_pylist(), **out)])


def _scorer(tokens: int, vocabulary: int, root_totals: list[tuple[float, float]], split: dict[int, list[int]]):
    """Scores of a block's documents from its ``doc``, ``root`` and ``answer`` rows."""

    def score_block(key, t):
        rows = {kind: t.filter(pc.equal(t.column("kind"), kind)).to_pylist() for kind in ("doc", "root", "answer")}
        ids = np.concatenate([unpack(r["a"], np.int64) for r in rows["doc"]])
        flags = np.concatenate([unpack(r["b"], np.uint8) for r in rows["doc"]])
        length = np.concatenate([unpack(r["c"], np.uint32) for r in rows["doc"]]).astype(np.int64)
        text = np.concatenate([unpack(r["d"], np.uint32) for r in rows["doc"]]).astype(np.int32)
        roots = sorted(rows["root"], key=lambda r: r["x"])
        c = np.concatenate([unpack(r["a"], np.int64) for r in roots])
        words = len(c)
        of = lambda r, name: unpack(r[name], np.int64).reshape(SAMPLES, -1)
        m, t0 = np.concatenate([of(r, "b") for r in roots], axis=1), np.concatenate([of(r, "c") for r in roots], axis=1)
        root = [predictive(m[k], t0[k], *root_totals[k], 1.0 / (vocabulary + 1), 1) for k in range(SAMPLES)]
        pairs, at = _pairs(text, length, words)
        n, tables = np.zeros(len(pairs), np.int64), np.zeros((SAMPLES, len(pairs)), np.int64)
        customers, totals = np.zeros(words, np.int64), np.zeros((SAMPLES, words), np.int64)
        for r in rows["answer"]:
            places, numbers = np.cumsum(unpack(r["a"], np.uint32), dtype=np.uint32), unpack(r["d"], np.uint32)
            n[places], tables[:, places] = unpack(r["b"], np.int64), of(r, "c")
            if r["hot"] >= 0:
                customers[numbers], totals[:, numbers] = split[r["hot"]][0], np.array(split[r["hot"]][1:])[:, None]
            else:
                customers[numbers], totals[:, numbers] = unpack(r["e"], np.int64), of(r, "f")
        context, word = pairs // words, pairs % words
        p = sum(predictive(n, tables[k], customers[context], totals[k][context], root[k][word], 0) for k in range(SAMPLES)) / SAMPLES
        starts = np.cumsum(length) - length
        base = np.log10((c + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
        add = lambda x: np.add.reduceat(x, starts)
        return pa.table(
            [
                pa.array(ids, mask=flags >= 2), pa.array(flags % 2 == 1), pa.array(length), pa.array(add((c > 0)[text].astype(np.int64))),
                pa.array(np.full(len(ids), tokens)), pa.array(add(base[text])), pa.array(add(np.log10(p)[at])),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return score_block


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/hpylm-{uuid.uuid4().hex}"
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # parts follow the input's splits, so what a part holds stays the same at any size
    parts = PARTS_PER_SPLIT * max(1, src.rdd.getNumPartitions())
    kept = lambda kind, df: _stored(spark, df, f"{folder}/{kind}")
    src.mapInArrow(_block_reader(parts), _ROW_DDL).write.partitionBy("kind").option("compression", "zstd").parquet(f"{folder}/blocks")
    blocks = {kind: _read(spark, f"{folder}/blocks/kind={kind}") for kind in ("stat", "word", "pair", "doc")}
    tokens, n_blocks = blocks["stat"].agg(F.coalesce(F.sum("x"), F.lit(0)), F.count("*")).first()
    if not n_blocks:
        return spark.createDataFrame([], RESULT)
    hot = _split_contexts(blocks["word"], tokens, n_blocks, parts)

    dealt = blocks["pair"].select("block", "part", "x", *"abcdef").mapInArrow(_dealer(parts, hot), _DEALT)
    sampled = kept("sampled", dealt.groupBy("part").applyInArrow(_sample_contexts, _ROW_DDL))
    drop_folder(spark, f"{folder}/blocks/kind=pair")
    # one row a split context: HOT_SHARE * 2 at most
    parts_of = sampled.where("kind = 'split'").groupBy("hot").agg(*[F.sum(F.col("ex")[k]).alias(f"s{k}") for k in range(SAMPLES + 1)]).collect()
    split = {r["hot"]: [r[f"s{k}"] for k in range(SAMPLES + 1)] for r in parts_of}

    saved = sampled.where("kind = 'saved'").groupBy(F.col("x").alias("w")).agg(*[F.sum(F.col("ex")[k]).alias(f"e{k}") for k in range(SAMPLES)])
    saved = saved.withColumn("part", F.shiftright("w", 8) % parts)
    words = blocks["word"].select("block", "part", "x", "a", "b")
    roots = kept("roots", words.groupBy("part").cogroup(saved.groupBy("part")).applyInArrow(_sample_root, _ROW_DDL))
    totals = roots.where("kind = 'total'").agg(*[F.coalesce(F.sum(F.col("ex")[k]), F.lit(0)) for k in range(2 * SAMPLES + 1)]).first()
    root_totals = [(float(totals[1 + k]), float(totals[1 + SAMPLES + k])) for k in range(SAMPLES)]

    columns = ["block", "kind", "hot", "x", *"abcdef"]
    back = blocks["doc"].withColumn("kind", F.lit("doc")).select(*columns)
    back = back.unionByName(roots.where("kind = 'root'").select(*columns)).unionByName(sampled.where("kind = 'answer'").select(*columns))
    return back.groupBy("block").applyInArrow(_scorer(tokens, totals[0], root_totals, split), RESULT)


def _read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of one kind; none where no file was written (an empty input has no folder to take a schema from)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], _ROW_DDL)
    return spark.read.schema(_ROW_DDL).parquet(path)


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return _read(spark, path)


def _split_contexts(words: DataFrame, tokens: int, blocks: int, parts: int) -> dict[int, tuple[int, int, int]]:
    """hash -> (index, first part, parts) of the contexts to split: every word with ``most`` training tokens, and none with under half of it.

    A block reports a word from most / (2 * blocks) on, so what stays unreported of a word is under half of ``most``."""
    most = max(HOT_TOKENS, tokens // HOT_SHARE)
    least = max(1, most // (2 * blocks))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, n = [], []
            for x, y in zip(b.column(0), b.column(1), strict=True):
                count = unpack(y.as_py(), np.uint32).astype(np.int64)
                at = np.flatnonzero(count >= least)
                w.append(np.frombuffer(x.as_py(), np.int64)[at])
                n.append(count[at])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(w) if w else [], pa.int64()), pa.array(np.concatenate(n) if n else [], pa.int64())], names=["w", "n"])

    found = words.select("a", "b").mapInArrow(frequent, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") * 2 >= most)
    out, start = {}, parts
    for k, r in enumerate(sorted(found.collect(), key=lambda r: r["w"])):
        of = max(2, -(-2 * r["n"] // most))
        out[r["w"] & 0xFFFFFFFFFFFFFFFF] = (k, start, of)
        start += of
    return out


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text of ``documents`` under a model of those outside the test fold."""
    return score(table(spark, sf_dir, "documents", "doc_id", "text"))
