"""Best-fit packing with swap-based local search.

``pieces`` turns every document into tokenizer pieces (long documents are cut), ``pack`` places pieces into
sequences of at most ``capacity`` tokens.  Packing runs over shards of bounded size: each shard is packed
best-fit-decreasing, then a local search over the underfull bins moves a document, swaps one for one or two
for one (one of either side, two of the other) whenever that raises the sum of squared fills, until nothing improves,
until there are no more bins than a lower bound proves necessary, or for ``STEPS`` steps, the same in every shard.  All underfull bins and all documents in them
take part; documents of one length are interchangeable, so a bin counts by its distinct lengths.  Bins with hardly any room
close; what lies in the others is dealt into the next round's shards, which are fewer, until one shard is left.  A
round that does not halve the tokens left lets bins with four times the room close from then on.

Defined results: a null or empty text is one piece that holds the end token alone; repeated rows are packed
once per row; an empty table gives an empty result; equal lengths are taken in (doc_id, piece) order; other columns
are not read.
"""

from __future__ import annotations

import math
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import chunks, cut, hold_caches, table

CAPACITY = 4096
#: Tokens that one packing shard holds about: bounds a task's memory (some 20,000 documents).
SHARD_TOKENS = 4_000_000
#: Pieces that one packing shard holds at most about, for inputs of very short texts.
SHARD_PIECES = 50_000
END_ID = 1
#: Exchanges that are compared in one step of array work; bins that the search of a shard, any shard, works on.
COMPARED, STEPS = 1_000_000, 1000
KEYS = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

#: Words of the tokenizer's own split rule, for texts of Latin letters (fixed value: the file's pattern).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Beyond this many words the per-process cache starts anew.
CACHE_WORDS = 300_000
CACHE_RUNS = 600_000


class WordIds:
    """Ids of whole texts as little-endian bytes. Each run of non-space letters is encoded once and then looked up.

    Texts with characters beyond Latin Extended-A, or with special-token marks, go to the library whole."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.words = regex.compile(WORD_PATTERN).findall
        self.beyond = re.compile(r"[^\x09-\x0d\x20-\x7e\u00a1-\u012f\u0132-\u017f\u2010-\u2027]").search
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.known_words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def odd(self, text: str) -> bool:
        """Whether the library must take the text whole."""
        return "<|" in text or self.beyond(text) is not None

    def _learn_words(self, new: list[str]) -> None:
        """Encode words, many in one call with spaces between; every word ends in a token that ends a word."""
        for k in range(0, len(new), 2000):
            part = new[k : k + 2000]
            ids = np.array(self.tok.encode(" ".join(part), add_special_tokens=False).ids, dtype="<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) != len(part):  # not so for some word: one call each
                self.known_words.update((w, struct.pack(f"<{len(e.ids)}I", *e.ids)) for w, e in zip(part, self.tok.encode_batch(part, add_special_tokens=False), strict=True))
                continue
            raw, at = ids.tobytes(), 0
            for w, end in zip(part, ends.tolist(), strict=True):
                self.known_words[w] = raw[at:end]
                at = end

    def _learn(self, runs: list[str]) -> None:
        """Most runs are letters, perhaps with one other character at the end: these are words without a pattern search."""
        words = self.known_words
        plain = [r for r in runs if r.isalpha()]
        tail = [r for r in runs if not r.isalpha() and r[:-1].isalpha()]
        rest = {r: self.words(r) for r in runs if not r.isalpha() and not r[:-1].isalpha()}
        needed = set(plain)
        needed.update(r[:-1] for r in tail)
        needed.update(r[-1] for r in tail)
        needed.update(*rest.values())
        new = {w for w in needed if w not in words}
        if len(words) + len(new) > CACHE_WORDS:
            words.clear()
            new = needed
        self._learn_words(list(new))
        known = self.known
        for r in plain:
            known[r] = words[r]
        for r in tail:
            known[r] = words[r[:-1]] + words[r[-1]]
        for r, x in rest.items():
            known[r] = b"".join([words[w] for w in x])

    def many(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        runs = {}
        for i, text in enumerate(texts):
            if self.odd(text):
                ids = self.tok.encode(text, add_special_tokens=False).ids
                out[i] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                runs[i] = unicodedata.normalize("NFC", text).lower().split()
        known = self.known
        new = set().union(*runs.values()).difference(known.keys())
        if len(known) + len(new) > CACHE_RUNS:
            known.clear()
            new = set().union(*runs.values())
        self._learn(list(new))
        for i, x in runs.items():
            out[i] = b"".join(map(known.__getitem__, x))
        return out

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


_encoders: dict[str, WordIds] = {}


def _encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def forget() -> None:
    """Drop what this process keeps between tasks."""
    _encoders.clear()


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's token pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_caches("packing", forget)
        encode, step, end = _encoder(tokenizer), 4 * capacity, struct.pack("<I", END_ID)
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_ids, texts in chunks(b):
                for doc_id, ids in zip(doc_ids, encode.many(texts), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        for col, v in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def lower_bound(length: list[int], capacity: int) -> int:
    """Bins that any packing needs. For every size a: documents above capacity - a share with none of size a or more, those above
    half the capacity do not share with each other, and what is left beside them must hold the rest of size a or more."""
    x = np.sort(np.array(length, np.int64))
    if not len(x):
        return 0
    total = np.r_[0, np.cumsum(x)]
    half = int(np.searchsorted(x, capacity // 2, "right"))
    a = np.unique(np.r_[1, x[:half]])
    large, from_a = np.searchsorted(x, capacity - a, "right"), np.searchsorted(x, a, "left")
    large, from_a = np.maximum(large, half), np.minimum(from_a, half)
    alone, beside = len(x) - large, large - half
    room = beside * capacity - (total[large] - total[half])
    more = np.maximum(0, -(-(total[half] - total[from_a] - room) // capacity))
    return int((alone + beside + more).max())


class Bins:
    """Bins of one shard: ``items[b]`` are indexes into ``length``; ``room`` finds bins by free space with one bit per size."""

    def __init__(self, length: list[int], capacity: int):
        self.length, self.capacity = length, capacity
        self.items: list[set[int]] = []
        self.fill: list[int] = []
        self.room: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.mask = 0
        self.sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _place(self, b: int) -> None:
        free = self.capacity - self.fill[b]
        if free and self.items[b]:
            self.room[free].add(b)
            self.mask |= 1 << free

    def _lift(self, b: int) -> None:
        free = self.capacity - self.fill[b]
        here = self.room[free]
        here.discard(b)
        if not here:
            self.mask &= ~(1 << free)

    def change(self, b: int, out: tuple[int, ...], into: tuple[int, ...]) -> None:
        self._lift(b)
        self.items[b].difference_update(out)
        self.items[b].update(into)
        self.fill[b] += sum(self.length[i] for i in into) - sum(self.length[i] for i in out)
        self.sums.pop(b, None)
        self._place(b)

    def least_room(self, size: int) -> int | None:
        """The smallest free space of at least ``size`` that some bin has."""
        above = self.mask >> size
        return size + (above & -above).bit_length() - 1 if above else None

    def best_fit(self, i: int) -> None:
        free = self.least_room(self.length[i])
        if free is None:
            self.items.append(set())
            self.fill.append(0)
            b = len(self.items) - 1
        else:
            b = next(iter(self.room[free]))
        self.change(b, (), (i,))

    # -- local search ------------------------------------------------------------------------------------------
    def _emptiest(self):
        """Bins with room, from the one with most of it."""
        mask = self.mask
        while mask:
            free = mask.bit_length() - 1
            yield from sorted(self.room[free])
            mask ^= 1 << free

    def _move(self, b: int, i: int) -> int | None:
        """Move i to the tightest other bin that takes it and is, with it, fuller than b is now; that bin."""
        n = self.length[i]
        self._lift(b)
        free = self.least_room(n)
        to = next(iter(self.room[free])) if free is not None else None
        self._place(b)
        if to is None or self.fill[to] + n <= self.fill[b]:
            return None
        self.change(b, (i,), ())
        self.change(to, (), (i,))
        return to

    def _sums(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """What one document of b may measure, and what two may, each size once."""
        if b not in self.sums:
            sizes = np.array(sorted(self.length[i] for i in self.items[b]))
            one = np.unique(sizes)
            twice = one[np.diff(np.r_[np.searchsorted(sizes, one), len(sizes)]) > 1]
            self.sums[b] = one, np.unique(np.r_[(one[:, None] + one[None, :])[np.triu_indices(len(one), 1)], 2 * twice])
        return self.sums[b]

    def _pick(self, b: int, size: int, two: bool) -> tuple[int, ...]:
        """One or two documents of b that measure ``size``."""
        by_size: dict[int, int] = {}
        for i in sorted(self.items[b]):
            n = self.length[i]
            if n == size and not two:
                return (i,)
            if two and size - n in by_size:
                return by_size[size - n], i
            by_size.setdefault(n, i)
        raise LookupError(size)

    def _best(self, b: int, others: list[int]) -> tuple[int, int, int, bool, int, bool]:
        """Of exchanges of one or two of b for one or two of a bin of ``others`` (not two for two) the one by which that bin gains most
        within its capacity: gain, bin, size that b gives, whether of two, size that it gets back, whether of two.

        Bins come by free space, which no gain exceeds."""
        one, two = self._sums(b)
        best = (0, -1, 0, False, 0, False)
        at = 0
        while at < len(others) and self.capacity - self.fill[others[at]] > best[0]:
            first, size = at, 0
            while at < len(others) and size * (len(one) + len(two)) <= COMPARED:
                size += sum(map(len, self._sums(others[at])))
                at += 1
            some = others[first:at]
            for back_two in (False, True):
                back = [self.sums[c][back_two] for c in some]
                owner = np.repeat(np.arange(len(some)), [len(x) for x in back])
                flat = np.concatenate(back)
                free = self.capacity - np.array([self.fill[c] for c in some])[owner]
                for give, give_two in ((one, False), (two, True)):
                    if give_two and back_two or not len(give) or not len(flat):
                        continue
                    gain = give[:, None] - flat[None, :]
                    gain[gain > free] = 0
                    k = int(gain.argmax())
                    if gain.flat[k] > best[0]:
                        i, j = divmod(k, len(flat))
                        best = (int(gain.flat[k]), some[owner[j]], int(give[i]), give_two, int(flat[j]), back_two)
        return best

    def _swap(self, b: int) -> set[int]:
        """Make the best exchange with a bin at least as full as b: whatever that gains raises the sum of squares. The bins changed."""
        gain, c, out, out_two, into, into_two = self._best(b, [c for c in self._emptiest() if c != b and self.fill[c] >= self.fill[b]])
        if not gain:
            return set()
        out, into = self._pick(b, out, out_two), self._pick(c, into, into_two)
        self.change(b, out, into)
        self.change(c, into, out)
        return {b, c}

    def _frees(self, b: int, changed: set[int]) -> bool:
        """Whether b, for which nothing improved, may now give something to one of the bins that have changed."""
        to = sorted((c for c in changed if c != b and self.items[c] and self.capacity > self.fill[c] >= self.fill[b]), key=lambda c: self.fill[c])
        least = int(self._sums(b)[0][0])
        return any(self.capacity - self.fill[c] >= least for c in to) or (bool(to) and self._best(b, to)[0] > 0)

    def improve(self, least: int = 0, steps: int = STEPS) -> None:
        """Work on the emptiest bin: empty it into the others by moves and exchanges, until nothing improves, ``least`` bins are left or
        ``steps`` bins have been worked on. Each change raises the sum of squared fills. A bin for which nothing improves is taken
        up again only when one of the bins that have changed since can take something of it."""
        used, stuck = sum(1 for x in self.items if x), set()
        for _ in range(steps):
            b = next((b for b in self._emptiest() if b not in stuck), None) if used > least else None
            if b is None:
                return
            changed = set()
            for i in sorted(self.items[b], key=lambda i: (-self.length[i], i)):
                to = self._move(b, i)
                changed |= {b, to} if to is not None else set()
            used -= not self.items[b]
            changed = changed or self._swap(b)
            if changed:
                stuck = {x for x in stuck - changed if not self._frees(x, changed)}
            else:
                stuck.add(b)


def pack_lengths(length: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of indexes. Every length is at most ``capacity``."""
    bins = Bins(length, capacity)
    for i in sorted(range(len(length)), key=lambda i: (-length[i], i)):
        bins.best_fit(i)
    bins.improve(lower_bound(length, capacity))
    return [sorted(x) for x in bins.items if x]


def _packer(level: int, last: bool, capacity: int, slack: int):
    def run(key, pdf):
        pdf = pdf.sort_values(KEYS, kind="stable", ignore_index=True)
        length = pdf["length"].tolist()
        shard = int(key[0])
        sequence, offset = [0] * len(length), [0] * len(length)
        for k, items in enumerate(pack_lengths(length, capacity)):
            full = last or sum(length[i] for i in items) >= capacity - slack
            at = 0
            for i in items:
                sequence[i] = ((level << 57) | (shard << 26) | k) if full else -1
                offset[i], at = at, at + length[i]
        return pdf[KEYS].assign(sequence_id=sequence, offset=offset)

    return run


def pack(rows: DataFrame, capacity: int = CAPACITY, shard_tokens: int = SHARD_TOKENS, slack: int | None = None) -> DataFrame:
    """Adds sequence_id and offset to rows of (doc_id, piece, start, length, ids_crc32).

    Bins with at most ``slack`` free tokens (a thousandth of the capacity) close in a round, what lies in the others is packed again
    with that of other shards, until all that is left fits one shard. After a round that does not halve the tokens, ``slack`` is
    four times as large: so the rounds are few, and only bins that shards cannot fill better close with more room."""
    slack = capacity // 1024 if slack is None else slack
    open_rows, done, level, before = cut(rows.select(*KEYS)), [], 0, None
    while True:
        n, tokens = open_rows.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        shards = max(1, math.ceil(tokens / shard_tokens), math.ceil(n / SHARD_PIECES))
        if before is not None and tokens > before / 2:
            slack = max(1, 4 * slack)
        before, last = tokens, shards == 1
        dealt = open_rows.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", F.lit(level)), F.lit(shards)))
        placed = dealt.groupBy("_shard").applyInPandas(_packer(level, last, capacity, slack), PIECES + ", sequence_id long, offset long")
        if last:
            done.append(placed)
            break
        placed = cut(placed)
        done.append(placed.where("sequence_id >= 0"))
        open_rows = placed.where("sequence_id < 0").select(*KEYS)
        level += 1
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` packed into sequences of 4096 tokens."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
