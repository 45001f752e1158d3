"""Byte-pair encoding by prefix-sharing trie traversal, and decoding.

The distinct words of a batch form a trie (kept implicitly: sorted words share the path up to their common
prefix).  A depth-first walk keeps, for every byte position of the current path, the *last token* of the
encoding of that prefix.  A token t of n bytes is the last token at position p when its bytes end there and
the pair (last token at p - n, t) is one that byte-pair merging would leave apart; exactly one token is.  So
shared prefixes are worked out once, and a word's ids are read back from its end, last token by last token.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows give repeated
results; texts of any length are encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import chunks, hold_caches, table

#: Split rule of byte-level BPE (fixed value of the vocabulary's format).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond this many words a process starts its cache anew.
CACHE_WORDS = 300_000


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 stays, the rest moves to 256 and up."""
    stays = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(stays)]
    return {chr(b): b for b in stays} | {chr(256 + k): b for k, b in enumerate(moved)}


class TrieBpe:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.token = {raw(s): i for s, i in vocab.items()}
        self.longest = max(map(len, self.token))
        # a token's rank is the place of the merge that makes it; single bytes come before all merges
        rank, self.parts, self.merged = {}, {}, {}
        for n, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            i = vocab[a + b]
            if i not in rank:
                rank[i], self.parts[i] = n, (vocab[a], vocab[b])
            self.merged[vocab[a], vocab[b]] = (n, i)
        self.rank = {i: rank.get(i, -1) for i in vocab.values()}
        self.bytes_of = {i: s for s, i in self.token.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.at_special = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")").split if self.special else None
        self.words = regex.compile(WORD_PATTERN).findall
        self.known: dict[str, bytes] = {}
        self.length_of = [0] * (max(self.bytes_of) + 1)
        for i, s in self.bytes_of.items():
            self.length_of[i] = len(s)
        self.apart = functools.lru_cache(maxsize=1_000_000)(self._apart)

    def _apart(self, left: int, right: int) -> bool:
        """Whether byte-pair merging of left's and right's bytes ends with just these two tokens.

        Undo merges at the seam, the later one first; if a pair across the seam could merge before the
        merge that was undone, the two would not have stayed apart."""
        rank, parts, merged = self.rank, self.parts, self.merged
        limit_left = limit_right = 1 << 60
        while True:
            found = merged.get((left, right))
            # at the seam the left pair comes first on equal rank, so its own merge wins ties
            if found is not None and found[0] < min(limit_left, limit_right + 1):
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit_left, limit_right = a, 1 << 60
                left = parts[left][1]
            else:
                limit_left, limit_right = 1 << 60, b
                right = parts[right][0]

    def learn(self, words: list[str]) -> None:
        """Encode distinct words in one depth-first walk of their trie."""
        token, longest, apart, length_of, known = self.token, self.longest, self.apart, self.length_of, self.known
        path, last = b"", [-1]
        for raw, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            n, top = 0, min(len(raw), len(path))
            if raw[:top] == path[:top]:
                n = top
            else:
                while raw[n] == path[n]:
                    n += 1
            del last[n + 1 :]
            for end in range(n + 1, len(raw) + 1):
                for size in range(min(end, longest), 0, -1):
                    t = token.get(raw[end - size : end])
                    if t is not None and (size == end or apart(last[end - size], t)):
                        last.append(t)
                        break
            path = raw
            ids, end = [], len(raw)
            while end:
                ids.append(last[end])
                end -= length_of[last[end]]
            known[word] = struct.pack(f"<{len(ids)}I", *reversed(ids))

    def _split(self, text: str) -> list[str]:
        """Words of a text; the strings of special tokens stand alone."""
        if self.at_special is None or not any(s in text for s in self.special):
            return self.words(text)
        return [w for part in self.at_special(text) if part for w in ([part] if part in self.special else self.words(part))]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit integers; one trie walk for all their new words."""
        split = [self._split(t) for t in texts]
        known = self.known
        new = {w for w in set().union(*split) if w not in known}
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = set().union(*split)
        known.update((s, struct.pack("<I", i)) for s, i in self.special.items())
        self.learn([w for w in new if w not in self.special])
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


_models: dict[str, TrieBpe] = {}


def model(path: str) -> TrieBpe:
    if path not in _models:
        _models[path] = TrieBpe(path)
    return _models[path]


def forget() -> None:
    """Drop what this process keeps between tasks."""
    _models.clear()


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per document: n_tokens, the ids (when ``keep_ids``, as ``ids``), digests of the ids and of the decoded text."""
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.list_(pa.int64()))] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_caches("bpe", forget)
        bpe = model(tokenizer)
        for b in batches:
            rows = []
            for doc_ids, texts in chunks(b):
                for doc_id, ids in zip(doc_ids, bpe.encode_many(texts), strict=True):
                    row = (doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                    rows.append(row + (list(memoryview(ids).cast("I")),) * keep_ids)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * keep_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, kinds)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded."""
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
