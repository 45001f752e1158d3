"""MinHash near-duplicates: many universal hash minima, banding, verification on full sets, large-star/small-star.

1. Every text becomes its set of 5-word shingles (64-bit hashes of lower-cased words), ``HASHES`` minima of
   multiply-add hashes, ``BANDS`` band keys of ``ROWS`` minima each, and one byte of every minimum as signature.
   At similarity 0.75 a pair misses all bands with probability (1 - 0.75**5)**40 = 2e-5.
2. Texts with equal sets are one class; its smallest doc_id stands for it.
3. Each bucket links its members to its smallest member only (rows grow with the members, not with pairs);
   these pairs are verified on full sets and joined to components.
4. Buckets that still hold several components get every pair across components looked at: small buckets by
   pairs, larger ones in tasks of at most 2 * ``BLOCK`` members, by signatures first. Only members that nearly agree with
   another in a signature (six standard deviations under 0.75) go on with their full sets; there a pair is verified
   in the first band it shares, and only links leave a task. This is exact for whatever shared a bucket, with no cap
   on its size.

Defined results: a null or empty text, or one without words, has no shingles and links with nothing; repeated
rows give repeated results; rows of one doc_id take their smallest component, and where their texts differ, the one whose
set has the smallest digest is compared in step 4; a null doc_id is its own, unlinked; an empty table gives an empty
result; other columns are not read; a text of any length is one row, its shingles some eight bytes a word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import cut, hold_caches, table
from tidewire.llm.components import components

WORDS, PERCENT = 5, 75
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
SMALL, BLOCK = 24, 512
#: Share of equal signature bytes below which a pair is not verified: 0.75 less six standard deviations.
SIGNATURE_FLOOR = 0.75 - 6 * (0.75 * 0.25 / HASHES) ** 0.5
#: Up to this many ids are broadcast to pick their texts; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Classes of equal sets above this many documents, and above this share of all, are broadcast: 1 / HEAVY_SHARE of them at most.
HEAVY, HEAVY_SHARE = 1000, 1e-5
SALTS = 32
CACHE_WORDS = 400_000

_U = np.uint64


def _family(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, dtype=_U) * _U(2) + _U(1), rng.integers(0, 1 << 63, n, dtype=_U)


MUL, ADD = _family(7, HASHES)
WORD_MUL = _family(11, WORDS)[0]
_known: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of SplitMix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word windows; the whole sequence when it is shorter."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z and ASCII white space only
    if not found:
        return np.empty(0, _U)
    if len(found) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), len(found))], _U)
    new = {w for w in found if w not in _known}
    if new:
        if len(_known) + len(new) > CACHE_WORDS:
            _known.clear()
            new = set(found)
        _known.update((w, xxhash.xxh64_intdigest(w)) for w in new)
    h = np.fromiter(map(_known.__getitem__, found), _U, len(found))
    n = len(h) - words + 1
    total = np.zeros(n, _U)
    for k in range(words):
        total += h[k : k + n] * WORD_MUL[k]
    return np.unique(_mix(total))


def forget() -> None:
    """Drop what this process keeps between tasks."""
    _known.clear()


def minima(s: np.ndarray) -> np.ndarray:
    out = None
    for k in range(0, len(s), 256):
        part = s[k : k + 256, None] * MUL
        part += ADD
        part = part.min(axis=0)
        out = part if out is None else np.minimum(out, part)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, of its minima and its number."""
    key = np.arange(BANDS, dtype=_U)
    for k in range(ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + m[k::ROWS])
    return key.view(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_key, keys (band keys), sig (one byte per minimum)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hold_caches("minhash", forget)
        for b in batches:
            out: list[list] = [[], [], [], []]
            for t in b.column(1):
                s = shingles(t.as_py() or "")
                out[0].append(len(s))
                if len(s):
                    m = minima(s)
                    out[1].append(xxhash.xxh3_128_digest(s.tobytes()))
                    out[2].append(band_keys(m))
                    out[3].append((m >> _U(24)).astype(np.uint8).tobytes())
                else:
                    for col in out[1:]:
                        col.append(None)
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))], names=["doc_id", "n_shingles", "set_key", "keys", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, keys array<long>, sig binary"
    )


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, shingle set as bytes) of the documents in ids (id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t.as_py() or "").tobytes() for t in b.column(1)], pa.binary())], names=["id", "s"])

    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(ids) if few else ids, "id", "left_semi").mapInArrow(run, "id long, s binary")


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= PERCENT * union, on full sets."""
    small, large = sorted((len(x), len(y)))
    if not small or 100 * small < PERCENT * large:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= PERCENT * (len(x) + len(y) - shared)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough.

    b's set travels once a pair; a's, which may be the head of very many pairs, once per salt."""
    p = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    heads = p.select("a", "salt").distinct().join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
    both = p.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b").join(heads, ["a", "salt"]).select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for sa, sb in zip(batch.column(2), batch.column(3), strict=True):
                keep.append(linked(np.frombuffer(sa.as_py(), _U), np.frombuffer(sb.as_py(), _U)))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _open_pairs(key, pdf: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Each stray of one block of a bucket with the members that it is to be verified with: of another component, near
    by signature, in the first band that they share."""
    ids, comp, stray = pdf["id"].to_numpy(), pdf["component"].to_numpy(), pdf["stray"].to_numpy()
    sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)
    keys = np.array(pdf["keys"].tolist(), dtype=np.int64)
    home, strays = np.flatnonzero(pdf["place"] == 0), np.flatnonzero(pdf["place"] == 1)
    for i in strays:
        far = home[(comp[home] != comp[i]) & (~stray[home] | (ids[home] > ids[i]))]
        far = far[(sig[far] == sig[i]).mean(axis=1) >= SIGNATURE_FLOOR]
        if len(far):
            same = keys[far] == keys[i]
            far = far[keys[i][same.argmax(axis=1)] == key[0]]
        if len(far):
            yield i, far


def _near_members(key, pdf):
    """The rows of one block that take part in any pair to be verified."""
    needed = np.zeros(len(pdf), bool)
    for i, far in _open_pairs(key, pdf):
        needed[i] = needed[far] = True
    return pdf[needed]


def _block_links(key, pdf):
    """Links of one block, verified on full sets; what a link has joined here needs no second link."""
    ids, comp = pdf["id"].to_numpy(), pdf["component"].to_numpy().copy()
    sets = [np.frombuffer(x, _U) for x in pdf["s"]]
    a, b = [], []
    for i, far in _open_pairs(key, pdf):
        for j in far:
            if comp[i] != comp[j] and linked(sets[i], sets[j]):
                a.append(min(ids[i], ids[j]))
                b.append(max(ids[i], ids[j]))
                comp[comp == comp[j]] = comp[i]
    return pd.DataFrame({"a": a, "b": b}, dtype="int64")


def _across(members: DataFrame, comp: DataFrame, sigs: DataFrame, sets: DataFrame, tested: DataFrame) -> DataFrame:
    """Links (a, b) between components that share a bucket, of members (bucket, id).

    Strays are a bucket's members outside its most frequent component: every pair that is still open has one."""
    m = members.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    by_comp = m.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = by_comp.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts")).where("parts > 1")
    m = cut(m.join(mixed.select("bucket", "n", F.col("most.component").alias("main"), (F.col("n") - F.col("most.n")).alias("strays")), "bucket"))
    few = m.where(f"n <= {SMALL}").groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("id", "component"))).alias("x"))
    few = few.select(F.explode(F.flatten(F.transform("x", lambda p: F.transform(F.filter("x", lambda q: (q["id"] > p["id"]) & (q["component"] != p["component"])), lambda q: F.struct(p["id"].alias("a"), q["id"].alias("b")))))).alias("p")).select("p.a", "p.b")
    few = verified(few.distinct().join(tested, ["a", "b"], "left_anti"), sets)
    many = m.where(f"n > {SMALL}").withColumn("stray", F.col("component") != F.col("main"))
    many = many.join(sigs, "id")
    homes, parts = F.ceil(F.col("n") / BLOCK), F.ceil(F.col("strays") / BLOCK)
    deal = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    home = many.withColumn("place", F.lit(0)).withColumn("home", F.pmod(F.xxhash64("id"), homes)).withColumn("part", deal(parts))
    strays = many.where("stray").withColumn("place", F.lit(1)).withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), parts)).withColumn("home", deal(homes))
    dealt = home.unionByName(strays).select("bucket", "home", "part", "place", "id", "component", "stray", "sig", "keys")
    near = dealt.groupBy("bucket", "home", "part").applyInPandas(_near_members, dealt.schema)
    return few.unionByName(near.join(sets, "id").groupBy("bucket", "home", "part").applyInPandas(_block_links, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    sigs = cut(signatures(docs, id_col, text_col))
    full = sigs.where("set_key is not null and doc_id is not null")
    followers = cut(_followers(full.select("doc_id", "set_key")))
    few = followers.count() <= BROADCAST_IDS
    reps = full.select("doc_id", "set_key", "keys", "sig").join(F.broadcast(followers) if few else followers, ["doc_id", "set_key"], "left_anti")
    reps = reps.dropDuplicates(["doc_id", "set_key"])
    rows = reps.select(F.col("doc_id").alias("id"), F.explode("keys").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("head")).where("n > 1")
    members = cut(rows.join(shared.select("bucket", "head"), "bucket"))
    stars = cut(members.where("id > head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct())
    sets = cut(_sets(docs, members.select("id").distinct(), id_col, text_col))
    links = cut(verified(stars, sets))
    one = reps.groupBy(F.col("doc_id").alias("id")).agg(F.min(F.struct("set_key", "sig", "keys")).alias("x")).select("id", "x.sig", "x.keys")
    more = _across(members.select("bucket", "id").distinct(), components(links), one, sets, stars)
    links = cut(links.unionByName(more))
    comp = components(links)
    # rows of one doc_id with different texts take the smallest of their components; ids that neither follow nor link are their own
    follow = followers.join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    node = comp.select(F.col("id").alias("doc_id"), "component").unionByName(follow).groupBy("doc_id").agg(F.min("component").alias("component"))
    out = sigs.select("doc_id", "n_shingles").join(node, "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.least(F.coalesce("component", "doc_id"), "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def _followers(full: DataFrame) -> DataFrame:
    """(doc_id, set_key, rep): documents whose set another document has, and which is not the smallest of these, rep.

    Very large classes are met by a broadcast, so no key with more than some documents is shuffled."""
    classes = cut(full.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.count("*").alias("n")).where("last > rep"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    heavy = max(HEAVY, math.ceil(total * HEAVY_SHARE))
    large = classes.where(F.col("n") > heavy).select("set_key", "rep")
    light = classes.where(F.col("n") <= heavy).select("set_key", F.col("rep").alias("light"))
    both = full.join(F.broadcast(large), "set_key", "left")
    met = both.where("rep is not null").unionByName(both.where("rep is null").drop("rep").join(light, "set_key").withColumnRenamed("light", "rep"))
    return met.where("doc_id <> rep").select("doc_id", "set_key", "rep").distinct()


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of every document of ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
