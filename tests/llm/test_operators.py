"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and on odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewire.llm import bpe, chat, embedding_dedup, html_extract, html_nodes, minhash, packing, pii, quality, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "palabra larga " * 9000
ODD = [(1, None, "en"), (2, "", "en"), (3, "one two", None), (3, "one two", None), (4, LONG, "es"), (5, "a b c d e f g", "en"), (6, "a b c d e f g", "en"), (7, "日本語 <|endoftext|> x", "ja"), (None, "no id here at all", "en")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, equal texts, and a clashing extra column."""
    return spark.createDataFrame([(i, t, lang, "s", None, "clash") for i, t, lang in ODD], DOCS + ", n_words string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_packing_matches_library_and_is_gapless(odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    out = packing.pack(packing.pieces(odd, path)).toPandas()
    tok = Tokenizer.from_file(path)
    want = Counter()
    for i, t, _ in ODD:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[(-1 if i is None else i, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    got = Counter(zip(out.doc_id.fillna(-1).astype(int), out.piece, out.start, out.length, out.ids_crc32, strict=True))
    assert got == want
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= 4096
    assert packing.pack(packing.pieces(empty, path)).count() == 0


def test_packing_rounds_keep_every_piece(spark):
    rows = [(i, 0, 0, 300 + i % 1700, i) for i in range(3000)]
    df = spark.createDataFrame(rows, packing.PIECES)
    out = packing.pack(df, shard_tokens=500_000).toPandas()
    assert sorted(out.doc_id) == list(range(3000))
    fill = out.groupby("sequence_id").length.sum()
    assert fill.max() <= 4096 and len(fill) <= math.ceil(sum(r[3] for r in rows) / 4096) + 8


def test_local_search_raises_squares_and_keeps_items():
    lengths = [3000, 2500, 1500, 1200, 1000, 900, 800, 700, 400, 300]
    bins = packing.Bins(lengths, 4096)
    for i in range(len(lengths)):
        bins.best_fit(i)
    before = sum(f * f for f in bins.fill)
    bins.improve()
    assert sum(f * f for f in bins.fill) >= before
    assert sorted(i for b in bins.items for i in b) == list(range(len(lengths))) and max(bins.fill) <= 4096


def test_packing_search_reaches_what_exchanges_can(spark):
    # best fit leaves three bins; two suffice, by exchanges only
    assert len(packing.pack_lengths([5, 5, 4, 3, 3], 10)) == 2
    r = random.Random(21)
    for _ in range(300):
        length = [r.randint(1, 40) for _ in range(r.randint(0, 30))]
        got = packing.pack_lengths(length, 40)
        assert sorted(i for b in got for i in b) == list(range(len(length))) and all(sum(length[i] for i in b) <= 40 for b in got)
        assert math.ceil(sum(length) / 40) <= packing.lower_bound(length, 40) <= len(got)
    # no exchange is left that would fill a fuller bin further
    length = [r.randint(8, 27) for _ in range(60)]
    bins = packing.Bins(length, 40)
    for i in range(60):
        bins.best_fit(i)
    bins.improve()
    used = [b for b, x in enumerate(bins.items) if x]
    for b in used:
        for c in used:
            if b != c and bins.fill[c] >= bins.fill[b]:
                for i in bins.items[b]:
                    assert bins.fill[c] + length[i] > 40
                    for j in bins.items[c]:
                        assert not 0 < length[i] - length[j] <= 40 - bins.fill[c]


def test_packing_word_ids_match_library_on_random_texts():
    path, r = public_tokenizers.path("word_bpe_49k.json"), random.Random(31)
    tok, ids = Tokenizer.from_file(path), packing.WordIds(path)
    parts = ["the", "Don't", "it's", "É", "ß", "naïve", "n\u0303", "œuvre", "123", "4.5", "a-b", "--", "…", "“", "”", "«x»", "'", "'s", "<|", "<|endoftext|>", "世界", "\u00a0", "\u200b", "\t", "\n\n", "#*$%", "İ", "ĳ", "ŉ", "é", "x" * 300, "ſ", "K", "!!!", "’ll", "I'LL"]
    texts = ["".join(r.choice(parts) + r.choice(["", " ", " ", "\n"]) for _ in range(r.randrange(40))) for _ in range(3000)]
    for text, got in zip(texts, ids.many(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_bpe_matches_library(odd, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, r = Tokenizer.from_file(path), random.Random(3)
    m = bpe.model(path)
    texts = [t or "" for _, t, _ in ODD] + ["".join(r.choice("abcè '\n1!é世") for _ in range(80)) for _ in range(300)]
    for text, ids in zip(texts, m.encode_many(texts), strict=True):
        want = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert m.decode(ids) == tok.decode(want, skip_special_tokens=False)
    out = bpe.encode_decode(odd, path).toPandas()
    assert len(out) == len(ODD)
    assert out[out.doc_id == 2].ids_sha256.iloc[0] == hashlib.sha256(b"").hexdigest()
    assert bpe.encode_decode(empty, path).count() == 0


def brute_components(texts: dict) -> dict:
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (top(i), len(sets[i])) for i in sets}


def family(r: random.Random, n: int, words: int = 60, edits: int = 2) -> list[str]:
    base = [f"w{r.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(r.randrange(edits + 1)):
            t[r.randrange(words)] = f"x{r.randrange(9999)}"
        out.append(" ".join(t))
    return out


def test_minhash_matches_brute_force(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 3)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    r = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [t for n in (60, 9, 2, 2, 5) for t in family(r, n)] + [passage + " " + " ".join(f"q{r.randrange(9999)}" for _ in range(25)) for _ in range(40)]
    rows = {i + 10: t for i, t in enumerate(texts)} | {1: None, 2: "", 3: "a b", 4: "A b", 5: "same text", 6: "same text"}
    df = spark.createDataFrame([(i, t) for i, t in rows.items()], "doc_id long, text string")
    got = {x.doc_id: (x.component_id, x.n_shingles) for x in minhash.near_duplicates(df).collect()}
    assert got == brute_components(rows)
    out = minhash.near_duplicates(odd).toPandas()
    assert len(out) == len(ODD) and out[out.doc_id == 6].component_id.iloc[0] == 5 and out.kept.sum() == len(ODD) - 1
    assert minhash.near_duplicates(empty).count() == 0


def test_pii_matches_plain_patterns(odd, empty):
    r = random.Random(2)
    texts = ["".join(r.choice("12.34@ab+- ()5..") for _ in range(90)) for _ in range(3000)]
    texts += ["mail a.b@c.de, 192.168.1.1 300.1.1.1 card 4111 1111 1111 1111 tel +1 (212) 555-0100", "a" * 200000 + "@", "1" * 100000, "@" * 5000]
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, s):
        d = [int(c) for c in s if c.isdigit()]
        if kind == "ip":
            return all(int(x) <= 255 for x in s.split("."))
        if kind == "card":
            return 12 <= len(d) <= 19 and sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(reversed(d))) % 10 == 0
        return kind != "phone" or 9 <= len(d) <= 15

    for t in texts:
        if len(t) > 10000:
            pii.spans(t)
            continue
        want = sorted((m.start(), k, m.end()) for k, name in enumerate(plain) for m in re.finditer(plain[name], t) if ok(name, m[0]))
        assert pii.base_spans(t) == [(s, e, list(plain)[k]) for s, k, e in want]
    assert [s[2] for s in pii.spans("our IBAN DE89 3704 0044 0532 0130 00 at the bank")] == ["iban"]
    assert not [s for s in pii.spans("IBAN DE88 3704 0044 0532 0130 00") if s[2] == "iban"]
    assert pii.redact("x a@b.de y", pii.spans("x a@b.de y")) == "x [EMAIL] y"
    assert pii.find_pii(odd).count() == len(ODD) and pii.find_pii(empty).count() == 0
    out = pii.redact_text(odd)
    assert out.columns == odd.columns and out.where("text is null").count() == 1


def test_quality_measures_bounds_and_odd_inputs(spark, odd, empty):
    r = random.Random(4)
    for _ in range(200):
        w = [r.choice("abc") for _ in range(r.randrange(12))]
        n = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        want = {k + j for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for j in range(3)}
        assert quality.repeated_words(w) == len(want)
    assert quality.measure("a b\n\na b\na b |#")[:5] == (7, 8, 2, 1, 6)
    # the exact bound: P(X <= k) = delta at the bound
    for k, n in ((0, 50), (3, 200), (20, 1000)):
        p = quality.upper_bound(k, n, 0.01)
        assert abs(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) - 0.01) < 1e-6
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, None)], "doc_id long, quality int")
    measured = quality.with_measures(odd, ["doc_id", "lang"])
    out = quality.judged(measured, quality.cutoffs(measured, labels)).toPandas()
    assert len(out) == len(ODD) and not out.kept.any() and out.base_failed.sum() == len(ODD)
    none = quality.with_measures(empty, ["doc_id", "lang"])
    assert quality.judged(none, quality.cutoffs(none, labels.limit(0))).count() == 0


def test_quality_cutoffs_hold_their_risk(spark):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(6000):
        bad = i % 4 == 0
        words = [f"w{r.randrange(400)}" + ("#%&" if bad else "") for _ in range(70)]
        rows.append((i, " ".join(words) + ".", "en"))
        labels.append((i, 0 if bad and r.random() < 0.999 else 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    measured = quality.with_measures(df, ["doc_id", "lang"])
    out = quality.judged(measured, quality.cutoffs(measured, spark.createDataFrame(labels, "doc_id long, quality int"))).toPandas().merge(__import__("pandas").DataFrame(labels, columns=["doc_id", "q"]))
    assert (~out[out.q == 1].kept).mean() <= 0.02 and (~out[out.q == 0].kept).mean() > 0.9


def test_toxicity_learns_terms_and_catches_misspellings(spark, odd, empty):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(1500):
        words = ["".join(r.choice("aeioutnrs") for _ in range(r.randint(3, 9))) for _ in range(40)]
        bad = i % 5 == 0
        if bad:
            words[r.randrange(40)] = r.choice(["blockhead", "dimwitted", "zappo" + r.choice(["ni", "lu", "ter"])])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, lab)
    assert {"blockhead", "dimwitted"} <= {t for t, _ in model[0]}
    scored = {x.doc_id: x.score for x in toxicity.with_score(docs, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(scored[i] >= 0.5) == bool(dict(labels)[i]) for i in held]) > 0.95
    near = spark.createDataFrame([(1, "you are a blokhead and a dimwited one"), (2, "nothing at all here")], "doc_id long, text string")
    s = {x.doc_id: x.score for x in toxicity.with_score(near, model).collect()}
    assert s[1] > s[2]
    out = toxicity.with_score(odd, model).toPandas()
    assert len(out) == len(ODD) and out.score.between(0, 1).all()
    assert toxicity.train(empty.select("doc_id", "text"), lab.limit(0))[0] == [] and toxicity.with_score(empty, model).count() == 0


def test_automaton_is_edit_distance_with_swaps():
    terms = [("worthless", False), ("idiot", False), ("lowei", True)]
    a = toxicity.Automaton(terms)

    def distance(x, y):
        d = {(i, j): i + j for i in range(len(x) + 1) for j in range(len(y) + 1) if not i or not j}
        for i in range(1, len(x) + 1):
            for j in range(1, len(y) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x[i - 1] != y[j - 1]))
                if i > 1 and j > 1 and x[i - 1] == y[j - 2] and x[i - 2] == y[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(x), len(y)]

    r = random.Random(1)
    for _ in range(4000):
        t = list(r.choice(["worthless", "idiot"]))
        for _ in range(r.randrange(4)):
            k = r.randrange(1, len(t))
            if r.random() < 0.3 and k + 1 < len(t):
                t[k], t[k + 1] = t[k + 1], t[k]
            else:
                t[k : k + r.randrange(2)] = r.choice(["", "x", "e", "0", "*"])
            if len(t) < 3:
                break
        w = "".join(t)
        near = any(distance(w, s) <= toxicity.edits(len(s), False) for s, _ in terms[:2])
        assert bool(a(w)) == near, w
    assert a("loweitum") == a.EXACT and a("lowxitum") == a.STEM and a("low") == a.NONE
    # the first letter: changed where the rest agrees, or swapped with the second; never left out
    assert a("1diot") == a("ldiot") == a("diiot") == a.WORD and a("1diod") == a("diot") == a.NONE
    assert toxicity.Automaton(terms, ["idiom"])("idiom") == a.NONE and a("idiom") == a.WORD
    assert toxicity._WORD.findall("st*pid l0ser, 1diot a$$ *bold* x_y") == ["st*pid", "l0ser", "1diot", "a", "bold", "x", "y"]


def test_toxicity_keeps_all_strong_terms(spark):
    r = random.Random(16)
    insults = ["zz" + "".join(r.choice("bcdfgklmn") + r.choice("aeiou") for _ in range(4)) for _ in range(60)]
    rows, labels = [], []
    for i in range(2400):
        words = ["".join(r.choice("aeioutnrs") for _ in range(r.randint(4, 9))) for _ in range(30)]
        if i % 4 == 0:
            words[3] = insults[i // 4 % 60]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    terms = {t for t, _ in toxicity.train(docs, lab, None)[0]}
    found = sum(any(w.startswith(t) for t in terms) for w in insults)
    assert found == 60


def test_toxicity_bounded_sample_keeps_the_labels_rate(spark, monkeypatch):
    r = random.Random(17)
    rows, labels = [], []
    for i in range(2400):
        words = ["".join(r.choice("aeioutnrs") for _ in range(r.randint(4, 9))) for _ in range(30)]
        if i % 8 == 0:
            words[3] = r.choice(["blockhead", "dimwitted"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))  # half of the toxic ones show nothing: the base score is their rate
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    whole = toxicity.train(docs, lab, None)
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 400)
    part = toxicity.train(docs, lab, None)
    assert {"blockhead", "dimwitted"} <= {t for t, _ in part[0]} and abs(part[2][-1] - whole[2][-1]) < 0.3 and abs(whole[2][-1] - math.log(300 / 1800)) < 0.3


def test_quotation_is_told_from_abuse():
    assert toxicity.in_quotation('he wrote: "idiot" there', 11, 16)
    assert not toxicity.in_quotation("you idiot", 4, 9)
    # the whole line counts, however long, and only the line
    long = '"' + "word " * 2000
    assert toxicity.in_quotation(long + 'idiot"', len(long), len(long) + 5)
    assert not toxicity.in_quotation('"a" ' + long[1:] + 'idiot "b', len(long) + 3, len(long) + 8)
    assert not toxicity.in_quotation('a "b\nidiot" c', 5, 10) and toxicity.in_quotation("x «idiot» y", 3, 8)


def test_html_held_out_pages_and_odd_ones(spark):
    m, r = html_extract.trained(), random.Random(77)
    right = 0
    for _ in range(150):
        nodes, truth = html_extract._labelled(html_extract.generated_page(r))
        got = html_extract.decode(nodes, m.trees.logit(html_nodes.features(nodes, m.token_score)))
        right += html_nodes.block_texts(nodes, got) == html_nodes.block_texts(nodes, truth)
    assert right / 150 > 0.85
    page = '<html><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy this now, please.</div><article><h1>A &amp; B</h1><p>One   two.<br>Three, four and five.<p>Six seven, eight.</article><footer>&copy; us</footer>'
    assert html_extract.main_text(page, m) == "A & B\nOne two. Three, four and five.\nSix seven, eight."
    df = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page), (4, "u", "<p" * 50), (5, "u", "<div>" * 3000)], "page_id long, url string, html string")
    out = html_extract.extract(df).toPandas()
    assert len(out) == 6 and (out.n_chars == out.text.map(len)).all() and out.text[0] == "" and out.text[2] == out.text[3] != ""


def test_decoding_never_contradicts():
    r, rng = random.Random(5), np.random.default_rng(5)
    for _ in range(30):
        nodes = html_nodes.parse(html_extract.generated_page(r))
        kept = html_extract.decode(nodes, rng.normal(0, 4, len(nodes)))
        state = {id(n): k for n, k in zip(nodes, kept, strict=True)}
        for n in nodes:
            chain = []
            while n is not None:
                chain.append(state[id(n)])
                n = n.parent
            # from a node up to the root: once out above a kept stretch, never kept again
            runs = [k for k, prev in zip(chain[1:], chain[:-1], strict=True) if k != prev]
            assert sum(runs) <= 1


def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "WINDOW", 8)
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for n in (70, 3, 2, 2, 1, 1, 1, 9):
        c = rng.normal(size=16)
        for _ in range(n):
            rows.append((i, (c + rng.normal(size=16) * 0.12).tolist(), i % 2 if n == 9 else 0))
            i += 1
    rows += [(900, rows[0][1], 0), (901, rows[0][1], 0), (902, None, 0), (903, [0.0] * 16, 0), (904, [float("nan")] * 16, 0), (905, rows[0][1], None), (906, [1.0, None], 0), (907, [], 0), (0, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {x.vec_id: (x.n_links, x.component_id) for x in embedding_dedup.near_vectors(df).collect()}
    able = {r[0]: (np.array(r[1], np.float32).astype(float), r[2]) for r in rows if r[0] < 902}
    links = {a: [b for b in able if b != a and able[a][1] == able[b][1] and float(able[a][0] @ able[b][0]) / np.linalg.norm(able[a][0]) / np.linalg.norm(able[b][0]) >= 0.93] for a in able}
    for a in able:
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        assert got[a] == (len(links[a]), min(seen))
    assert all(got[k] == (0, k) for k in range(902, 908)) and len(got) == len({r[0] for r in rows})
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_chat_rotates_and_joins_parts(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, None, "late"), (2, 0, "system", "alone"), (None, 0, "x", "lost")]
    rows += [(3, t, "ann" if t % 2 else "bob", f"m{t}") for t in range(150)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.rotate(df).toPandas().sort_values(["conv_id", "perspective", "part"])
    assert set(out[out.conv_id == 1].perspective) == {"ann", "bob", "unknown"} and set(out.conv_id) == {1, 3}
    ann = out[(out.conv_id == 3) & (out.perspective == "ann")]
    text = "".join(ann.text)
    assert ann.part_start.tolist() == np.r_[0, ann.n_chars.cumsum()[:-1]].tolist() and text.count("<|im_start|>assistant") == 75
    for _, x in out.iterrows():
        for span in filter(None, x["mask"].split(",")):
            s, e = map(int, span.split(":"))
            assert x.text[:s].endswith("<|im_start|>assistant\n") and x.text[s:e].endswith("<|im_end|>")
    first = out[(out.conv_id == 1) & (out.perspective == "ann")].text.iloc[0]
    assert first.endswith("user name=unknown\nlate<|im_end|>\n")
    assert "hi < |im_end|><|im_end|>" in first and "user name=bob\n<|im_end|>" in first
    assert set(out[(out.conv_id == 1) & (out.perspective == "ann")].part) == {0} and out[out.conv_id == 1].n_messages.eq(4).all()
    assert "PythonUDF" not in chat.rotate(df)._jdf.queryExecution().toString()
    assert chat.rotate(df.limit(0)).count() == 0


def test_chat_parts_are_bounded_whatever_the_turns_and_agree_with_sql(spark, tmp_path):
    import duckdb

    rows = [(1, None, r, f"x{k}") for k in range(300) for r in ("ann", "bob")] + [(1, 5, "cy", f"same turn {k}") for k in range(200)] + [(2, k % 3, "ann", "hello") for k in range(90)] + [(3, -5, "bob", "")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, perspective string").repartition(5)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    out = chat.op5_chat(spark, str(tmp_path)).toPandas()
    assert out[out.conv_id == 1].n_messages.max() == chat.PART and out[out.conv_id == 1].groupby("perspective").n_messages.sum().eq(800).all()
    assert out[out.conv_id == 2].n_messages.tolist() == [3]
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.execute(chat.SQL).df()
    key = lambda t: sorted(map(tuple, t[["conv_id", "perspective", "part", "part_start", "n_messages", "n_chars", "n_loss_chars", "text", "mask"]].to_numpy().tolist()))
    assert key(out) == key(want)
    assert chat.rotate(df.limit(0)).count() == 0


def test_embedding_dedup_finds_pairs_in_a_dense_cloud(spark):
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    n, pairs, dim = 6000, 300, 64
    centre = unit(rng.standard_normal(dim))
    cloud = unit(math.sqrt(0.85) * centre + math.sqrt(0.15) * unit(rng.standard_normal((n, dim))))
    away = rng.standard_normal((pairs, dim))
    away = unit(away - (away * cloud[:pairs]).sum(axis=1, keepdims=True) * cloud[:pairs])
    cloud = np.vstack([cloud, 0.935 * cloud[:pairs] + math.sqrt(1 - 0.935**2) * away])
    near = cloud @ cloud.T >= embedding_dedup.COSINE
    rows = [(i, x.tolist(), "l") for i, x in enumerate(cloud)]
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert got == {i: int(k) - 1 for i, k in enumerate(near.sum(axis=1))}
