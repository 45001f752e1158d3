"""The registered queries of the operators on one small folder of odd rows: contract columns against plain versions; empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidewire.llm.queries import QUERIES

from .test_operators import brute_components

#: Extra columns of documents, named like outputs and inner columns of the operators.
CLASHES = "score double, kept boolean, component_id long, n_words long, sequence_id long, spans string, _toxicity string, _row string, part long, severity string"


def texts():
    r = random.Random(40)
    words = [f"w{k}" for k in range(300)] + ["Größe", "naïve", "it's", "—", "don't"]
    out = {i: " ".join(r.choices(words, k=r.randrange(5, 160))) for i in range(40)}
    out |= {40: None, 41: "", 42: " \n\t ", 43: "one two", 44: "One TWO", 45: out[3], 46: out[3].upper(), 47: "long text " * 30_000, 48: "spam spam eggs " * 40, 49: "line\nline\nline\n\nother #tag | x"}
    out |= {50: "write to a.b@c.de or call +1 (212) 555-0100, card 4111 1111 1111 1111, host 10.0.0.1 and 999.1.1.1", 51: "you blockhead " + out[5], 52: "日本語 <|endoftext|> é", 53: out[7] + " tail"}
    for i in range(60, 120):
        out[i] = " ".join(r.choices(words, k=60)) + (" blockhead" if i % 3 == 0 else "")
    return out


TEXTS = texts()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    none = [None] * 10
    docs = [(i, t, "en" if i % 2 else None, "s", None, *none) for i, t in TEXTS.items()] + [(45, TEXTS[45], None, "s", None, *none)]  # one row twice
    spark.createDataFrame(docs, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}").repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(i, None if i == 0 else int(i != 48), int(bool(TEXTS[i]) and "blockhead" in TEXTS[i])) for i in TEXTS] + [(None, 1, 1), (9999, 0, 0), (60, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name, cols in {
        "documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string",
        "embeddings": "vec_id long, embedding array<float>, label int", "conversations": "conv_id long, turn long, role string, text string", "benchmark": "item_id long, text string",
    }.items():
        spark.createDataFrame([], cols).write.parquet(f"{d}/{name}.parquet")
    return d


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def run(spark, name, folder):
    out = QUERIES[name](spark, folder).toPandas()
    assert len(out) == len(TEXTS) + 1
    return out.drop_duplicates("doc_id").set_index("doc_id")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, nothing, name):
    assert QUERIES[name](spark, nothing).count() == 0


def test_pipeline_of_empty_tables(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).count() == 0


def test_pipeline_keeps_extra_columns_and_needs_no_label(spark, folder, nothing):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, nothing)
        assert out.columns == docs.columns and out.count() > 0
    kept = {r.doc_id for r in corpus_pipeline.stage_near_duplicates(spark, docs, nothing).collect()}
    assert kept == {i for i, (c, _) in brute_components(TEXTS).items() if c == i} and 45 not in kept and 44 not in kept


def test_different_texts_of_one_id_stay(spark, nothing):
    a, b = "first text with quite some words in it", "second text that says something else entirely"
    docs = spark.createDataFrame([(1, a), (1, b), (1, a), (2, None), (2, None), (None, a)], "doc_id long, text string")
    out = corpus_pipeline.stage_near_duplicates(spark, docs, nothing).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == sorted([(1, a), (1, b), (2, ""), (0, a)])


def test_op1(spark, folder):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = QUERIES["op1_packing"](spark, folder).toPandas()
    want = Counter()
    for i in [*TEXTS, 45]:
        ids = tok.encode(TEXTS[i] or "", add_special_tokens=False).ids + [1]
        want.update((i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(np.array(ids[k : k + 4096], "<u4").tobytes())) for k in range(0, len(ids), 4096))
    assert Counter(zip(out.doc_id, out.piece, out.start, out.length, out.ids_crc32, strict=True)) == want
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.sequence_id.nunique() == -(-out.length.sum() // 4096)


def test_op2(spark, folder):
    out = run(spark, "op2_toxicity", folder)
    assert set(out.columns) >= {"held_out", "score", "predicted"} and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.5)).all()
    assert all(out.held_out[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in TEXTS)
    assert out.score[60] > out.score[61] and out.score[40] == out.score[41] == out.score[61]


def test_op3(spark, folder):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = run(spark, "op3_bpe", folder)
    for i, t in TEXTS.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert out.n_tokens[i] == len(ids) and out.ids_sha256[i] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out.decoded_sha256[i] == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op4(spark, folder):
    out, want = run(spark, "op4_minhash", folder), brute_components(TEXTS)
    assert {i: (out.component_id[i], out.n_shingles[i]) for i in TEXTS} == want and (out.kept == (out.component_id == out.index)).all()


def test_op6(spark, folder):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, s):
        d = [int(c) for c in s if c.isdigit()]
        luhn = sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(reversed(d))) % 10 == 0
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in s.split(".")), "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]

    out = run(spark, "op6_pii", folder)
    for i, t in TEXTS.items():
        found = sorted((m.start(), list(plain).index(k), m.end(), k) for k, p in plain.items() for m in re.finditer(p, t or "") if ok(k, m[0]))
        base = [f"{k}:{s}:{e}" for s, _, e, k in found]
        assert [out[f"n_{k}"][i] for k in plain] == [sum(f[3] == k for f in found) for k in plain]
        assert out.base_sha256[i] == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(out.spans[i].split(",")) | {""}
    assert [out[f"n_{k}"][50] for k in plain] == [1, 1, 1, 1]


def test_op7(spark, folder):
    out = run(spark, "op7_lm", folder)
    lower = {i: re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for i, t in TEXTS.items()}
    seen = Counter(w for i in [*TEXTS, 45] if zlib.crc32(str(i).encode()) % 5 != 1 for w in [*words_of(lower[i]), "\n"])
    for i in TEXTS:
        tokens = [*words_of(lower[i]), "\n"]
        assert out.n_tokens[i] == len(tokens) and out.n_known[i] == sum(w in seen for w in tokens) and out.train_tokens[i] == sum(seen.values())
        assert out.held_out[i] == (zlib.crc32(str(i).encode()) % 5 == 1) and out.score[i] < 0
        assert out.base_score[i] == pytest.approx(sum(np.log10((seen[w] + 0.5) / (sum(seen.values()) + 0.5 * (len(seen) + 1))) for w in tokens))


def test_op8(spark, folder):
    out = run(spark, "op8_quality", folder)
    for i, t in TEXTS.items():
        w, lines = words_of(t), [x for x in (t or "").split("\n") if words_of(x)]
        n = Counter(zip(w, w[1:], w[2:], strict=False))
        repeat = len({k + j for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for j in range(3)})
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeat)
        assert tuple(out.loc[i, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == want
        assert out.base_failed[i] == (len(w) < 50 or 100 * repeat > 50 * len(w)) and not (out.base_failed[i] and out.kept[i])


class Article(HTMLParser):
    """Text of the article element by blocks, without what is marked as no part of it."""

    BLOCKS = frozenset("article h1 h2 h3 h4 h5 h6 p ul ol li blockquote pre table tr td div section figure figcaption".split())
    VOID = frozenset("br img hr input meta link".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.off, self.blocks = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.depth += 1
        if self.depth and tag in self.BLOCKS:
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag == "article":
            self.depth -= 1
        if tag in self.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data


def test_op9_on_pages(spark):
    sf = "/root/testdata/sf0.001"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = {r.page_id: r for r in QUERIES["op9_html"](spark, sf).collect()}
    assert out.keys() == html.keys() and all(r.n_chars == len(r.text) for r in out.values())
    same = 0
    for i, page in html.items():
        plain = Article()
        plain.feed(page)
        plain.close()
        same += out[i].text == "\n".join(b for x in plain.blocks if (b := " ".join(x.split())))
    assert same >= 0.9 * len(html)


def test_op10(spark, tmp_path):
    rng = np.random.default_rng(4)
    c = rng.normal(size=(6, 32))
    rows = [(i, (c[i % 6] + rng.normal(size=32) * 0.2).tolist(), i % 2, "x") for i in range(400)] + [(500, None, 0, "x"), (501, [0.0] * 32, 0, "x"), (502, c[0].tolist(), None, "x"), (7, (c[1] * 2).tolist(), 9, "x")]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = {r.vec_id: r for r in QUERIES["op10_embedding_dedup"](spark, str(tmp_path)).collect()}
    x = np.array([r[1] for r in rows[:400]], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[:400]])
    label[7] = 1  # of its two rows the one with the smaller label counts
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    assert {i: out[i].n_links for i in range(400)} == {i: int(n) - 1 for i, n in enumerate(near.sum(axis=1))}
    assert all(out[k].n_links == 0 and out[k].kept for k in (500, 501, 502)) and len(out) == 403
