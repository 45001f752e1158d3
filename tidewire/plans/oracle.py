"""DuckDB SQL of the registered queries, written apart from their Spark form."""

from __future__ import annotations

ARTICLES = """articles AS (
  SELECT printf('a%09d', doc_id) AS article_id, doc_id, source AS publisher_id, string_split(text, chr(10))[1] AS title, text AS content, lang AS category,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS published_at, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%d') AS published_date
  FROM documents)"""

FOLDED = (
    ARTICLES
    + """, hashed AS (SELECT article_id, published_at, sha256(content) AS h FROM articles),
folded AS (
  SELECT article_id, first_value(article_id) OVER (PARTITION BY h ORDER BY published_at, article_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS rep, count(*) OVER (PARTITION BY h) AS n
  FROM hashed),
dup AS (
  SELECT article_id, CASE WHEN rep <> article_id THEN rep END AS duplicate_of, CAST(CASE WHEN rep = article_id THEN n ELSE 0 END AS INTEGER) AS duplicate_count, CASE WHEN rep <> article_id THEN 'sha256' END AS method
  FROM folded)"""
)

# texts long enough, one of exact copies, with their distinct 4-grams
GRAMS = (
    ARTICLES
    + """, able AS (SELECT article_id, content AS text, published_at, sha256(content) AS h FROM articles WHERE length(content) >= 100),
kept AS (SELECT * FROM able QUALIFY row_number() OVER (PARTITION BY h ORDER BY published_at, article_id) = 1),
sets AS (SELECT article_id, text, length(text) AS len, list_distinct([substr(text, i, 4) FOR i IN range(1, length(text) - 2)]) AS g FROM kept)"""
)
JACCARD = (
    GRAMS
    + """, flat AS (SELECT article_id, len(g) AS n, unnest(g) AS x FROM sets),
near AS (
  SELECT a.article_id AS a, b.article_id AS b, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM flat a JOIN flat b ON a.x = b.x AND a.article_id < b.article_id AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n) - 1e-9 GROUP BY 1, 2),
pairs AS (SELECT a, b, shared / (na + nb - shared) AS jaccard FROM near WHERE shared / (na + nb - shared) >= 0.7)"""
)
COSINE = (
    JACCARD
    + """, words AS (
  SELECT article_id, ' ' || w || ' ' AS w FROM (SELECT article_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS w FROM kept WHERE article_id IN (SELECT a FROM pairs UNION SELECT b FROM pairs)) WHERE w <> ''),
grams AS (
  SELECT article_id, unnest(CASE WHEN length(w) <= 3 THEN [w] ELSE [substr(w, i, 3) FOR i IN range(1, length(w) - 1)] || [substr(w, i, 4) FOR i IN range(1, length(w) - 2)] END) AS g FROM words),
tf AS (SELECT article_id, g, count(*) AS tf FROM grams GROUP BY ALL),
idf AS (SELECT g, ln((1.0 + (SELECT count(DISTINCT article_id) FROM tf)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY g),
w0 AS (SELECT article_id, g, tf * idf AS w FROM tf JOIN idf USING (g)),
w1 AS (SELECT article_id, g, w / sqrt(sum(w * w) OVER (PARTITION BY article_id)) AS w FROM w0),
cosine AS (
  SELECT p.a, p.b, coalesce(sum(x.w * y.w), 0) AS cosine FROM pairs p JOIN w1 x ON x.article_id = p.a JOIN w1 y ON y.article_id = p.b AND y.g = x.g GROUP BY p.a, p.b)"""
)
REACH = """, RECURSIVE_EDGES AS (SELECT a AS u, b AS v FROM pairs UNION SELECT b, a FROM pairs), reach AS (
  SELECT u, v FROM RECURSIVE_EDGES UNION SELECT r.u, e.v FROM reach r JOIN RECURSIVE_EDGES e ON r.v = e.u),
comp AS (SELECT u AS id, least(u, min(v)) AS component FROM reach GROUP BY u)"""

TRACKING = "('utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'fbclid', 'gclid', 'igshid', 'page', 'date', 'ref', 'from')"
URLS = f"""parts AS (SELECT page_id, regexp_replace(trim(url), '#.*$', '') AS u FROM pages),
split AS (SELECT page_id, string_split(u, '?')[1] AS head, CASE WHEN instr(u, '?') > 0 THEN substr(u, instr(u, '?') + 1) ELSE '' END AS q FROM parts),
params AS (SELECT page_id, unnest(string_split(q, '&')) AS p FROM split),
kv AS (
  SELECT page_id, url_decode(replace(string_split(p, '=')[1], '+', ' ')) AS k, url_decode(replace(CASE WHEN instr(p, '=') > 0 THEN substr(p, instr(p, '=') + 1) ELSE '' END, '+', ' ')) AS v FROM params WHERE p <> ''),
query AS (
  SELECT page_id, string_agg(replace(url_encode(k), '%20', '+') || '=' || replace(url_encode(v), '%20', '+'), '&' ORDER BY k, v) AS q FROM kv WHERE k NOT IN {TRACKING} GROUP BY page_id),
urls AS (
  SELECT s.page_id, p.url AS raw, regexp_replace(s.head, '^[A-Za-z][A-Za-z0-9+.-]*:', lower(regexp_extract(s.head, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1))) || coalesce('?' || q.q, '') AS url
  FROM split s JOIN pages p USING (page_id) LEFT JOIN query q USING (page_id))"""

ISSUE = """issue AS (
  SELECT vec_id AS article_id, 'p' || (vec_id % CASE WHEN label < 3 THEN 2 ELSE 9 END) AS publisher_id, strftime(DATE '2024-01-01' + CAST(vec_id % 3 AS INTEGER), '%Y-%m-%d') AS published_date,
    CAST(CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END AS INTEGER) AS issue_local, CAST(embedding AS DOUBLE[]) AS vector
  FROM embeddings)"""


def centroids(source: str, where: str) -> str:
    return f"""flat_{source} AS (SELECT issue_local, unnest(vector) AS x, generate_subscripts(vector, 1) AS d FROM {source} WHERE {where}),
mean_{source} AS (SELECT issue_local, d, avg(x) AS m FROM flat_{source} GROUP BY ALL),
cent_{source} AS (SELECT issue_local, list(m ORDER BY d) AS mean FROM mean_{source} GROUP BY issue_local),
c_{source} AS (SELECT issue_local, [x / sqrt(list_inner_product(mean, mean)) FOR x IN mean] AS centroid FROM cent_{source} WHERE list_inner_product(mean, mean) > 0)"""


MEMBERS = (
    ISSUE
    + """, members AS (
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(article_id * 37 % 1000) AS published_at, ['정치', '산업', 'IT과학', '', '문화'][CAST(article_id * 7 % 5 + 1 AS INTEGER)] AS category FROM issue),
named AS (SELECT *, CASE WHEN coalesce(category, '') = '' THEN 'OTHER' WHEN category = '산업' THEN '경제' WHEN category = 'IT과학' THEN 'IT/과학' ELSE category END AS c FROM members WHERE issue_local >= 0)"""
)
REPRESENTATIVE = (
    MEMBERS
    + ", "
    + centroids("members", "issue_local >= 0")
    + """, sims AS (SELECT m.issue_local, m.article_id, m.published_at, list_inner_product(m.vector, c.centroid) AS sim FROM members m JOIN c_members c USING (issue_local)),
rep AS (
  SELECT issue_local, article_id AS representative FROM (SELECT *, max(sim) OVER (PARTITION BY issue_local) AS best FROM sims) WHERE best - sim < 1e-6
  QUALIFY row_number() OVER (PARTITION BY issue_local ORDER BY published_at, article_id) = 1)"""
)


def category(fallback: str) -> str:
    """cats(issue_local, category) from named and a relation fb(issue_local, fallback)."""
    return f"""fb AS ({fallback}),
tally AS (SELECT issue_local, c, count(*) AS n, min((published_date, article_id)) AS first FROM named WHERE c <> 'OTHER' GROUP BY ALL),
tied AS (SELECT * FROM tally QUALIFY n = max(n) OVER (PARTITION BY issue_local)),
cats AS (
  SELECT i.issue_local, CASE WHEN t.cs IS NULL THEN coalesce(f.f, 'OTHER') WHEN list_contains(t.cs, f.f) THEN f.f ELSE t.c0 END AS category
  FROM (SELECT DISTINCT issue_local FROM named) i
  LEFT JOIN (SELECT issue_local, list(c) AS cs, arg_min(c, first) AS c0 FROM tied GROUP BY issue_local) t USING (issue_local)
  LEFT JOIN (SELECT issue_local, CASE WHEN coalesce(fallback, '') = '' THEN 'OTHER' WHEN fallback = '산업' THEN '경제' WHEN fallback = 'IT과학' THEN 'IT/과학' ELSE fallback END AS f FROM fb) f USING (issue_local))"""


FEED = (
    REPRESENTATIVE
    + ", "
    + category("SELECT r.issue_local, m.category AS fallback FROM rep r JOIN members m ON m.article_id = r.representative")
    + """, feed AS (
  SELECT m.issue_local, count(*) AS issue_size, count(DISTINCT publisher_id) AS publishers, any_value(r.representative) AS representative, any_value(k.category) AS category,
    round((log2(1 + count(*)) + 2.0 * log2(1 + count(DISTINCT publisher_id))) * exp(-greatest(epoch_us((SELECT max(published_at) FROM members)) - epoch_us(max(published_at)), 0) / 3.6e9 / 24.0), 4) AS hot_score, CAST(-1 AS BIGINT) AS issue_id
  FROM members m JOIN rep r USING (issue_local) JOIN cats k USING (issue_local) WHERE m.issue_local >= 0 GROUP BY m.issue_local)"""
)

WINDOWS = (
    ISSUE
    + """, prev AS (SELECT article_id, CAST(issue_local + CASE WHEN article_id % 11 = 0 THEN 1 ELSE 0 END + 100 AS BIGINT) AS issue_id FROM issue WHERE issue_local >= 0 AND article_id % 3 <> 0),
now AS (SELECT article_id, published_date, CAST(CASE WHEN issue_local < 0 THEN -1 ELSE issue_local * 2 + CASE WHEN article_id % 4 = 0 THEN 1 ELSE 0 END END AS INTEGER) AS issue_local FROM issue),
votes AS (SELECT n.issue_local, p.issue_id AS prev_id, count(*) AS shared, min((n.published_date, n.article_id)) AS first FROM now n JOIN prev p USING (article_id) WHERE n.issue_local >= 0 GROUP BY ALL),
won AS (
  SELECT issue_local, prev_id, shared FROM (SELECT *, sum(shared) OVER (PARTITION BY issue_local) AS overlap, row_number() OVER (PARTITION BY issue_local ORDER BY shared DESC, first) AS r FROM votes)
  WHERE r = 1 AND shared >= 2 AND shared / overlap >= 0.5),
claims AS (SELECT issue_local, prev_id FROM won QUALIFY row_number() OVER (PARTITION BY prev_id ORDER BY shared DESC, issue_local DESC) = 1)"""
)

ENDS = "[.!?。！？]"
SENTENCES = (
    ARTICLES
    + f""", marked AS (
  SELECT article_id, publisher_id, category, regexp_replace(regexp_replace(trim(content, ' ' || chr(9) || chr(10) || chr(13)), '({ENDS})\\s+', '\\1' || chr(1), 'g'), '({ENDS})([가-힣])', '\\1' || chr(1) || '\\2', 'g') AS t FROM articles),
pieces AS (SELECT article_id, publisher_id, category, [trim(x, ' ' || chr(9) || chr(10) || chr(13)) FOR x IN regexp_split_to_array(t, '[\\n\\x01]+')] AS xs FROM marked),
listed AS (SELECT article_id, publisher_id, category, [x FOR x IN xs IF x <> ''] AS xs FROM pieces),
sentences AS (SELECT article_id, publisher_id, category, unnest(xs) AS sentence, generate_subscripts(xs, 1) - 1 AS pos FROM listed)"""
)
REPORTING = " OR ".join(f"contains(sentence, '{m}')" for m in ("라고 밝혔다", "고 밝혔다", "라고 말했다", "고 말했다", "라고 전했다", "고 전했다", "라고 설명했다", "고 설명했다", "라고 주장했다", "고 주장했다", "라고 강조했다", "고 강조했다"))
OPINION = " OR ".join(f"contains(sentence, '{m}')" for m in ("것으로 보인다", "필요하다", "해야 한다", "바람직하다", "문제다", "우려된다", "아쉽다"))
EVIDENCE = (
    SENTENCES
    + """, evidence AS (
  SELECT category, sentence, count(DISTINCT publisher_id) AS publishers, count(DISTINCT article_id) AS articles, min((article_id, pos)) AS first FROM sentences GROUP BY ALL)"""
)

RECORDS = """recs AS (SELECT doc_id, doc_id % 10 AS k, text, lang, source FROM documents),
checked AS (
  SELECT *, nullif(concat_ws('; ',
    CASE WHEN k = 3 THEN 'source_type: must be one of DATASET, RSS, HTML' END, CASE WHEN k = 1 THEN 'title: must not be empty' END,
    CASE WHEN trim(text) = '' THEN 'content: must not be empty' END, CASE WHEN k = 6 THEN 'category: field required' END,
    CASE WHEN k = 2 THEN 'published_at: must have a timezone' END), '') AS error FROM recs)"""

ROUND6 = "round({}, 6)"


def prf(source: str) -> str:
    return f"""counts AS (
  SELECT count(*) FILTER (p = 1 AND a = 1) AS tp, count(*) FILTER (p = 1 AND a <> 1) AS fp, count(*) FILTER (p <> 1 AND a = 1) AS fn, count(*) FILTER (p <> 1 AND a <> 1) AS tn FROM ({source}))
SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM counts"""


def ari(source: str) -> str:
    """Of a relation with columns a and b."""
    return f"""ab AS ({source}),
cell AS (SELECT a, b, count(*) AS n FROM ab GROUP BY ALL),
t AS (
  SELECT (SELECT sum(n) FROM cell) AS n, (SELECT sum(n * (n - 1) / 2) FROM cell) AS both_,
    (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM cell GROUP BY a)) AS ra, (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM cell GROUP BY b)) AS rb),
u AS (SELECT n, both_, (ra + rb) / 2 AS most, ra * rb / (n * (n - 1) / 2) AS expected FROM t)
SELECT CAST(n AS BIGINT) AS n, round(CASE WHEN most = expected THEN 1.0 ELSE (both_ - expected) / (most - expected) END, 6) AS ari FROM u"""


EXPORT = (
    MEMBERS
    + """, rows_ AS (
  SELECT article_id, issue_local + 100 AS issue_id, 'https://x/' || article_id AS url, category, published_at FROM members
  WHERE issue_local >= 0 AND issue_local <> 1 AND article_id % 6 <> 5 AND article_id % 10 <> 3)"""
)
STANCE = (
    ARTICLES
    + """, rows_ AS (
  SELECT a.article_id, a.category, a.content, CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 THEN 'positive' ELSE 'neutral' END AS stance FROM articles a JOIN labels l USING (doc_id) WHERE trim(a.content) <> ''),
plain AS (SELECT * EXCLUDE content, regexp_replace(regexp_replace(content, '(?i)(?:https?://|www\\.)\\S+', ' ', 'g'), '(?i)\\b(?:[A-Za-z0-9-]+\\.)+[A-Za-z]{2,}\\b', ' ', 'g') AS t FROM rows_),
words AS (
  SELECT article_id, category, stance, [w FOR w IN regexp_extract_all(t, '[가-힣A-Za-z0-9]+') IF length(w) >= 2 AND NOT regexp_full_match(w, '\\d+')] AS ws FROM plain)"""
)


def contrastive(terms: str) -> str:
    return (
        STANCE
        + f""", docs AS (SELECT article_id, category, stance, list_distinct({terms}) AS ts FROM words),
flat AS (SELECT article_id, category, stance, unnest(ts) AS term FROM docs),
nd AS (SELECT category, count(*) AS nd FROM docs GROUP BY 1),
df AS (SELECT category, term, ln((1.0 + any_value(nd)) / (1 + count(*))) + 1 AS w FROM flat JOIN nd USING (category) GROUP BY ALL),
unit AS (SELECT f.*, df.w / sqrt(sum(df.w * df.w) OVER (PARTITION BY f.category, f.article_id)) AS u FROM flat f JOIN df USING (category, term)),
ns AS (SELECT category, stance, count(*) AS ns FROM docs GROUP BY ALL),
prof AS (SELECT category, stance, term, sum(u) / any_value(ns) * pow(count(*) / any_value(ns), 2) AS own FROM unit JOIN ns USING (category, stance) GROUP BY ALL),
scored AS (
  SELECT p.category, p.stance, p.term, p.own, p.own - coalesce(max(o.own), 0) AS score FROM prof p LEFT JOIN prof o ON o.category = p.category AND o.term = p.term AND o.stance <> p.stance GROUP BY p.category, p.stance, p.term, p.own),
ranked AS (SELECT category, stance, term, row_number() OVER (PARTITION BY category, stance ORDER BY round(score, 12) DESC, round(own, 12) DESC, term) AS rank FROM scored WHERE score > 0)
SELECT category, stance, term, rank FROM ranked WHERE rank <= 5"""
    )


STRIPPED = "regexp_replace(regexp_replace({}, '^[\\s　​ ]+', ''), '[\\s　 ]+$', '')"
SQUEEZED = "trim(regexp_replace(array_to_string([trim(regexp_replace(x, ' {2,}', ' ', 'g'), ' ' || chr(13)) FOR x IN string_split(translate(content, chr(9) || chr(160) || chr(12288) || chr(8203), '    '), chr(10))], chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(13))"
BUCKET = "CASE WHEN length(content) < 100 THEN '<100' WHEN length(content) < 300 THEN '<300' WHEN length(content) < 500 THEN '<500' WHEN length(content) < 1000 THEN '<1000' WHEN length(content) < 2000 THEN '<2000' WHEN length(content) < 5000 THEN '<5000' ELSE '>=5000' END"
HALVES = """old AS (SELECT doc_id, source AS version, '2024-01-01' AS published_date FROM documents WHERE doc_id % 3 <> 0), new AS (SELECT doc_id, 'new' AS version, '2024-01-02' AS published_date FROM documents WHERE doc_id % 2 = 0)"""
LABELERS = """e AS (SELECT vec_id AS article_id, label, unnest([1, 2, 3]) AS labeler FROM embeddings),
lab AS (SELECT article_id, labeler, CASE WHEN (article_id * labeler) % 13 = 0 THEN article_id + 1000 ELSE label * 1000000 + article_id // 40 END AS cluster FROM e)"""
PAIR_SIMS = """sims AS (
  SELECT a.vec_id AS a, b.vec_id AS b, list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS sim FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id)"""
RESCUE = (
    ISSUE
    + """, flags AS (SELECT issue_local FROM issue WHERE issue_local >= 0 GROUP BY issue_local HAVING count(DISTINCT publisher_id) <= 3 AND count(*) >= 10),
open_ AS (SELECT * FROM issue WHERE {where} AND issue_local >= 0 AND issue_local NOT IN (SELECT issue_local FROM flags)), """
    + centroids("open_", "true")
    + """, best AS (
  SELECT i.article_id, c.issue_local AS to_, list_inner_product(i.vector, c.centroid) AS sim FROM issue i CROSS JOIN c_open_ c WHERE {lost}
  QUALIFY row_number() OVER (PARTITION BY i.article_id ORDER BY list_inner_product(i.vector, c.centroid) DESC, c.issue_local) = 1)"""
)

SQL: dict[str, str] = {
    "dup_exact_fold": f"WITH {FOLDED} SELECT article_id, duplicate_of, duplicate_count, method FROM dup",
    "dup_exact_stats": f"WITH {FOLDED} SELECT count(*) AS articles, count(*) FILTER (duplicate_of IS NULL) AS kept, count(duplicate_of) AS folded, count(*) FILTER (method = 'sha256') AS by_sha256 FROM dup",
    "dup_counts": f"WITH {FOLDED} SELECT duplicate_count, count(*) AS n FROM dup GROUP BY 1",
    "dup_eligible": f"WITH {ARTICLES} SELECT article_id, length(content) AS len FROM articles WHERE length(content) >= 100",
    "dup_shingle_count": f"WITH {ARTICLES} SELECT article_id, CAST(len(list_distinct([substr(content, i, 4) FOR i IN range(1, length(content) - 2)])) AS INTEGER) AS n FROM articles",
    "dup_jaccard_pairs": f"WITH {JACCARD} SELECT a, b, round(jaccard, 6) AS jaccard FROM pairs",
    "dup_containment_pairs": f"""WITH {GRAMS}, flat AS (SELECT article_id, len, len(g) AS n, unnest(g) AS x FROM sets),
near AS (
  SELECT a.article_id AS s, b.article_id AS l, count(*) / any_value(a.n) AS c
  FROM flat a JOIN flat b ON a.x = b.x AND a.len >= 300 AND (b.len > a.len OR (b.len = a.len AND b.article_id > a.article_id)) GROUP BY 1, 2)
SELECT least(s, l) AS a, greatest(s, l) AS b, round(c, 6) AS containment FROM near WHERE c >= 0.9""",
    "dup_tfidf_cosine_pairs": f"WITH {COSINE} SELECT a, b, round(cosine, 6) AS cosine FROM cosine",
    "dup_verified_method": f"""WITH {COSINE}, rest AS (
  SELECT c.a, c.b, CASE WHEN x.len <= y.len THEN x.g ELSE y.g END AS s, CASE WHEN x.len <= y.len THEN y.g ELSE x.g END AS l, least(x.len, y.len) AS n
  FROM cosine c JOIN sets x ON x.article_id = c.a JOIN sets y ON y.article_id = c.b WHERE cosine < 0.95)
SELECT a, b, 'cosine' AS method FROM cosine WHERE cosine >= 0.95
UNION ALL SELECT a, b, 'containment' FROM rest WHERE n >= 300 AND len(list_intersect(s, l)) / len(s) >= 0.9""",
    "dup_components": f"WITH RECURSIVE {JACCARD}{REACH} SELECT id, component FROM comp",
    "dup_representative": f"""WITH RECURSIVE {JACCARD}{REACH}
SELECT component, arg_min(id, (a.published_at, -length(a.content), id)) AS representative, count(*) AS members FROM comp JOIN articles a ON a.article_id = id GROUP BY component""",
    "url_normalize": f"WITH {URLS} SELECT page_id, url FROM urls",
    "url_article_id": f"WITH {URLS} SELECT page_id, 'sha256:' || sha256(regexp_extract(raw, '^https?://([^/?#]+)', 1) || '|' || url) AS article_id FROM urls",
    "url_dup_links": f"WITH {URLS} SELECT url, count(*) AS n FROM urls GROUP BY url HAVING count(*) > 1",
    "ing_validate": f"""WITH {RECORDS} SELECT doc_id, error, CASE WHEN k <> 4 THEN 'r' END AS author, source AS publisher_name, CASE WHEN k = 2 THEN '2024-01-01 00:00' ELSE '2023-12-31 23:30' END AS published FROM checked""",
    "ing_gold_rows": f"WITH {RECORDS} SELECT printf('a%09d', doc_id) AS article_id, '2023-12-31' AS published_date, length(text) AS content_len, false AS article_id_verified FROM checked WHERE error IS NULL",
    "ing_batch_dedup": "SELECT user_id AS article_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3, event_id) = 1",
    "ing_upsert_keep": f"WITH {HALVES} SELECT * FROM old UNION ALL SELECT * FROM new WHERE doc_id NOT IN (SELECT doc_id FROM old)",
    "ing_upsert_replace": f"WITH {HALVES} SELECT * FROM new UNION ALL SELECT * FROM old WHERE doc_id NOT IN (SELECT doc_id FROM new)",
    "ing_stats": f"""WITH {RECORDS} SELECT count(*) AS read, count(error) AS rejected, count(*) FILTER (error IS NULL) AS valid, CAST(0 AS BIGINT) AS batch_duplicates,
  count(*) FILTER (error IS NULL AND doc_id % 5 = 0) AS skipped, count(*) FILTER (error IS NULL AND doc_id % 5 <> 0) AS written FROM checked""",
    "ing_window_scan": "SELECT '2024-01-0' || (1 + doc_id % 10) AS published_date, count(*) AS n FROM documents WHERE doc_id % 10 IN (2, 3) GROUP BY 1",
    "cln_whitespace": f"WITH {ARTICLES} SELECT article_id, {SQUEEZED} AS text FROM articles",
    "cln_line_filter": f"WITH {ARTICLES} SELECT article_id, array_to_string([x FOR x IN string_split(content, chr(10)) IF NOT contains(x, '|')], chr(10)) AS text FROM articles",
    "cln_status": f"WITH {ARTICLES}, c AS (SELECT {SQUEEZED} AS t FROM articles) SELECT CASE WHEN t = '' THEN 'empty' WHEN length(t) < 100 THEN 'short' ELSE 'ok' END AS status, count(*) AS n FROM c GROUP BY 1",
    "sen_turns": f"""WITH marked AS (SELECT conv_id, regexp_replace(regexp_replace(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '({ENDS})\\s+', '\\1' || chr(1), 'g'), '({ENDS})([가-힣])', '\\1' || chr(1) || '\\2', 'g') AS t FROM conversations),
pieces AS (SELECT conv_id, unnest([x FOR x IN [trim(x, ' ' || chr(9) || chr(10) || chr(13)) FOR x IN regexp_split_to_array(t, '[\\n\\x01]+')] IF x <> '']) AS s FROM marked)
SELECT conv_id, count(*) AS sentences FROM pieces GROUP BY conv_id""",
    "sen_split": f"WITH {SENTENCES} SELECT article_id, CAST(pos AS INTEGER) AS pos, sentence FROM sentences",
    "sen_quotes": f"""WITH {ARTICLES}, q AS (SELECT article_id, unnest(regexp_extract_all(content, '"[^"]+"|“[^”]+”')) AS q FROM articles) SELECT article_id, trim(substr(q, 2, length(q) - 2), ' ' || chr(10)) AS quote FROM q WHERE trim(substr(q, 2, length(q) - 2), ' ' || chr(10)) <> ''""",
    "sen_speech_type": f"""WITH {SENTENCES} SELECT CASE WHEN regexp_matches(sentence, '"[^"]*[^"\\s][^"]*"|“[^”]*[^”\\s][^”]*”') THEN 'direct_quote' WHEN {REPORTING} THEN 'reported_speech' ELSE 'none' END AS speech, count(*) AS n FROM sentences GROUP BY 1""",
    "sen_opinion_filter": f"""WITH {SENTENCES} SELECT article_id, count(*) AS n FROM sentences WHERE NOT (NOT (contains(sentence, '"') OR contains(sentence, '''') OR {REPORTING}) AND ({OPINION})) GROUP BY 1""",
    "sen_evidence_sources": f"WITH {EVIDENCE} SELECT category, sentence, publishers, CAST(articles AS INTEGER) AS articles FROM evidence WHERE publishers >= 2",
    "fct_numbers": f"""WITH {ARTICLES} SELECT article_id, array_to_string(regexp_extract_all(regexp_replace(content, '\\(\\s*\\d{{1,3}}\\s*[·,/]\\s*\\d{{1,3}}\\s*기?\\s*\\)', '', 'g'), '\\d+(?:,\\d{{3}})*(?:\\.\\d+)?'), '|') AS numbers FROM articles""",
    "fct_cross_validated": f"WITH {EVIDENCE} SELECT category, sentence, publishers, CAST(row_number() OVER (PARTITION BY category ORDER BY publishers DESC, first, sentence) AS INTEGER) AS rank FROM evidence WHERE publishers >= 2",
    "vec_norm": f"WITH {ISSUE} SELECT article_id, round(sqrt(list_inner_product(vector, vector)), 6) AS norm FROM issue",
    "vec_centroid": f"WITH {ISSUE}, {centroids('issue', 'issue_local >= 0')} SELECT issue_local, CAST(generate_subscripts(centroid, 1) - 1 AS INTEGER) AS d, round(unnest(centroid), 6) AS x FROM c_issue",
    "vec_nearest": f"""WITH {ISSUE}, {centroids("issue", "issue_local >= 0")} SELECT i.article_id, c.issue_local, round(list_inner_product(i.vector, c.centroid), 6) AS sim FROM issue i CROSS JOIN c_issue c
  QUALIFY row_number() OVER (PARTITION BY i.article_id ORDER BY list_inner_product(i.vector, c.centroid) DESC, c.issue_local) = 1""",
    "vec_topk_pairs": f"WITH {PAIR_SIMS} SELECT a, b, round(sim, 6) AS sim FROM sims WHERE sim >= 0.3",
    "emb_input": f"WITH {ARTICLES}, i AS (SELECT article_id, title || chr(10) || substr(content, 1, 500) AS x FROM articles) SELECT article_id, sha1('passage: ' || x) AS input_sha1, length(x) AS len FROM i",
    "emb_plan": f"""WITH {ARTICLES}, old AS (SELECT article_id, CASE WHEN doc_id % 5 = 0 THEN 'x' ELSE sha1(content) END AS h, CASE WHEN doc_id % 7 = 0 THEN 'm0' ELSE 'm1' END AS model FROM articles WHERE doc_id % 4 <> 0),
want AS (SELECT article_id, sha1(content) AS h FROM articles WHERE doc_id % 6 <> 1)
SELECT CASE WHEN w.h IS NULL THEN 'remove' WHEN o.h IS NULL THEN 'new' WHEN o.h = w.h AND o.model = 'm1' THEN 'keep' ELSE 'changed' END AS action, count(*) AS n FROM want w FULL JOIN old o USING (article_id) GROUP BY 1""",
    "clu_sizes": f"WITH {ISSUE} SELECT issue_local, CAST(count(*) AS INTEGER) AS issue_size, count(*) AS n FROM issue GROUP BY 1",
    "qlt_structured": f"WITH {ISSUE} SELECT issue_local, count(*) AS size, count(DISTINCT publisher_id) AS publishers FROM issue WHERE issue_local >= 0 GROUP BY 1 HAVING count(DISTINCT publisher_id) <= 3 AND count(*) >= 10",
    "qlt_rescue": f"""WITH {RESCUE.replace("{where}", "true").replace("{lost}", "i.issue_local < 0")},
moved AS (SELECT i.article_id, coalesce(b.to_, i.issue_local) AS issue_local, b.sim IS NOT NULL AS rescued, b.sim FROM issue i LEFT JOIN (SELECT * FROM best WHERE sim >= 0.1) b USING (article_id))
SELECT article_id, issue_local, CAST(count(*) OVER (PARTITION BY issue_local) AS INTEGER) AS issue_size, issue_local IN (SELECT issue_local FROM flags) AS structured, rescued, round(sim, 6) AS rescue_sim FROM moved""",
    "asg_place": f"""WITH {RESCUE.replace("FROM issue WHERE issue_local >= 0 GROUP", "FROM issue WHERE article_id % 5 <> 0 AND issue_local >= 0 GROUP").replace("{where}", "article_id % 5 <> 0").replace("{lost}", "i.article_id % 5 = 0")},
placed AS (SELECT i.article_id, CASE WHEN i.article_id % 5 <> 0 THEN i.issue_local ELSE coalesce(b.to_, -1) END AS issue_local FROM issue i LEFT JOIN (SELECT * FROM best WHERE sim >= 0.1) b USING (article_id))
SELECT article_id, issue_local, CAST(count(*) OVER (PARTITION BY issue_local) AS INTEGER) AS issue_size FROM placed""",
    "suc_votes": f"WITH {WINDOWS} SELECT issue_local, prev_id, shared FROM votes",
    "suc_winner": f"WITH {WINDOWS} SELECT issue_local, prev_id, shared FROM won",
    "suc_split": f"WITH {WINDOWS} SELECT issue_local, prev_id FROM claims",
    "suc_mint": f"""WITH {WINDOWS}, labels_ AS (SELECT DISTINCT issue_local FROM now WHERE issue_local >= 0),
ids AS (
  SELECT issue_local, prev_id AS issue_id, 'inherited' AS status FROM claims
  UNION ALL SELECT issue_local, 500 + row_number() OVER (ORDER BY issue_local), 'new' FROM labels_ WHERE issue_local NOT IN (SELECT issue_local FROM claims))
SELECT issue_local, CAST(issue_id AS BIGINT) AS issue_id, status, count(*) AS members FROM now JOIN ids USING (issue_local) GROUP BY ALL""",
    "suc_retired": f"WITH {WINDOWS} SELECT DISTINCT issue_id FROM prev WHERE issue_id NOT IN (SELECT prev_id FROM claims)",
    "fed_rollup": f"WITH {MEMBERS} SELECT issue_local, count(*) AS issue_size, count(DISTINCT publisher_id) AS publishers, strftime(min(published_at), '%Y-%m-%d %H:%M') AS first, strftime(max(published_at), '%Y-%m-%d %H:%M') AS last FROM members WHERE issue_local >= 0 GROUP BY 1",
    "fed_representative": f"WITH {REPRESENTATIVE} SELECT issue_local, representative FROM rep",
    "fed_category_majority": f"WITH {MEMBERS}, {category('SELECT issue_local, arg_min(category, article_id) AS fallback FROM named GROUP BY 1')} SELECT issue_local, category FROM cats",
    "fed_hot_score": f"WITH {FEED} SELECT * FROM feed",
    "fed_topk": f"WITH {FEED} SELECT issue_local, hot_score FROM feed ORDER BY hot_score DESC, issue_local LIMIT 5",
    "key_contrastive_terms": f"WITH {contrastive('ws')}",
    "key_contrastive_bigrams": f"WITH {contrastive('''[ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]''')}",
    "evl_consensus": f"""WITH RECURSIVE {LABELERS}, pairs AS (
  SELECT x.article_id AS a, y.article_id AS b FROM lab x JOIN lab y ON x.labeler = y.labeler AND x.cluster = y.cluster AND x.article_id < y.article_id GROUP BY ALL HAVING count(*) >= 2){REACH}
SELECT i.article_id, coalesce(c.component, i.article_id) AS component FROM (SELECT DISTINCT article_id FROM lab) i LEFT JOIN comp c ON c.id = i.article_id""",
    "evl_ari": f"WITH {ISSUE}, {ari('SELECT issue_local AS a, CASE WHEN article_id % 4 = 0 THEN issue_local + 50 ELSE issue_local END AS b FROM issue')}",
    "evl_ari_noise": f"""WITH {ISSUE}, {ari("SELECT CASE WHEN issue_local >= 0 THEN CAST(issue_local AS VARCHAR) ELSE 'noise-' || article_id END AS a, article_id % 9 AS b FROM issue")}""",
    "evl_pair_strata": """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END AS l FROM embeddings),
p AS (SELECT x.vec_id % 3 <> 0 AS same, x.l = y.l AND x.l >= 0 AS together, list_inner_product(x.v, y.v) AS sim FROM e x JOIN e y ON y.vec_id = x.vec_id + 1)
SELECT count(*) AS scored, count(*) FILTER (together) AS same_n, round(avg(CAST(same AS INTEGER)) FILTER (together), 4) AS precision, count(*) FILTER (NOT together AND sim >= 0.1) AS boundary_n,
  round(avg(CAST(same AS INTEGER)) FILTER (NOT together AND sim >= 0.1), 4) AS oversplit_rate, count(*) FILTER (NOT together AND sim < 0.1) AS random_n, round(avg(CAST(same AS INTEGER)) FILTER (NOT together AND sim < 0.1), 4) AS human_same_rate,
  round(avg(CAST(together AS INTEGER)) FILTER (same), 4) AS recall_in_sample FROM p""",
    "evl_dedup_prf": f"WITH {FOLDED}, {prf('SELECT CASE WHEN d.duplicate_of IS NOT NULL THEN 1 ELSE 0 END AS p, 1 - l.quality AS a FROM dup d JOIN articles USING (article_id) JOIN labels l USING (doc_id)')}",
    "evl_confusion": f"WITH {prf('SELECT toxic AS p, quality AS a FROM labels')}",
    "evl_merge_verdicts": """WITH n AS (SELECT event_id % 500 AS pair_id, count(*) FILTER (user_id % 3 = 0) AS o, count(*) FILTER (user_id % 3 <> 0) AS x FROM events GROUP BY 1)
SELECT pair_id, o, x, CASE WHEN o >= 12 THEN 'O' WHEN x >= 12 THEN 'X' ELSE 'ambiguous' END AS gold FROM n""",
    "evl_separation": f"""WITH {PAIR_SIMS}, q AS (SELECT quantile_cont(sim, 0.1) FILTER ((a + b) % 2 = 0) AS p10, quantile_cont(sim, 0.9) FILTER ((a + b) % 2 = 1) AS p90 FROM sims)
SELECT round(p10, 6) AS p10, round(p90, 6) AS p90, round(p10 - p90, 6) AS separation FROM q""",
    "evl_round_robin": "SELECT doc_id, array_to_string([(doc_id + k) % 6 + 1 FOR k IN range(3)], ',') AS labelers FROM labels",
    "prf_profile": f"""WITH {ARTICLES} SELECT count(*) AS articles, count(DISTINCT publisher_id) AS publishers, min(published_date) AS first_date, max(published_date) AS last_date, count(*) FILTER (trim(content, ' ' || chr(10) || chr(9)) = '') AS empty_contents,
  min(length(content)) AS min_len, max(length(content)) AS max_len, round(avg(length(content)), 4) AS avg_len FROM articles""",
    "prf_len_buckets": f"WITH {ARTICLES} SELECT {BUCKET} AS bucket, count(*) AS n FROM articles GROUP BY 1",
    "prf_first_last_lines": f"""WITH {ARTICLES}, l AS (SELECT [trim(x, ' ' || chr(9) || chr(13)) FOR x IN string_split(content, chr(10)) IF trim(x, ' ' || chr(9) || chr(13)) <> ''] AS l FROM articles),
e AS (SELECT 'first' AS place, l[1] AS line FROM l WHERE len(l) > 0 UNION ALL SELECT 'last', l[len(l)] FROM l WHERE len(l) > 0),
n AS (SELECT place, line, count(*) AS n FROM e GROUP BY ALL)
SELECT place, line, n FROM n QUALIFY row_number() OVER (PARTITION BY place ORDER BY n DESC, line) <= 20""",
    "prf_date_parse": "SELECT event_id, strftime(CAST(ts AS TIMESTAMP) - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS utc FROM events",
    "prf_repeated_titles": f"WITH {ARTICLES} SELECT publisher_id, title, count(*) AS n FROM articles GROUP BY ALL HAVING count(*) > 1",
    "exp_join": f"WITH {EXPORT} SELECT article_id, CAST(issue_id AS BIGINT) AS issue_id, url, category FROM rows_",
    "exp_reuse": f"""WITH {EXPORT}, now AS (SELECT issue_id, list(DISTINCT url ORDER BY url) AS links FROM rows_ GROUP BY 1),
old AS (SELECT issue_id, list(DISTINCT url ORDER BY url) AS links FROM rows_ WHERE issue_id <> 103 OR article_id % 2 = 0 GROUP BY 1)
SELECT CAST(n.issue_id AS BIGINT) AS issue_id, coalesce(n.links = o.links AND n.issue_id <> 104, false) AS reuse FROM now n LEFT JOIN old o USING (issue_id)""",
    "exp_message": f"""WITH {EXPORT}, a AS (SELECT issue_id, list(url ORDER BY published_at, url) AS urls FROM rows_ GROUP BY 1)
SELECT CAST(issue_id AS BIGINT) AS issue_id, '{{"clusterId":' || issue_id || ',"category":"경제","factSummary":"s","commonFactsBriefing":["s"],"clusteredAt":"2024-01-02T03:00:00+09:00","articles":[' ||
  array_to_string(['{{"link":"' || u || '","viewpointGroupLabel":"기타 관점","stance":"neutral"}}' FOR u IN urls], ',') || ']}}' AS value FROM a""",
}
