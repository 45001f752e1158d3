"""DuckDB SQL of star groups and of the whole fold: rounds of components and stars, written out."""

from __future__ import annotations

from tidewire.plans.oracle import COSINE, GRAMS, JACCARD

#: Rounds that are written out; the test tables' components are used up after fewer.
ROUNDS, CAP = 5, 30


def stars(edges: str) -> str:
    """CTEs up to ``star`` (id, representative, size, oversized) of the edges (a, b) of a CTE."""
    out, now = "", edges
    for r in range(ROUNDS):
        out += f""", sym{r} AS (SELECT a AS u, b AS v FROM {now} UNION SELECT b, a FROM {now}),
reach{r} AS (SELECT u, v FROM sym{r} UNION SELECT x.u, e.v FROM reach{r} x JOIN sym{r} e ON x.v = e.u),
comp{r} AS (SELECT u AS id, least(u, min(v)) AS c FROM reach{r} GROUP BY u),
head{r} AS (SELECT c, arg_min(id, (o.published_at, -length(o.content), id)) AS head FROM comp{r} JOIN articles o ON o.article_id = id GROUP BY c),
near{r} AS (SELECT head, v AS id, row_number() OVER (PARTITION BY head ORDER BY v) AS place, count(*) OVER (PARTITION BY head) AS n FROM head{r} JOIN sym{r} ON u = head),
star{r} AS (SELECT id, head AS representative, least(n, {CAP - 1}) + 1 AS size, n + 1 > {CAP} AS oversized FROM near{r} WHERE place < {CAP}
  UNION SELECT head, head, least(n, {CAP - 1}) + 1, n + 1 > {CAP} FROM near{r}),
rest{r} AS (SELECT a, b FROM {now} WHERE a NOT IN (SELECT id FROM star{r}) AND b NOT IN (SELECT id FROM star{r}))"""
        now = f"rest{r}"
    return out + ", star AS (" + " UNION ALL ".join(f"SELECT * FROM star{r}" for r in range(ROUNDS)) + ")"


SQL = {
    "dup_star_groups": f"WITH RECURSIVE {JACCARD}{stars('pairs')} SELECT id, representative, size, oversized FROM star",
    "dup_banded_recall": f"WITH {JACCARD} SELECT count(*) AS exact, true AS enough FROM pairs",
    "dup_fold_exact": f"""WITH RECURSIVE {GRAMS}, flat AS (SELECT article_id, len, len(g) AS n, unnest(g) AS x FROM sets),
jac AS (
  SELECT a.article_id AS a, b.article_id AS b, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM flat a JOIN flat b ON a.x = b.x AND a.article_id < b.article_id AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n) - 1e-9 GROUP BY 1, 2),
cont AS (
  SELECT a.article_id AS s, b.article_id AS l, count(*) / any_value(a.n) AS c
  FROM flat a JOIN flat b ON a.x = b.x AND a.len >= 300 AND (b.len > a.len OR (b.len = a.len AND b.article_id > a.article_id)) GROUP BY 1, 2),
pairs AS (SELECT a, b FROM jac WHERE shared / (na + nb - shared) >= 0.7 UNION SELECT least(s, l), greatest(s, l) FROM cont WHERE c >= 0.9){COSINE[len(JACCARD):]},
beside AS (
  SELECT c.a, c.b, CASE WHEN x.len <= y.len THEN x.g ELSE y.g END AS s, CASE WHEN x.len <= y.len THEN y.g ELSE x.g END AS l, least(x.len, y.len) AS n
  FROM cosine c JOIN sets x ON x.article_id = c.a JOIN sets y ON y.article_id = c.b WHERE cosine < 0.95),
confirmed AS (SELECT a, b, 'cosine' AS method FROM cosine WHERE cosine >= 0.95 UNION ALL SELECT a, b, 'containment' FROM beside WHERE n >= 300 AND len(list_intersect(s, l)) / len(s) >= 0.9){stars('confirmed')},
copies AS (SELECT article_id, first_value(article_id) OVER (PARTITION BY h ORDER BY published_at, article_id) AS rep FROM able),
folded AS (
  SELECT c.article_id, coalesce(s.representative, c.rep) AS final, CASE WHEN c.article_id <> c.rep THEN 'sha256' ELSE m.method END AS method
  FROM copies c LEFT JOIN star s ON s.id = c.rep AND s.representative <> c.rep
  LEFT JOIN confirmed m ON least(m.a, m.b) = least(s.id, s.representative) AND greatest(m.a, m.b) = greatest(s.id, s.representative)),
counted AS (SELECT *, count(*) OVER (PARTITION BY final) AS n FROM folded)
SELECT article_id, CASE WHEN final <> article_id THEN final END AS duplicate_of, CAST(CASE WHEN final = article_id THEN n ELSE 0 END AS INTEGER) AS duplicate_count, method FROM counted
UNION ALL SELECT article_id, NULL, 1, NULL FROM articles WHERE article_id NOT IN (SELECT article_id FROM able)""",
}
