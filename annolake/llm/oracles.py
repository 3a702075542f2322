"""DuckDB SQL for the queries of this package that SQL can express. The others are tested
against brute force, exact round trips or held-out accuracy (tests/llm)."""

_OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT k, i, array_to_string(ws[i:i + 4], chr(1)) AS g FROM d, unnest(range(1, len(ws) - 3)) u(i)),
rep AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT k, count(DISTINCT i + j) AS n FROM rep, unnest(range(0, 5)) v(j) GROUP BY k),
lin AS (SELECT k, l FROM (SELECT k, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT k, count(*) - count(DISTINCT l) AS n FROM lin GROUP BY k),
m AS (
  SELECT d.k, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         length(t) - length(replace(t, chr(10), '')) + 1 AS n_lines
  FROM d LEFT JOIN dup USING (k) LEFT JOIN cov USING (k)),
f AS (
  SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2,
         100 * n_symbols > 20 * word_chars AS f3, 100 * n_dup_lines > 30 * n_lines AS f4 FROM m),
fail AS (
  SELECT source, r, count(*) AS n, sum(CAST(b AS INT)) AS x
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS r, unnest([f1, f2, f3, f4]) AS b FROM f WHERE source IS NOT NULL) GROUP BY ALL),
prior AS (SELECT r, avg(x / n) AS m, var_pop(x / n) AS v FROM fail GROUP BY r),
beta AS (SELECT r, m, CASE WHEN v > 0 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1.0 END AS s FROM prior),
verdict AS (SELECT source, max((x + m * s) / (n + s)) < 0.5 AS ok FROM fail JOIN beta USING (r) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
       coalesce(ok, true) AS host_ok, NOT (f1 OR f2) AND coalesce(ok, true) AS kept
FROM f LEFT JOIN verdict ON verdict.source = f.source
"""

_OP4 = r"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS k, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT k, vec_id, label, e FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.k AS x, b.k AS y FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.k <> b.k
         WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
low AS (SELECT x AS k, min(v.vec_id) AS c FROM reach JOIN v ON v.k = reach.y GROUP BY x),
n AS (SELECT x AS k, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(low.c, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low.c, vec_id)) AS kept
FROM v LEFT JOIN n USING (k) LEFT JOIN low USING (k)
"""

_OP11 = r"""
WITH v AS (SELECT row_number() OVER () AS k, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.k, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.k <> b.k AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

ORACLES = {"op2_quality_rules": _OP2, "op4_embedding_near_duplicates": _OP4, "op11_top_k_search": _OP11}
