"""DuckDB SQL for the queries that SQL can express.

The others (tokens, contextual personal data, fingerprints, language, mixing, toxicity, language
model) are tested against brute-force versions in ``tests/llm``.
"""

_COMPONENTS = """
  reach AS (
    SELECT a AS id, b AS other FROM link UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.other),
  component AS (SELECT id, least(id, min(other)) AS component_id FROM reach GROUP BY id)"""

OP1 = f"""
WITH RECURSIVE v AS (
    SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)) > 0),
  link AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.label = b.label AND a.id <> b.id
           AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
{_COMPONENTS},
  n AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
SELECT d.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.component_id, d.vec_id) AS component_id,
       coalesce(c.component_id, d.vec_id) = d.vec_id AS kept
FROM embeddings d LEFT JOIN n ON n.id = d.vec_id LEFT JOIN component c ON c.id = d.vec_id
"""

OP8 = f"""
WITH RECURSIVE w AS (
    SELECT doc_id AS id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
  s AS (SELECT DISTINCT id, CASE WHEN len(words) = 1 THEN words[1] ELSE words[i] || ' ' || words[i + 1] END AS shingle
        FROM (SELECT id, words, unnest(generate_series(1, greatest(len(words) - 1, 1))) AS i FROM w WHERE len(words) > 0)),
  size AS (SELECT id, count(*) AS n FROM s GROUP BY id),
  pair AS (SELECT a.id AS a, b.id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.id <> b.id
           GROUP BY a.id, b.id),
  link AS (SELECT a, b FROM pair JOIN size x ON x.id = a JOIN size y ON y.id = b
           WHERE 100 * common >= 80 * (x.n + y.n - common)),
{_COMPONENTS}
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN size z ON z.id = d.doc_id LEFT JOIN component c ON c.id = d.doc_id
"""

OP9 = """
WITH l AS (
    SELECT doc_id AS d, i - 1 AS ln, parts[i] AS line,
           greatest(1, len(regexp_extract_all(parts[i], '[^\\x20\\x09-\\x0D]+'))) AS words
    FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i
          FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text <> ''))),
  same AS (SELECT p.d AS pd, q.d AS qd, p.ln AS ln, p.ln - q.ln AS shift, p.words
           FROM l p JOIN l q ON p.line = q.line AND (q.d < p.d OR (q.d = p.d AND q.ln < p.ln))),
  run AS (SELECT *, ln - row_number() OVER (PARTITION BY pd, qd, shift ORDER BY ln) AS island FROM same),
  cut AS (SELECT DISTINCT pd AS d, ln FROM (
            SELECT *, sum(words) OVER (PARTITION BY pd, qd, shift, island) AS total FROM run) WHERE total >= 50),
  per AS (SELECT l.d, count(*) AS n_lines, count(cut.ln) AS n_cut,
                 coalesce(string_agg(CAST(cut.ln AS VARCHAR), ',' ORDER BY l.ln), '') AS cut_lines,
                 coalesce(string_agg(l.line, chr(10) ORDER BY l.ln) FILTER (WHERE cut.ln IS NULL), '') AS kept
          FROM l LEFT JOIN cut ON cut.d = l.d AND cut.ln = l.ln GROUP BY l.d)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_cut, 0) AS n_cut, coalesce(cut_lines, '') AS cut_lines,
       sha256(coalesce(kept, '')) AS text_sha256
FROM documents d LEFT JOIN per ON per.d = d.doc_id
"""

ORACLES = {"op1_embedding_near_dedup": OP1, "op8_minhash_near_dedup": OP8, "op9_line_dedup": OP9}
