"""SQL of the queries that SQL can express over whole tables.

SimHash needs XXH64, sharding its passes, mixing its rounding, pages their markup, ids and
token counts their models, scores zstandard: tests hold these against brute force.
"""

from __future__ import annotations

# All runs of five words or more that an earlier place has too; a longer run is made of such of up to five lines
OP3 = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM documents
), worded AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq
    FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines) WHERE words > 0
), runs AS (
    SELECT a.doc_id, a.seq, b.seq AS last, a.pos AS start_pos, max(c.pos) AS end_pos,
        sum(c.words) AS words, string_agg(c.line, chr(10) ORDER BY c.seq) AS content
    FROM worded a JOIN worded b ON b.doc_id = a.doc_id AND b.seq BETWEEN a.seq AND a.seq + 4
    JOIN worded c ON c.doc_id = a.doc_id AND c.seq BETWEEN a.seq AND b.seq
    GROUP BY ALL HAVING sum(c.words) >= 5
), copies AS (
    SELECT * FROM runs
    QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, seq) > 1
), removed AS (
    SELECT DISTINCT l.doc_id, l.pos FROM lines l JOIN copies c ON l.doc_id = c.doc_id AND l.pos BETWEEN c.start_pos AND c.end_pos
)
SELECT l.doc_id, coalesce(string_agg(CASE WHEN r.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos), '') AS text,
    CAST(count(*) AS INTEGER) AS n_lines, CAST(count(r.pos) AS INTEGER) AS removed_lines
FROM lines l LEFT JOIN removed r ON l.doc_id = r.doc_id AND l.pos = r.pos
GROUP BY l.doc_id
UNION ALL
SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
"""

OP4 = """
WITH vectors AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
)
SELECT q.vec_id AS query_id,
    CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, d.v) DESC, d.vec_id) AS INTEGER) AS rank,
    d.vec_id AS vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
FROM vectors q JOIN vectors d ON q.vec_id != d.vec_id
WHERE q.vec_id % 20 = 0
QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, d.v) DESC, d.vec_id) <= 20
"""

ORACLE: dict[str, str] = {"op3_line_dedup": OP3, "op4_knn": OP4}
