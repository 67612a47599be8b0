"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "op1_exact_top_k": """
        WITH codes AS (
            SELECT vec_id, row_number() OVER () AS r,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS code
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, q.r, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.code, c.code), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM codes q JOIN codes c ON c.r <> q.r WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
        FROM scored WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5""",
    "op5_embedding_near_dedup": """
        WITH RECURSIVE valid AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
        reach AS (
            SELECT a AS node, b AS other FROM links
            UNION
            SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
        direct AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        least_of AS (SELECT node, min(other) AS m FROM reach GROUP BY node)
        SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(l.m, e.vec_id)) AS component_id,
               e.vec_id = least(e.vec_id, coalesce(l.m, e.vec_id)) AS kept
        FROM embeddings e LEFT JOIN direct d ON d.a = e.vec_id LEFT JOIN least_of l ON l.node = e.vec_id""",
    "op8_ngram_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda w: w <> '') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
            FROM words),
        tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
            WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (
            SELECT a AS node, b AS other FROM links
            UNION
            SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
        least_of AS (SELECT node, min(other) AS m FROM reach GROUP BY node)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.m, s.doc_id)) AS component_id
        FROM sets s LEFT JOIN least_of l ON l.node = s.doc_id""",
    "op2_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        placed AS (
            SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before,
                   length(text) + len(regexp_extract_all(text, '[\\<#]')) + 8
                     + length(role) + len(regexp_extract_all(role, '[\\<#:]')) + 6 AS with_header,
                   length(role) + len(regexp_extract_all(role, '[\\<#:]')) + 6 AS header
            FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)),
        said AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS all_turns,
                   coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '') AS loss,
                   sum(with_header - CASE WHEN before IS NOT DISTINCT FROM role AND k > 1 THEN header ELSE 0 END) AS chars
            FROM placed GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(all_turns) AS turns_sha256, length(loss) AS loss_chars,
               sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
        FROM said""",
    "op4_stupid_backoff": r"""
        WITH lists AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda w: w <> '') AS ws FROM documents),
        toks AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM lists),
        pairs AS (SELECT *, lag(w) OVER s AS v, lag(w, 2) OVER s AS u FROM toks WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
        one AS (SELECT w, count(*) AS n FROM toks GROUP BY w),
        two AS (SELECT v, w, count(*) AS n FROM pairs WHERE v IS NOT NULL GROUP BY v, w),
        three AS (SELECT u, v, w, count(*) AS n FROM pairs WHERE u IS NOT NULL GROUP BY u, v, w),
        own1 AS (SELECT doc_id, w, count(*) AS n FROM toks GROUP BY doc_id, w),
        own2 AS (SELECT doc_id, v, w, count(*) AS n FROM pairs WHERE v IS NOT NULL GROUP BY doc_id, v, w),
        own3 AS (SELECT doc_id, u, v, w, count(*) AS n FROM pairs WHERE u IS NOT NULL GROUP BY doc_id, u, v, w),
        size AS (SELECT doc_id, count(*) AS n FROM toks GROUP BY doc_id),
        scored AS (
            SELECT p.doc_id, p.i,
                   coalesce(three.n - o3.n, 0) AS c3, ctx2.n - oc2.n AS h2,
                   coalesce(two.n - o2.n, 0) AS c2, ctx.n - oc.n AS c1, one.n - o1.n AS c0,
                   (SELECT count(*) FROM toks) - size.n AS rest
            FROM pairs p JOIN one ON one.w = p.w JOIN own1 o1 ON o1.doc_id = p.doc_id AND o1.w = p.w
            JOIN size ON size.doc_id = p.doc_id
            LEFT JOIN two ON two.v = p.v AND two.w = p.w
            LEFT JOIN own2 o2 ON o2.doc_id = p.doc_id AND o2.v = p.v AND o2.w = p.w
            LEFT JOIN one ctx ON ctx.w = p.v LEFT JOIN own1 oc ON oc.doc_id = p.doc_id AND oc.w = p.v
            LEFT JOIN three ON three.u = p.u AND three.v = p.v AND three.w = p.w
            LEFT JOIN own3 o3 ON o3.doc_id = p.doc_id AND o3.u = p.u AND o3.v = p.v AND o3.w = p.w
            LEFT JOIN two ctx2 ON ctx2.v = p.u AND ctx2.w = p.v
            LEFT JOIN own2 oc2 ON oc2.doc_id = p.doc_id AND oc2.v = p.u AND oc2.w = p.v),
        sums AS (
            SELECT doc_id, count(*) AS n_words,
                   count(*) FILTER (i > 2 AND c3 = 0 OR i = 2 AND c2 = 0) AS n_backed_off,
                   sum(CASE WHEN i > 2 AND c3 > 0 THEN ln(c3 / h2)
                            WHEN i > 1 AND c2 > 0 THEN ln(c2 / c1) + CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END
                            ELSE ln(greatest(c0, 1) / greatest(rest, 1)) + least(i - 1, 2) * ln(0.4) END) AS s
            FROM scored GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_backed_off, 0) AS n_backed_off,
               coalesce(round(s, 6), 0.0) AS log_score
        FROM documents d LEFT JOIN sums ON sums.doc_id = d.doc_id""",
}
