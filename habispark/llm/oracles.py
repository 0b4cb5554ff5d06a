"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op5_minhash_dedup": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^ \\t-\\r]+') AS ws FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS g FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
            GROUP BY ALL
        ), link AS (
            SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
            WHERE 100 * c >= 85 * (p.n + q.n - c)
        ), reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT doc_id, b FROM reach JOIN link ON other = a
        ), component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM component LEFT JOIN n USING (doc_id)
    """,
    "op7_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
    "op10_substring_dedup": """
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') AS ws FROM documents
        ), p AS (
            SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w
        ), g AS (
            SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS t FROM p
        ), hit AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS m FROM g) WHERE m < doc_id
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM hit
        ), gs AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
               sha256(array_to_string(CASE WHEN gone IS NULL THEN ws
                   ELSE [ws[i] FOR i IN range(1, len(ws) + 1) IF NOT list_contains(gone, i)] END, ' ')) AS kept_sha256
        FROM w LEFT JOIN gs USING (doc_id)
    """,
    "op11_filter_audit": """
        WITH w AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') AS ws FROM documents
        ), mark AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                   max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
        ), f AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN min(w.doc_id) OVER (PARTITION BY t) < w.doc_id THEN 16 ELSE 0 END AS mask
            FROM w LEFT JOIN mark ON mark.doc_id = w.doc_id
        ), m AS (
            SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask
        ), l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
        z AS (
            SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
                   coalesce(list_sum([1 << (ascii(filter_order[i]) - 65) FOR i IN range(1, step)]), 0)::BIGINT AS prefix
            FROM s
        ), c AS (
            SELECT part, filter_order, step, bit,
                   sum(CASE WHEN mask & (prefix + bit) = 0 THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN mask & bit > 0 AND mask & prefix = 0 THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN mask & bit > 0 AND mask & prefix > 0 THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN mask & bit > 0 AND mask & prefix = 0 THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN mask & bit > 0 AND mask & prefix = 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM m, z GROUP BY ALL
        )
        SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
               redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
               toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley,
               filter_order[step] AS filter
        FROM c
    """,
    "op12_lattice_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), link AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
            WHERE list_cosine_similarity(x.e, y.e) >= 0.9
        ), n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a),
        reach(vec_id, other) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT vec_id, b FROM reach JOIN link ON other = a
        ), component AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM component LEFT JOIN n ON a = vec_id
    """,
    "op13_conversation_repair": r"""
        WITH RECURSIVE crc AS (
            SELECT [list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))
                    FOR n IN range(0, 256)] AS t
        ), named AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
        ), fated AS (
            SELECT conv_id, turn, role, text,
                   xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(name[i])::BIGINT FOR i IN range(1, len(name) + 1)]),
                       lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 20 AS fate
            FROM named, crc
        ), hit AS (
            SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                   CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
            FROM fated WHERE fate <> 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text), copy) AS i,
                   rtrim(text, E' \t\n\x0B\x0C\r') AS ended, left(role, 1) AS initial FROM hit
        ), judged AS (
            SELECT *, ended = '' AS blank,
                   ended <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM placed
        ), f AS (
            SELECT *, NOT blank AND NOT duplicate AND right(ended, 1) NOT IN ('.', '!', '?') AS truncated FROM judged
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                   count(*) FILTER (truncated) AS truncated, count(*) AS n,
                   count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM f GROUP BY conv_id
        ), step AS (
            SELECT conv_id, 0::BIGINT AS i, n, {'c': 0::BIGINT, 'a': ''} AS z, NULL::STRUCT(c BIGINT, a VARCHAR) AS s,
                   {'c': 5::BIGINT, 'a': 'I'} AS u, {'c': 10::BIGINT, 'a': 'II'} AS x FROM counted
            UNION ALL
            SELECT conv_id, i, n, z, s, uu AS u,
                   least(xx, {'c': uu.c + 5, 'a': uu.a || 'I'}) AS x
            FROM (
                SELECT *, least(u0, {'c': z.c + 5, 'a': z.a || 'I'}, CASE WHEN s IS NOT NULL THEN {'c': s.c + 5, 'a': s.a || 'I'} END,
                                {'c': xx.c + 5, 'a': xx.a || 'I'}) AS uu
                FROM (
                    SELECT p.conv_id, f.i, p.n,
                           {'c': p.z.c + 2, 'a': p.z.a || 'D'} AS z,
                           least(CASE WHEN p.s IS NOT NULL THEN {'c': p.s.c + 2, 'a': p.s.a || 'D'} END,
                                 CASE WHEN NOT (blank OR duplicate) AND initial = 's' THEN {'c': p.z.c + tc, 'a': p.z.a || 'K'} END) AS s,
                           least({'c': p.u.c + 2, 'a': p.u.a || 'D'},
                                 CASE WHEN NOT (blank OR duplicate) THEN least(
                                     {'c': p.z.c + tc + kc, 'a': p.z.a || ku},
                                     CASE WHEN p.s IS NOT NULL THEN {'c': p.s.c + tc + kc, 'a': p.s.a || ku} END,
                                     {'c': p.x.c + tc + kc, 'a': p.x.a || ku}) END) AS u0,
                           least({'c': p.x.c + 2, 'a': p.x.a || 'D'},
                                 CASE WHEN NOT (blank OR duplicate) THEN {'c': p.u.c + tc + kd, 'a': p.u.a || ka} END) AS xx
                    FROM step p JOIN (
                        SELECT *, CASE WHEN truncated THEN 5 ELSE 0 END AS tc,
                               CASE WHEN initial = 'u' THEN 0 ELSE 1 END AS kc, CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END AS ku,
                               CASE WHEN initial = 'a' THEN 0 ELSE 1 END AS kd, CASE WHEN initial = 'a' THEN 'K' ELSE 'R' END AS ka
                        FROM f
                    ) f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
                )
            )
        ), best AS (SELECT conv_id, least(z, x) AS b FROM step WHERE i = n),
        letter AS (
            SELECT conv_id, a[j] AS e, j, len(replace(left(a, j), 'I', '')) AS i,
                   len(replace(left(a, j), 'D', '')) AS k, len(replace(a, 'D', '')) % 2 AS odd
            FROM (SELECT conv_id, b.a AS a, unnest(range(1, len(b.a) + 1)) AS j FROM best)
        ), line AS (
            SELECT l.conv_id, j, CASE WHEN e = 'K' THEN role WHEN (k + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                   || CASE WHEN e = 'I' THEN '' ELSE text END AS t
            FROM letter l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i
            WHERE e <> 'D'
        ), whole AS (SELECT conv_id, string_agg(t, E'\n' ORDER BY j) AS t FROM line GROUP BY conv_id)
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
               coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
               sha256(coalesce(whole.t, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN whole ON whole.conv_id IS NOT DISTINCT FROM o.conv_id
    """,
}
