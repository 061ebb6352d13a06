"""The twin of the repair query: every state of every row at once, by a recursive query."""

DUCKDB = r"""
WITH RECURSIVE crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) r(i))
), given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
            string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
    FROM conversations, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM given WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged
), seen AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
        NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
        NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
    FROM placed
), facts AS (
    SELECT conv_id, max(pos) AS n,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
        count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM seen GROUP BY conv_id
), search AS (
    SELECT conv_id, 0::BIGINT AS pos, {'c': 0, 'a': ''} AS s0, {'c': 999999999, 'a': ''} AS s1,
        {'c': 999999999, 'a': ''} AS s2, {'c': 999999999, 'a': ''} AS s3 FROM facts
    UNION ALL
    SELECT conv_id, pos,
        {'c': g0.c + 2, 'a': g0.a || 'D'},
        least({'c': g1.c + 2, 'a': g1.a || 'D'}, {'c': g0.c + more + CASE WHEN r = 's' THEN 0 ELSE 999999999 END, 'a': g0.a || 'K'}),
        least({'c': g2.c + 2, 'a': g2.a || 'D'}, {'c': g0.c + more + (r <> 'u')::INT, 'a': g0.a || CASE r WHEN 'u' THEN 'K' ELSE 'R' END},
            {'c': g1.c + more + (r <> 'u')::INT, 'a': g1.a || CASE r WHEN 'u' THEN 'K' ELSE 'R' END},
            {'c': g3.c + more + (r <> 'u')::INT, 'a': g3.a || CASE r WHEN 'u' THEN 'K' ELSE 'R' END}),
        least({'c': g3.c + 2, 'a': g3.a || 'D'}, {'c': g2.c + more + (r <> 'a')::INT, 'a': g2.a || CASE r WHEN 'a' THEN 'K' ELSE 'R' END})
    FROM (
        SELECT x.conv_id, x.pos, left(x.role, 1) AS r, CASE WHEN x.blank OR x.again THEN 999999999 WHEN x.cut THEN 5 ELSE 0 END AS more,
            s0 AS g0, s1 AS g1,
            least(s2, {'c': s0.c + 5, 'a': s0.a || 'I'}, {'c': s1.c + 5, 'a': s1.a || 'I'}, {'c': s3.c + 5, 'a': s3.a || 'I'}) AS g2,
            least(s3, {'c': s2.c + 5, 'a': s2.a || 'I'}) AS g3
        FROM search s JOIN seen x ON x.conv_id IS NOT DISTINCT FROM s.conv_id AND x.pos = s.pos + 1
    )
), solved AS (
    SELECT f.*, least(s0, s3, {'c': s2.c + 5, 'a': s2.a || 'I'}) AS found
    FROM facts f JOIN search s ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.pos = f.n
), letters AS (
    SELECT conv_id, unnest(string_split(found.a, '')) AS letter, generate_subscripts(string_split(found.a, ''), 1) AS step FROM solved
), steps AS (
    SELECT *, count(*) FILTER (letter <> 'I') OVER so_far AS pos, count(*) FILTER (letter <> 'D') OVER so_far AS k
    FROM letters WINDOW so_far AS (PARTITION BY conv_id ORDER BY step)
), written AS (
    SELECT s.conv_id, s.step, s.letter, s.k, x.role, CASE s.letter WHEN 'I' THEN '' ELSE x.text END AS text,
        max(s.letter = 'K' AND s.k = 1 AND left(x.role, 1) = 's') OVER (PARTITION BY s.conv_id) AS has_system
    FROM steps s LEFT JOIN seen x ON x.conv_id IS NOT DISTINCT FROM s.conv_id AND x.pos = s.pos
    WHERE s.letter <> 'D'
), digest AS (
    SELECT conv_id, sha256(string_agg(CASE letter WHEN 'K' THEN role ELSE
        CASE (k - has_system::INT) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END || ':' || text, chr(10) ORDER BY step)) AS d
    FROM written GROUP BY conv_id
), all_ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(found.c, 0)::BIGINT AS cost,
    coalesce(found.a, '') AS audit, coalesce(d, sha256('')) AS repaired_sha256
FROM all_ids i LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN digest g ON g.conv_id IS NOT DISTINCT FROM i.conv_id
"""
