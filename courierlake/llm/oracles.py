"""DuckDB SQL for the operators that SQL can express on whole tables."""

EXACT_DEDUP = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bytes
    FROM documents
), g AS (
    SELECT bytes, count(*) AS group_size,
           first(doc_id ORDER BY length(text) DESC, doc_id) AS keep_id
    FROM t GROUP BY bytes
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.bytes) AS text_sha256
FROM t JOIN g ON t.bytes = g.bytes
"""

#: The leaf's fields are counted in UTF-8 bytes. The CRC-32 of the decimal id is worked out from its table.
MERKLE_MANIFEST = r"""
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
), d AS (
    SELECT doc_id, lang, n_chars,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        coalesce(strlen(text) || ':' || text, '-') AS tail,
        xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 7 = 0 AS tampered
    FROM documents, crc_table
), h AS (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
        CASE WHEN tampered THEN
            sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS changed
    FROM d
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos FROM h
), levels(lang, h, nodes) AS (
    SELECT lang, 0, list(leaf ORDER BY pos) FROM leaves GROUP BY lang
    UNION ALL
    SELECT lang, h + 1, list_transform(range((len(nodes) + 1) // 2),
        lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM levels WHERE len(nodes) > 1
), subroots AS (
    SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
    FROM levels WHERE len(nodes) = 1
), tops(h, nodes) AS (
    SELECT 0, list(subroot ORDER BY pos) FROM subroots
    UNION ALL
    SELECT h + 1, list_transform(range((len(nodes) + 1) // 2),
        lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM tops WHERE len(nodes) > 1
), root AS (
    SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1
), steps AS (
    SELECT l.lang, l.pos, v.h, (l.pos >> v.h) & 1 AS side, v.nodes[xor(l.pos >> v.h, 1) + 1] AS sibling
    FROM leaves l JOIN levels v ON l.lang IS NOT DISTINCT FROM v.lang WHERE len(v.nodes) > 1
    UNION ALL
    SELECT l.lang, l.pos, 1000 + v.h, (s.pos >> v.h) & 1, v.nodes[xor(s.pos >> v.h, 1) + 1]
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, tops v WHERE len(v.nodes) > 1
), paths AS (
    SELECT lang, pos, list(CASE WHEN sibling IS NULL THEN '-' WHEN side = 1 THEN 'l' || sibling
        ELSE 'r' || sibling END ORDER BY h) AS path, string_agg(sibling, '' ORDER BY h) AS siblings
    FROM steps GROUP BY lang, pos
), climbed AS (
    SELECT l.doc_id, l.leaf, s.subroot, r.root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
        list_reduce(coalesce(p.path, CAST([] AS VARCHAR[])), lambda acc, x: sha256(CASE WHEN x[1] = 'l' THEN x[2:] || acc
            WHEN x[1] = 'r' THEN acc || x[2:] ELSE acc END), coalesce(l.changed, l.leaf)) AS folded_root
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN paths p ON l.lang IS NOT DISTINCT FROM p.lang AND l.pos = p.pos, root r
)
SELECT *, folded_root = root AS verified FROM climbed
"""

SOURCE_MIXING = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM d GROUP BY source
), capped AS (
    SELECT *, 3 * source_size AS most, sum(source_size) OVER () AS total,
        coalesce(sum(3 * source_size) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
        sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shares
    FROM s
), level AS (
    SELECT first((total - full_before)::DOUBLE ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS words,
        first(shares ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS shares
    FROM capped WHERE (total - full_before)::DOUBLE * weight / shares <= most
), t AS (
    SELECT source, source_size,
        CASE WHEN l.words * weight / l.shares > most THEN most::DOUBLE ELSE l.words * weight / l.shares END AS target
    FROM capped, level l
), p AS (
    SELECT doc_id, size, source_size, target,
        CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || doc_id::VARCHAR), doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size,
    floor(target)::BIGINT - whole * source_size - before)))::BIGINT AS taken
FROM p
"""

FILTER_AUDIT = r"""
WITH w AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), f AS (
    SELECT doc_id, part, len(words) < 50 AS A, 100 * len(list_distinct(words)) < 65 * len(words) AS B,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS C,
        regexp_matches(text, '[#$%&*|]') AS D, doc_id > min(doc_id) OVER (PARTITION BY text) AS E
    FROM w
), l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
        max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), n AS (
    SELECT part, MAP {'A': A, 'B': B, 'C': C, 'D': D, 'E': E} AS fails, count(*) AS n,
        coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
), letters(x) AS (
    VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step::INTEGER AS step, filter_order[step] AS x, string_split(filter_order[:step - 1], '') AS earlier,
        list_filter(['A', 'B', 'C', 'D', 'E'], lambda y: y <> filter_order[step]) AS others
    FROM orders, range(1, 6) r(step)
), told AS (
    SELECT *, fails[x] AS own, len(list_filter(earlier, lambda y: coalesce(fails[y], FALSE))) > 0 AS gone,
        len(list_filter(others, lambda y: fails[y])) = 0 AS alone
    FROM n, steps
), sums AS (
    SELECT part, filter_order, step, x,
        coalesce(sum(n) FILTER (WHERE NOT own AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (WHERE own AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (WHERE own AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (WHERE own AND alone), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (WHERE own AND NOT gone), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (WHERE own AND NOT gone), 0)::BIGINT AS toxic_lost
    FROM told GROUP BY part, filter_order, step, x
)
SELECT * EXCLUDE (x), (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM sums
"""
