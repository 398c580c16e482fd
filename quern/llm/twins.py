"""SQL twins of the queries that SQL can express."""

# The measures, floors, fence and least number of documents are those of ``quality``.
QUALITY = r"""
WITH doc AS (
    SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), cut AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           [x FOR x IN string_split(text, chr(10)) IF trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''] AS lines
    FROM doc
), windows AS (
    SELECT row_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
    FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS i FROM cut)
), again AS (
    SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT row_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS place FROM again) GROUP BY row_id
), counts AS (
    SELECT cut.row_id, doc_id, lang, source, len(words)::BIGINT AS n_words,
           length(array_to_string(words, ''))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM cut LEFT JOIN covered USING (row_id)
), failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
), measured AS (
    SELECT row_id, lang, source, base_failed, 'symbol_share' AS measure, n_symbols * 1000 // nullif(word_chars, 0) AS value FROM failed
    UNION ALL SELECT row_id, lang, source, base_failed, 'dup_line_share', n_dup_lines * 1000 // nullif(n_lines, 0) FROM failed
    UNION ALL SELECT row_id, lang, source, base_failed, 'repeat_share', n_repeat_words * 1000 // nullif(n_words, 0) FROM failed
    UNION ALL SELECT row_id, lang, source, base_failed, 'word_length', word_chars * 100 // nullif(n_words, 0) FROM failed
), sketch AS (
    SELECT lang, source, measure, value - value % (1::BIGINT << greatest(length(bin(value)) - 10, 0)::BIGINT) AS bucket, count(*) AS n
    FROM measured WHERE NOT base_failed AND value IS NOT NULL GROUP BY ALL
), levels AS (
    SELECT 0 AS level, lang, source, measure, bucket, n FROM sketch
    UNION ALL SELECT 1, lang, NULL, measure, bucket, sum(n) FROM sketch GROUP BY lang, measure, bucket
    UNION ALL SELECT 2, NULL, NULL, measure, bucket, sum(n) FROM sketch GROUP BY measure, bucket
), run AS (
    SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS upto,
           sum(n) OVER (PARTITION BY level, lang, source, measure) AS total
    FROM levels
), quartile AS (
    SELECT level, lang, source, measure, max(total) AS n, min(bucket) FILTER (WHERE upto * 4 >= total) AS q25,
           min(bucket) FILTER (WHERE upto * 4 >= total * 3) AS q75
    FROM run GROUP BY level, lang, source, measure
), picked AS (
    SELECT a.lang, a.source, a.measure,
           CASE WHEN a.n >= 100 THEN a.q25 WHEN b.n >= 100 THEN b.q25 ELSE c.q25 END AS q25,
           CASE WHEN a.n >= 100 THEN a.q75 WHEN b.n >= 100 THEN b.q75 ELSE c.q75 END AS q75,
           CASE a.measure WHEN 'symbol_share' THEN 10 WHEN 'dup_line_share' THEN 150 WHEN 'repeat_share' THEN 100 ELSE 60 END AS least
    FROM quartile a
    JOIN quartile b ON b.level = 1 AND a.lang IS NOT DISTINCT FROM b.lang AND a.measure = b.measure
    JOIN quartile c ON c.level = 2 AND a.measure = c.measure
    WHERE a.level = 0
), outside AS (
    SELECT DISTINCT m.row_id FROM measured m
    JOIN picked p ON m.lang IS NOT DISTINCT FROM p.lang AND m.source IS NOT DISTINCT FROM p.source AND m.measure = p.measure
    WHERE m.value < p.q25 - 3 * greatest(p.q75 - p.q25, p.least) OR m.value > p.q75 + 3 * greatest(p.q75 - p.q25, p.least)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND row_id NOT IN (SELECT row_id FROM outside) AS kept
FROM failed
"""

VECTORS = r"""
WITH RECURSIVE ready AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM ready a JOIN ready b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
    SELECT DISTINCT a, a AS b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), linked AS (
    SELECT a, count(*) AS n_links FROM link GROUP BY a
), least AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN linked ON vec_id = linked.a LEFT JOIN least ON vec_id = least.a
"""

HARD_NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), met AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), near AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM met WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT near.anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM near JOIN met ON met.anchor_id = near.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY near.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER best <= 5
"""

# crc32 bit by bit; a prefix is the list of its turns' digests.
PREFIXES = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS source,
           xor(list_reduce([4294967295::BIGINT] || [ascii(s)::BIGINT FOR s IN string_split(conv_id::VARCHAR, '')],
               lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, k: xor(r // 2, 3988292384 * (r % 2)))),
               4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN turns t ON t.conv_id = source AND pos <= h
    UNION ALL SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND pos > h
), strings AS (
    SELECT conv_id, coalesce(list(md5(md5(role) || md5(text)) ORDER BY part, pos) FILTER (pos IS NOT NULL), []) AS keys,
           list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY part, pos) AS words
    FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
), cut AS (
    SELECT conv_id, keys[:depth] AS prefix, depth, len(keys) AS turns, CASE WHEN depth > 0 THEN words[depth] ELSE 0 END AS words
    FROM (SELECT *, unnest(range(0, len(keys) + 1)) AS depth FROM strings)
), nodes AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '')) AS ends_sha256
    FROM cut GROUP BY prefix, depth
), kids AS (
    SELECT prefix[:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), full_nodes AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (prefix)
), below AS (
    SELECT prefix[:up] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM full_nodes) GROUP BY ALL
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below USING (prefix) LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = n.prefix[:n.depth - 1] AND p.depth = n.depth - 1
"""
