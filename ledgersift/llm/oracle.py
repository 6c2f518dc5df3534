"""DuckDB SQL for the queries that SQL can express."""

ORACLE = {}

ORACLE["op1_line_dedup"] = r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS k
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM split
), common AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT doc_id, k, line, last IS NOT NULL AND doc_id <> last AS gone
    FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE["op4_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
    SELECT *,
        replace(replace(replace(replace(role, '\', '\\'), '<turn>', '<\turn>'), '</turn>', '<\/turn>'), '<|endoftext|>', '<\|endoftext|>') AS role_e,
        replace(replace(replace(replace(text, '\', '\\'), '<turn>', '<\turn>'), '</turn>', '<\/turn>'), '<|endoftext|>', '<\|endoftext|>') AS text_e
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(15 + length(replace(role_e, chr(10), '\' || chr(10))) + length(text_e)) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

ORACLE["op5_substring_dedup"] = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
    SELECT doc_id, w, unnest(range(len(w) - 49)) AS k FROM words WHERE len(w) >= 50
), windows AS (
    SELECT doc_id, k, md5(array_to_string(list_slice(w, k + 1, k + 50), ' ')) AS h FROM starts
), firsts AS (
    SELECT h, min(doc_id) AS lowest FROM windows GROUP BY h HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, k + j AS k
    FROM windows JOIN firsts USING (h), unnest(range(50)) AS u(j) WHERE lowest < doc_id
), flat AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS k FROM words
), marked AS (
    SELECT flat.*, gone.k IS NOT NULL AS out FROM flat LEFT JOIN gone USING (doc_id, k)
), kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (out) AS n_removed,
           coalesce(string_agg(word, ' ' ORDER BY k) FILTER (NOT out), '') AS left_over
    FROM marked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

ORACLE["op10_suffix_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), starts AS (
    SELECT doc_id, x, unnest(range(length(x) // 2 - 399)) AS k FROM texts WHERE length(x) >= 800
), windows AS (
    SELECT doc_id, k, md5(substr(x, 2 * k + 1, 800)) AS h FROM starts
), twice AS (
    SELECT h FROM windows GROUP BY h HAVING count(*) > 1
), hit AS (
    SELECT doc_id, k, k > lag(k, 1, -401) OVER w + 400 AS new FROM windows SEMI JOIN twice USING (h) WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), spans AS (
    SELECT doc_id, min(k) AS a, max(k) + 400 AS b
    FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY k) AS g FROM hit) GROUP BY doc_id, g
), gaps AS (
    SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS last FROM spans
), cut AS (
    SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS final,
           string_agg(substr(x, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS head
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(final, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""

ORACLE["op3_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), starts AS (
    SELECT doc_id, w, unnest(range(greatest(len(w) - 3, 1))) AS k FROM words WHERE len(w) > 0
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, k + 1, k + 4), ' ') AS g FROM starts
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), met AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
    FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM met JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * o >= 85 * (s.n + t.n - o)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
FROM documents LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

ORACLE["op6_embedding_dedup"] = r"""
WITH RECURSIVE usable AS (
    SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), roots AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

ORACLE["op11_prefix_trie"] = r"""
WITH turns AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
           md5(strlen(role) || ':' || role || text) AS g, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), ids AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base,
           xor(list_reduce([ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')],
               lambda acc, b: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(acc, b)), 4294967295), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT ids.conv_id, 0 AS k, p, g, w FROM ids JOIN turns ON turns.conv_id = base AND p <= h
    UNION ALL SELECT ids.conv_id, 1, p, g, w FROM ids JOIN turns ON turns.conv_id = ids.conv_id AND p > h
), placed AS (
    SELECT conv_id, g, w, row_number() OVER (PARTITION BY conv_id ORDER BY k, p) AS depth FROM rebuilt
), openings AS (
    SELECT conv_id, depth, w, string_agg(g, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM placed
    UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), nodes AS (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS saved FROM openings GROUP BY key, depth
), ends AS (
    SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS who
    FROM (SELECT conv_id, arg_max(key, depth) AS key FROM openings GROUP BY conv_id) GROUP BY key
), kids AS (
    SELECT left(key, 32 * (depth - 1)) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), totals AS (
    SELECT left(key, 32 * d) AS key, sum(leaf) AS n_leaves, sum(saved) AS saved
    FROM (SELECT key, saved, (n IS NULL)::INT AS leaf, unnest(range(depth + 1)) AS d FROM nodes LEFT JOIN kids USING (key)) GROUP BY 1
)
SELECT nodes.conv_id, nodes.depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(totals.saved AS BIGINT) AS saved_tokens, sha256(coalesce(who, '')) AS ends_sha256
FROM nodes JOIN totals USING (key) LEFT JOIN kids USING (key) LEFT JOIN ends USING (key)
LEFT JOIN nodes up ON nodes.depth > 0 AND up.key = left(nodes.key, 32 * (nodes.depth - 1))
"""
