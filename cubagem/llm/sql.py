"""The registered queries as SQL, where SQL can express them."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
    SELECT *, row_number() OVER w AS nth, count(*) OVER (PARTITION BY conv_id) AS n,
        sum(length('<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')
            || '<|im_end|>' || chr(10))) OVER w AS so_far
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(so_far) FILTER (role = 'assistant' OR nth = n)::BIGINT AS formatted_chars,
    count(*) FILTER (role = 'assistant' OR nth = n) AS n_examples
FROM placed GROUP BY conv_id
"""

ORACLE_SQL["op5_mix_sources"] = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, 3 * source_size AS bound,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM sources
), summed AS (
    SELECT *, bound / weight AS fills_at, sum(source_size) OVER () AS total,
        coalesce(sum(bound) OVER w, 0) AS bound_before,
        sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS sharing
    FROM weighed WINDOW w AS (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT (total - bound_before)::DOUBLE AS rest, sharing AS shared FROM summed
    WHERE (total - bound_before)::DOUBLE / sharing <= fills_at ORDER BY fills_at, source NULLS LAST LIMIT 1
), targets AS (
    SELECT source, source_size, least(bound::DOUBLE, rest * weight::DOUBLE / shared::DOUBLE) AS target FROM summed, level
), rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0 END AS rate FROM targets
), drawn AS (
    SELECT s.doc_id, s.source, s.size, r.source_size, r.target, floor(r.rate)::BIGINT
        + (('0x' || md5('mix:' || coalesce(s.doc_id::VARCHAR, ''))[1:8])::BIGINT / 4294967296.0::DOUBLE
            < r.rate - floor(r.rate))::BIGINT AS copies
    FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM drawn
"""

WORDS = r"""
words AS (
    SELECT doc_id, text, regexp_extract_all({}, '[^\x20\x09-\x0D]+') AS w FROM documents
)"""

ORACLE_SQL["op1_ngram_join"] = (
    "WITH RECURSIVE "
    + WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    + """, shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT o.a, o.b FROM shared o JOIN sizes x ON x.doc_id = o.a JOIN sizes y ON y.doc_id = o.b
    WHERE 100 * o.n >= 75 * (x.n + y.n - o.n)
), reached AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reached r ON r.a = d.doc_id
GROUP BY d.doc_id
"""
)

ORACLE_SQL["op6_substring_dedup"] = (
    "WITH "
    + WORDS.format("coalesce(text, '')")
    + """, windows AS (
    SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), repeated AS (
    SELECT doc_id, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), removed AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM repeated
), placed AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), kept AS (
    SELECT p.doc_id, count(*) AS n, string_agg(p.word, ' ' ORDER BY p.i) AS t
    FROM placed p LEFT JOIN removed r ON r.doc_id = p.doc_id AND r.i = p.i WHERE r.i IS NULL GROUP BY p.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
)

#: One step of CRC-32 for a bit: the polynomial is fixed.
_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

ORACLE_SQL["op7_shard"] = f"""
WITH RECURSIVE bits AS (
    SELECT range AS byte, range AS c, 0 AS n FROM range(256)
    UNION ALL SELECT byte, {_BIT}, n + 1 FROM bits WHERE n < 8
), steps AS (
    SELECT list(c ORDER BY byte) AS step FROM bits WHERE n = 8
), sized AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
        xor(4294967295, list_reduce(
            list_concat([4294967295::BIGINT], list_transform(
                regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
            lambda c, b: xor(c >> 8, step[1 + (xor(c, b) & 255)]))) AS text_crc32
    FROM documents, steps
), placed AS (
    SELECT *, sum(size) OVER w - size AS before, sum(size) OVER () AS total FROM sized
    WINDOW w AS (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING)
), sharded AS (
    SELECT *, (before * 16 // total)::INT AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, NULL::INT AS grown_shard
FROM sharded
"""

ORACLE_SQL["op11_prefix_trie"] = r"""
WITH steps AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
        ORDER BY i) AS step FROM (SELECT unnest(range(256))::BIGINT AS i)
), own AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS nth
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 5 AS base, count(*) AS n, xor(4294967295, list_reduce(
        [4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
        lambda s, b: xor(s >> 8, any_value(step)[1 + (xor(s, b) & 255)]))) % 9 AS h
    FROM own, steps GROUP BY c
), placed AS (
    SELECT v.c, o.nth AS pos, o.role, o.text FROM convs v JOIN own o ON o.c = v.base AND o.nth <= v.h
    UNION ALL
    SELECT v.c, o.nth - v.h + least(v.h, coalesce(b.n, 0)), o.role, o.text
    FROM convs v JOIN own o ON o.c = v.c AND o.nth > v.h LEFT JOIN convs b ON b.c = v.base
), paths AS (
    SELECT c, pos AS depth, octet_length(encode(text)) AS bytes,
        string_agg(sha256(length(role) || ' ' || role || text), ',') OVER (PARTITION BY c ORDER BY pos) AS key
    FROM placed UNION ALL SELECT c, 0, 0, '' FROM convs
), ended AS (
    SELECT *, depth = max(depth) OVER (PARTITION BY c) AS last FROM paths
), nodes AS (
    SELECT key, depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
    FROM ended GROUP BY key, depth
), kept AS (
    SELECT *, left(key, greatest(65 * depth - 66, 0)) AS parent FROM nodes
), children AS (
    SELECT parent AS key, count(*) AS n FROM kept WHERE depth > 0 GROUP BY parent
), full_nodes AS (
    SELECT k.*, coalesce(ch.n, 0) AS n_children, p.conv_id AS parent_conv_id
    FROM kept k LEFT JOIN children ch USING (key) LEFT JOIN kept p ON k.depth > 0 AND p.key = k.parent
)
SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children,
    count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens, a.ends_sha256
FROM full_nodes a JOIN full_nodes b ON b.depth >= a.depth AND starts_with(b.key, a.key)
GROUP BY ALL
"""

# The main text of pages that mark it as an article, as the given ones do; block tags are spaces, inline ones nothing.
ORACLE_SQL["op13_extract_text"] = r"""
WITH marked AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS body FROM pages
), bare AS (
    SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(
        body, '<[^>]*$', ''), '</?(a|b|i|em|strong|span)( [^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g') AS body FROM marked
), decoded AS (
    SELECT page_id, url, regexp_replace(replace(replace(replace(body, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS body
    FROM bare
), spaced AS (
    SELECT page_id, url, trim(regexp_replace(body, '\s+', ' ', 'g')) AS text FROM decoded
)
SELECT page_id, url, text, length(text) AS n_chars FROM spaced
"""
