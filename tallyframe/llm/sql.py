"""DuckDB SQL for the operators that SQL can express, on the same tables."""

WORD = r"[^\x20\x09-\x0D]+"

# Escaped turns; -1 is the conversation of control strings that the query adds.
OP1 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
r AS (
  SELECT *, '<|im_start|>' || replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') || chr(10)
    || regexp_replace(text, '<(\\*)\|(im_start|im_end)\|>', '<\1\\|\2|>', 'g') || '<|im_end|>' || chr(10) AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(shown)) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""

OP5 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size,
    md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffled FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
total AS (SELECT sum(source_size) * 3 / 2.0 AS budget FROM s),
p AS (SELECT *, 2.0 * source_size / weight AS ratio,
    coalesce(sum(2 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
    sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s),
dealt AS (SELECT arg_min((budget - caps) / rest, caps) FILTER ((budget - caps) / rest <= ratio) AS per FROM p, total),
goal AS (SELECT source, source_size, least(weight * per, 2.0 * source_size) AS target FROM s, dealt),
q AS (SELECT doc_id, g.source, size, source_size, target, shuffled,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY shuffled ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
c AS (SELECT doc_id, size, shuffled, epoch, CAST(epoch * source_size + sent + size AS DOUBLE) / target AS finish
  FROM q, (VALUES (0), (1)) e(epoch) WHERE size > 0 AND target > 0),
served AS (SELECT *, sum(size) OVER (ORDER BY finish, epoch, shuffled ROWS UNBOUNDED PRECEDING) AS upto FROM c),
taken AS (SELECT doc_id, count(*) AS copies FROM served, total WHERE upto <= budget GROUP BY doc_id)
SELECT q.doc_id, q.size, source_size, target, CAST(q.size * coalesce(copies, 0) AS BIGINT) AS taken
FROM q LEFT JOIN taken USING (doc_id)
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex FROM p),
m AS (SELECT hex, max(page_id) AS top FROM h GROUP BY hex)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM h JOIN m USING (hex)
"""

# Pairs by shared shingles, then the smallest id reachable.
OP8 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS g
  FROM w, unnest(range(1, greatest(len(w) - 1, 2))) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
links AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

OP10 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM t),
x AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM t, unnest(range(1, len(w) + 1)) AS u(i)),
y AS (SELECT doc_id, i, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS twice FROM x),
z AS (SELECT doc_id, twice OR coalesce(lag(twice, 1) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS hit
  FROM y WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, count(*) FILTER (hit) AS n_repeat_words FROM z GROUP BY doc_id),
v AS (SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines FROM m LEFT JOIN r USING (doc_id)),
f AS (SELECT *, CAST((n_words < 50) AS BIGINT) + 2 * CAST((100 * n_repeat_words > 50 * n_words) AS BIGINT)
    + 4 * CAST((100 * n_symbols > 25 * n_words) AS BIGINT) + 8 * CAST((100 * n_dup_lines > 50 * n_lines) AS BIGINT)
    + 16 * CAST((word_chars < 2 * n_words OR word_chars > 20 * n_words) AS BIGINT) AS fail_bits FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM f
"""

def _crc32(code_points: str) -> str:
    """Unsigned crc32 of a list of bytes, with the byte table ``tab`` of CRC_TABLE in scope."""
    return (f"xor(list_reduce([4294967295::BIGINT] || {code_points}, "
            "lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)")


CRC_TABLE = """
crc AS (SELECT list_transform(range(256), lambda x: list_reduce([x] || [0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""

# The cheapest edits of each conversation row by row: the four states' least (cost, audit) and the text so far.
OP11 = rf"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: ord(c)::BIGINT)")} % 20 AS h
  FROM conversations, crc),
r AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
n AS (SELECT *, row_number() OVER w AS i,
    lag(role[1]) OVER w || role[1] AS pair, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS final
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))),
f AS (SELECT *, CASE WHEN final = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
    WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM n),
ins(state, edits, shown, place, cost) AS (VALUES
  (0, '', '', 0, 0), (0, 'I', 'u', 2, 3), (0, 'II', 'ua', 3, 6), (1, '', '', 1, 0), (1, 'I', 'u', 2, 3), (1, 'II', 'ua', 3, 6),
  (2, '', '', 2, 0), (2, 'I', 'a', 3, 3), (3, '', '', 3, 0), (3, 'I', 'u', 2, 3)),
keep(place, initial, next) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
give(place, next) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
edge AS (
  SELECT state, edits || 'D' AS edits, shown, place AS next, cost + 4 AS cost, '' AS initial, 'D' AS edit FROM ins
  UNION ALL SELECT state, edits || 'K', shown, next, cost, initial, 'K' FROM ins JOIN keep USING (place)
  UNION ALL SELECT state, edits || 'R', shown, next, cost + 3, '', 'R' FROM ins JOIN give USING (place)),
p AS (
  SELECT DISTINCT conv_id, 0 AS i, 0 AS state, 0 AS cost, '' AS audit, [] :: VARCHAR[] AS said FROM conversations
  UNION ALL
  SELECT conv_id, i, state, best.cost, best.audit, best.said FROM (
    SELECT f.conv_id, f.i, e.next AS state, min({{'cost': p.cost + e.cost + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 3 ELSE 0 END,
      'audit': p.audit || e.edits, 'said': p.said
        || list_transform(string_split(e.shown, ''), lambda c: CASE c WHEN 'u' THEN 'user:' WHEN 'a' THEN 'assistant:' END)
        || CASE edit WHEN 'K' THEN [f.role || ':' || f.text]
          WHEN 'R' THEN [CASE e.next WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text] ELSE [] END}}) AS best
    FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1 JOIN edge e ON e.state = p.state
      AND (edit = 'D' OR fault IN ('', 'truncated')) AND (edit <> 'K' OR f.role[1] = e.initial)
    GROUP BY f.conv_id, f.i, e.next)),
total AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n_rows,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
done AS (SELECT p.conv_id, min({{'cost': p.cost + e.cost, 'audit': p.audit || e.edits, 'said': p.said
      || list_transform(string_split(e.shown, ''), lambda c: CASE c WHEN 'u' THEN 'user:' WHEN 'a' THEN 'assistant:' END)}}) AS best
  FROM p LEFT JOIN total t ON t.conv_id IS NOT DISTINCT FROM p.conv_id JOIN ins e ON e.state = p.state AND e.place IN (0, 3)
  WHERE p.i = coalesce(n_rows, 0) GROUP BY p.conv_id)
SELECT done.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
  sha256(array_to_string(list_filter(best.said, lambda x: x IS NOT NULL), chr(10))) AS repaired_sha256
FROM done LEFT JOIN total t ON t.conv_id IS NOT DISTINCT FROM done.conv_id
"""

# Near words meet by what is left of them without one letter, or with a mark in its place.
OP12 = rf"""
WITH RECURSIVE {CRC_TABLE},
w AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM documents),
d AS (SELECT doc_id, word, count(*) AS c FROM w WHERE length(word) >= 6 GROUP BY ALL),
h AS (SELECT word, c, {_crc32("""flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || word, ''),
    lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, ord(x)::BIGINT - 64] END))""")} AS h FROM d, crc),
s AS (SELECT c, CASE WHEN h % 199 = 0 THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2) ELSE word END AS word FROM h),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM s WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
p AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
near AS (
  SELECT x.word, y.word AS other, y.n FROM p x JOIN p y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT v.word, p.word, p.n FROM v JOIN p ON v.word = p.a || p.b
  UNION SELECT p.word, v.word, v.n FROM v JOIN p ON v.word = p.a || p.b),
best AS (SELECT word, count(*) AS n_near, min({{'less': -n, 'other': other}}) AS top FROM near GROUP BY word),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.less >= 5 * n THEN top.other END AS form,
    CASE WHEN -top.less >= 5 * n THEN -top.less END AS form_n FROM v LEFT JOIN best USING (word)),
r AS (SELECT word, word AS root FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.root WHERE form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN r ON r.word = f.word JOIN f g ON g.word = r.root AND g.form IS NULL
"""

SQL = {"op1_chat_format": OP1, "op5_fair_mix": OP5, "op7_warc": OP7, "op8_near_dedup": OP8, "op10_quality_rules": OP10,
       "op11_turn_repair": OP11, "op12_spelling_variants": OP12}
