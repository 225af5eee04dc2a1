"""The queries' results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

# Both sides of the check state the escapes, words and rules on their own.
OP1 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t
  FROM conversations
  UNION ALL SELECT * FROM (VALUES
    (-7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'),
    (-7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'))
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, r NULLS FIRST, t NULLS FIRST) AS n,
    regexp_replace(replace(role, '\', '\\'),
      '(<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|endoftext\|>)',
      '+\1', 'g') AS er,
    regexp_replace(replace(text, '\', '\\'),
      '(<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|endoftext\|>)',
      '+\1', 'g') AS et
  FROM rows WHERE conv_id IS NOT NULL
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(er) + 10 + length(et) + 10) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

OP2 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(CAST(len(w) AS BIGINT) - 1, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach AS (
  SELECT doc_id, doc_id AS root FROM d
  UNION SELECT links.b, reach.root FROM reach JOIN links ON reach.doc_id = links.a
), least AS (
  SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id,
  d.doc_id = component_id AS kept
FROM d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP3 = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (
  SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm)
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>{}]', '', 'g')) AS symbols
  FROM documents
), keyed AS (
  SELECT *, -ln((CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE)
    / (1::DOUBLE / (1::DOUBLE + 4::DOUBLE * symbols / greatest(size, 1))) AS k
  FROM d
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2::DOUBLE * sum(size) AS most FROM d GROUP BY source
), weighed AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w FROM sources
), steps AS (
  -- With the sources that fill up first taken as full, what one unit of weight gets in the rest.
  SELECT *, most / w AS full_at,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))
      / sum(w) OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
  WINDOW before AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), scale AS (
  SELECT coalesce(arg_min(level, full_at) FILTER (WHERE level <= full_at), max(full_at)) AS unit FROM steps
), targets AS (
  SELECT source, source_size, least(most, w * unit) AS target,
    CASE WHEN source_size > 0 THEN floor(least(most, w * unit) / source_size) ELSE 0 END AS epochs
  FROM weighed, scale
), placed AS (
  SELECT keyed.*, source_size, target, epochs,
    coalesce(sum(size) OVER (PARTITION BY keyed.source ORDER BY k, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed JOIN targets ON keyed.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  CAST(size * (epochs + CASE WHEN size > 0 AND before + size / 2::DOUBLE <= target - epochs * source_size
    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

OP9 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT k, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT k, w, unnest(range(1, CAST(len(w) AS BIGINT) - 1)) AS i FROM d WHERE len(w) >= 3)
), hit AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM hit) GROUP BY k
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(list_aggregate(list_concat([''], w), 'string_agg', '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (k)
), f AS (
  SELECT *,
    CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN n_lines >= 10 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 30 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed
FROM f
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, list_filter(
    string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, CAST(len(w) AS BIGINT) - 18)) AS i FROM d WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM windows)
  WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM later)
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, CAST(len(w) AS BIGINT) + 1)) AS j FROM d) words
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = words.doc_id AND gone.j = words.j)
  GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP11 = r"""
WITH RECURSIVE given AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), crc AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS hit
  FROM given
), rows AS (
  SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE hit WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM crc WHERE hit <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM rows
), judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM numbered
), convs AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), moves AS (
  -- From the last kept role (0 none, s, u, a): up to two inserted rows before the next edit.
  SELECT * FROM (VALUES ('0', '0', '', 0), ('s', 's', '', 0), ('u', 'u', '', 0), ('a', 'a', '', 0),
    ('0', 'u', 'I', 5), ('s', 'u', 'I', 5), ('a', 'u', 'I', 5), ('u', 'a', 'I', 5),
    ('0', 'a', 'II', 10), ('s', 'a', 'II', 10), ('u', 'u', 'II', 10), ('a', 'a', 'II', 10)
  ) m(st, mid, ins, paid)
), steps AS (
  SELECT conv_id, i, m.mid, e.* FROM judged,
    (VALUES ('0'), ('s'), ('u'), ('a')) m(mid),
    LATERAL (SELECT CASE m.mid WHEN 'u' THEN 'a' ELSE 'u' END AS want) w,
    LATERAL (
      SELECT m.mid AS st2, 'D' AS edit, 2 AS fee
      UNION ALL SELECT c, 'K', CASE fault WHEN 'truncated' THEN 5 ELSE 0 END
        WHERE fault IN ('none', 'truncated') AND (c = want OR (c = 's' AND m.mid = '0'))
      UNION ALL SELECT want, 'R', CASE fault WHEN 'truncated' THEN 6 ELSE 1 END
        WHERE fault IN ('none', 'truncated') AND c <> want
    ) e
), best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '0' AS st, CAST(0 AS BIGINT) AS cost, '' AS audit FROM convs
  UNION ALL
  SELECT conv_id, i, st, cost, audit FROM (
    SELECT b.conv_id, s.i, s.st2 AS st, b.cost + paid + fee AS cost, b.audit || ins || edit AS audit,
      row_number() OVER (PARTITION BY b.conv_id, s.st2 ORDER BY b.cost + paid + fee, b.audit || ins || edit) AS n
    FROM best b JOIN moves m ON m.st = b.st
    JOIN steps s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i + 1 AND s.mid = m.mid
  ) WHERE n = 1
), ended AS (
  SELECT b.conv_id, b.cost + paid AS cost, audit || ins AS audit,
    row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + paid, audit || ins) AS n
  FROM best b JOIN moves m ON m.st = b.st JOIN convs c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
  WHERE b.i = c.n AND m.mid IN ('0', 'a')
), ops AS (
  SELECT conv_id, j, audit[j] AS edit, count(*) FILTER (audit[j] <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM ended WHERE n = 1)
), kept AS (
  SELECT o.conv_id, o.j, o.edit, r.role, CASE o.edit WHEN 'I' THEN '' ELSE r.text END AS text,
    row_number() OVER (PARTITION BY o.conv_id ORDER BY o.j) AS p
  FROM ops o LEFT JOIN judged r ON r.conv_id IS NOT DISTINCT FROM o.conv_id AND r.i = o.i AND o.edit <> 'I'
  WHERE o.edit <> 'D'
), shifted AS (
  SELECT *, p - count(*) FILTER (p = 1 AND edit = 'K' AND left(role, 1) = 's') OVER (PARTITION BY conv_id) AS q FROM kept
), lines AS (
  SELECT conv_id, string_agg(
    CASE WHEN edit = 'K' THEN role WHEN q % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY j) AS whole
  FROM shifted GROUP BY conv_id
)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(e.cost, 0) AS BIGINT) AS cost, coalesce(e.audit, '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN convs c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM g.conv_id AND e.n = 1
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM g.conv_id
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT k, lang, source, unnest(w) AS term FROM d
), l AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 30
), v AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM l GROUP BY ALL
), c AS (
  SELECT t.lang, source, t.term, count(*) AS n FROM t JOIN l ON t.lang = l.lang AND t.term = l.term GROUP BY ALL
), g AS (
  SELECT a.lang, a.source, coalesce(v.v, 0) AS v, coalesce(v.n, 0) AS ln, coalesce(s.n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) a LEFT JOIN v ON a.lang = v.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s ON a.lang = s.lang AND a.source = s.source
), p AS (
  SELECT g.lang, g.source, l.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.n + 5 * g.v) AS p,
    1 + 1000000000::HUGEINT * (l.n + 5) // (g.ln + 5 * g.v) AS q
  FROM g JOIN l ON g.lang = l.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = l.term
), f AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS f
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q
), o AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM r
)
SELECT * FROM o WHERE part = 'pair' OR rank <= 50
"""


def statements() -> dict[str, str]:
    return {
        "op1_chat_format": OP1,
        "op2_minhash_near_dedup": OP2,
        "op3_exact_dedup": OP3,
        "op8_mixing": OP8,
        "op9_quality_rules": OP9,
        "op10_substring_dedup": OP10,
        "op11_conversation_repair": OP11,
        "op13_source_divergence": OP13,
    }
