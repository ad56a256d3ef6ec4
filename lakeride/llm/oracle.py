"""DuckDB statements of the training-data queries that SQL can express (``op9`` has its own beside its query)."""

from __future__ import annotations

#: the 256 entries of the crc32 table, from its polynomial
_CRC_TABLE = """(SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS entries)"""


def _number(hex_digits: str, digits: str) -> str:
    return f"list_reduce(string_split({hex_digits}, ''), lambda a, x: 16 * a + instr('{digits}', x) - 1, 0::BIGINT)"


def _crc32(word: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes; ``entries`` is the table."""
    h = f"hex(encode({word}))"
    digit = "instr('0123456789ABCDEF', substr({h}, i{more}, 1)) - 1"
    byte = f"16 * ({digit.format(h=h, more='')}) + {digit.format(h=h, more=' + 1')}"
    return (f"xor(list_reduce(list_transform(range(1, CAST(length({h}) AS BIGINT), 2), lambda i: {byte}), "
            "lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)")


SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

OP11 = f"""
WITH RECURSIVE crc AS {_CRC_TABLE},
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
fated AS (SELECT named.*, {_crc32('key')} % 20 AS fate FROM named, crc),
damaged AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fated, range(2) AS copies(k) WHERE fate <> 0 AND (k = 0 OR fate = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, rtrim(text, {SPACES}) AS shown,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM placed),
judged AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN shown = '' THEN 'blank' WHEN again THEN 'duplicate'
            WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM seen),
inserts(state, ins, turns, mid) AS (VALUES
  (0, '', []::VARCHAR[], 0), (0, 'I', ['user:'], 2), (0, 'II', ['user:', 'assistant:'], 3),
  (1, '', []::VARCHAR[], 1), (1, 'I', ['user:'], 2), (1, 'II', ['user:', 'assistant:'], 3),
  (2, '', []::VARCHAR[], 2), (2, 'I', ['assistant:'], 3), (3, '', []::VARCHAR[], 3), (3, 'I', ['user:'], 2)),
edits AS (
  SELECT conv_id, i, 'D' AS edit, 3 AS price, mid, mid AS state, []::VARCHAR[] AS line FROM judged, range(4) AS m(mid)
  UNION ALL SELECT conv_id, i, 'K', CASE fault WHEN 'truncated' THEN 1 ELSE 0 END, mid,
                   CASE WHEN initial = 's' THEN 1 WHEN initial = 'u' THEN 2 ELSE 3 END, [role || ':' || text]
    FROM judged, range(4) AS m(mid) WHERE fault IN ('none', 'truncated') AND (mid, initial) IN ((0, 's'), (0, 'u'), (1, 'u'), (2, 'a'), (3, 'u'))
  UNION ALL SELECT conv_id, i, 'R', CASE fault WHEN 'truncated' THEN 3 ELSE 2 END, mid, CASE mid WHEN 2 THEN 3 ELSE 2 END,
                   [CASE mid WHEN 2 THEN 'assistant:' ELSE 'user:' END || text]
    FROM judged, range(4) AS m(mid) WHERE fault IN ('none', 'truncated')),
paths AS (
  SELECT conv_id, 0::BIGINT AS i, 0::BIGINT AS state, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS best
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT p.conv_id, p.i + 1, CAST(e.state AS BIGINT),
         min({{'cost': CAST(p.best.cost + 2 * length(n.ins) + e.price AS BIGINT), 'audit': p.best.audit || n.ins || e.edit,
               'lines': list_concat(list_concat(p.best.lines, n.turns), e.line)}})
  FROM paths p JOIN inserts n ON n.state = p.state
       JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.mid = n.mid
  GROUP BY p.conv_id, p.i + 1, e.state),
ends AS (
  SELECT p.conv_id, min({{'cost': p.best.cost + 2 * length(t.ins), 'audit': p.best.audit || t.ins, 'lines': list_concat(p.best.lines, t.turns)}}) AS best
  FROM paths p JOIN (VALUES (0, '', []::VARCHAR[]), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', []::VARCHAR[]))
       AS t(state, ins, turns) ON t.state = p.state
  WHERE p.i = (SELECT count(*) FROM judged j WHERE j.conv_id IS NOT DISTINCT FROM p.conv_id) GROUP BY p.conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(e.best.cost AS BIGINT) AS cost, e.best.audit AS audit,
       sha256(array_to_string(e.best.lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP12 = f"""
WITH crc AS {_CRC_TABLE},
d AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS words FROM documents),
dw AS (SELECT doc_id, unnest(words) AS w FROM d),
bw AS (SELECT unnest({_WORDS.format(text=_LOWER)}) AS w FROM benchmark),
b AS (SELECT w, {_crc32('w')} % 10000 AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN b USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN b USING (w) GROUP BY bucket),
g AS (SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)
                                     / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, sum(gain) AS weight FROM dw JOIN b USING (w) JOIN g USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(words) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(({_number("substr(sha256('2024:' || d.doc_id), 1, 8)", '0123456789abcdef')} + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, n_features AS n_words, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN place END AS rank
FROM placed"""

OP13 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
k AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13),
h AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 12], ' ')) AS win FROM k),
f AS (SELECT win, min(doc_id) AS least FROM h GROUP BY win),
gone AS (SELECT DISTINCT doc_id, i + j AS pos FROM h JOIN f USING (win), range(13) AS r(j) WHERE least < doc_id),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""
