"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op3_bit_sliced_top_k"] = """
WITH usable AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES["op9_mix_sources"] = r"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighted AS (
  SELECT source, source_size, nth, w, 2.0::DOUBLE * source_size AS cap
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS nth,
               [3.0::DOUBLE, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w
        FROM sizes)),
met AS (
  SELECT *, 1.5::DOUBLE * (SELECT sum(source_size) FROM sizes)
            - coalesce(sum(cap) OVER (ORDER BY cap / w, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         (SELECT sum(w) FROM weighted)
            - coalesce(sum(w) OVER (ORDER BY cap / w, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_w
  FROM weighted),
level AS (SELECT arg_min(rest / rest_w, (cap / w, nth)) AS level FROM met WHERE cap * rest_w > rest * w),
goals AS (
  SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target
  FROM met, level),
dealt AS (
  SELECT r.doc_id, r.size, g.source_size, g.target, r.source,
         CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS copies,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.h) - r.size AS below
  FROM rows r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (copies + CASE WHEN target - copies * source_size > 0
                                   AND 2 * (target - copies * source_size - below) >= size
                                   AND below <= target - copies * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       source
FROM dealt
"""

ORACLES["op2_line_frequency"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '-')) AS content FROM documents),
words AS (SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
triples AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest([w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] FOR k IN range(1, len(w) - 1)]) AS t
  FROM words),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM triples) WHERE n > 1),
covered AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) FROM twice) GROUP BY r),
lines AS (
  SELECT r, source, content, line, lower(regexp_replace(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, source, content, unnest(string_split(text, chr(10))) AS line FROM docs)),
filled AS (SELECT * FROM lines WHERE n > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM filled GROUP BY r),
limits AS (SELECT source, greatest(10, 0.01::DOUBLE * count(DISTINCT content)) AS most FROM docs GROUP BY source),
frequent AS (
  SELECT f.source, norm FROM (SELECT source, norm, count(DISTINCT content) AS n FROM filled GROUP BY ALL) f
  JOIN limits l ON f.source IS NOT DISTINCT FROM l.source WHERE n > most),
gone AS (
  SELECT r, sum(n) AS n FROM filled f JOIN frequent q ON f.source IS NOT DISTINCT FROM q.source AND f.norm = q.norm GROUP BY r),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed_words
  FROM words w LEFT JOIN dup d USING (r) LEFT JOIN covered c USING (r) LEFT JOIN gone g USING (r)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 2 * (n_words - n_removed_words) >= n_words AS kept, n_removed_words
FROM failed
"""

ORACLES["op12_hard_negatives"] = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS nth FROM scored WHERE same)
  WHERE nth <= 5),
ranked AS (
  SELECT anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM positives JOIN scored s USING (anchor_id)
  WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


def _after(node: str, cost: int | str, edit: str) -> str:
    """A node's least (cost, audit) as one text that sorts by both, and an edit more."""
    return f"printf('%012d', CAST({node}[1:12] AS BIGINT) + {cost}) || {node}[13:] || '{edit}'"


_OPENED = f"least(u, {_after('e', 2, 'I')}, {_after('s', 2, 'I')}, {_after('p', 2, 'I')})"
_NONE = "'999999999999'"

# The lattice of edits by dynamic programming, one row a step; e, s, u, p are its places (empty, after s, after u, after u a).
ORACLES["op13_conversation_repair"] = rf"""
WITH RECURSIVE bits AS (
  SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS v, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
dealt AS (
  SELECT g.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(c) AS BIGINT) FOR c IN string_split(key, '')]),
                              lambda a, b: xor(a // 256, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS fate
  FROM given g, crc),
hit AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM dealt WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         left(role, 1) AS i, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM hit),
faults AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                 WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(i) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM placed),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(n) AS n,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
lattice AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '000000000000' AS e, {_NONE} AS s, {_after("'000000000000'", 2, 'I')} AS u, {_after("'000000000000'", 4, 'II')} AS p
  FROM stats
  UNION ALL
  SELECT conv_id, n, e, s, {_OPENED}, least(p, {_after('(' + _OPENED + ')', 2, 'I')})
  FROM (
    SELECT l.conv_id, f.n,
           {_after('l.e', 3, 'D')} AS e,
           least({_after('l.s', 3, 'D')}, CASE WHEN f.i = 's' AND f.ok THEN {_after('l.e', 'f.extra', 'K')} ELSE {_NONE} END) AS s,
           least({_after('l.u', 3, 'D')},
                 CASE WHEN f.ok THEN least({', '.join(_after(x, '2 + f.extra', 'R') for x in ('l.e', 'l.s', 'l.p'))}) ELSE {_NONE} END,
                 CASE WHEN f.ok AND f.i = 'u' THEN least({', '.join(_after(x, 'f.extra', 'K') for x in ('l.e', 'l.s', 'l.p'))}) ELSE {_NONE} END) AS u,
           least({_after('l.p', 3, 'D')}, CASE WHEN f.ok THEN {_after('l.u', '2 + f.extra', 'R')} ELSE {_NONE} END,
                 CASE WHEN f.ok AND f.i = 'a' THEN {_after('l.u', 'f.extra', 'K')} ELSE {_NONE} END) AS p
    FROM lattice l JOIN (SELECT conv_id, n, i, fault NOT IN ('blank', 'duplicate') AS ok, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END AS extra FROM faults) f
      ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.n = l.n + 1)),
solved AS (
  SELECT st.*, least(l.e, l.p)[13:] AS audit, CAST(least(l.e, l.p)[1:12] AS BIGINT) AS cost
  FROM stats st JOIN lattice l ON l.conv_id IS NOT DISTINCT FROM st.conv_id AND l.n = st.n),
edits AS (
  SELECT conv_id, pos, audit[pos] AS edit, length(replace(audit[1:pos], 'I', '')) AS n, length(replace(audit[1:pos], 'D', '')) AS line
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS pos FROM solved)),
written AS (
  SELECT d.conv_id, pos, edit, f.role, f.text, line,
         max(CASE WHEN line = 1 AND edit = 'K' AND f.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY d.conv_id) AS system
  FROM edits d LEFT JOIN faults f ON d.edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.n = d.n),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (line - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS repaired
  FROM written WHERE edit <> 'D' GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN solved v ON o.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN texts x ON o.conv_id IS NOT DISTINCT FROM x.conv_id
"""
