"""DuckDB SQL for the rows of queries that SQL can express."""

from pitpanel.llm import licenses, linededup, secrets, warc


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_scans() -> str:
    """Rules by regular expression over the same normalised words; suppression pair by pair instead of a sweep."""
    rules = ",\n".join(
        f"({k}, {_quoted(label)}, {level}, {_quoted(a)}, {_quoted(b)}, {_quoted(pattern)})"
        for k, (label, level, a, b, pattern) in enumerate(licenses.rules()))
    base = " UNION ALL ".join(
        f"SELECT doc_id, k, {_quoted(label)} AS label, i - 1 AS first FROM words, range(1, len(w)) t(i) WHERE "
        + " AND ".join(f"w[i + {n}] = {_quoted(word)}" for n, word in enumerate(phrase.split()))
        for phrase, label in licenses.BASE.items())
    score = "CASE max(level) " + " ".join(f"WHEN {level} THEN {value}" for level, value in licenses.SCORE.items()) + " END"
    return rf"""
WITH rules(rule, label, level, a, b, pattern) AS (VALUES {rules}),
words AS (
  SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM documents),
base AS ({base}),
found AS (
  SELECT k, rule, label, level, string_split_regex(s, pattern) AS gaps, regexp_extract_all(s, pattern) AS hits
  FROM (SELECT k, w, ' ' || array_to_string(w, '  ') || ' ' AS s FROM words) JOIN rules ON list_contains(w, a) AND list_contains(w, b)
  WHERE regexp_matches(s, pattern)),
places AS (
  SELECT k, rule, label, level,
    list_sum(list_transform(gaps[1:i], lambda x: length(x) - length(replace(x, ' ', ''))))
      + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x) - length(replace(x, ' ', '')))), 0) AS pos,
    length(hits[i]) - length(replace(hits[i], ' ', '')) AS size
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found)),
spans AS (SELECT k, rule, label, level, pos // 2 AS first, (pos + size) // 2 - 1 AS last FROM places),
kept AS (
  SELECT * FROM spans d WHERE NOT EXISTS (
    SELECT 1 FROM spans e WHERE e.k = d.k AND e.first <= d.first AND e.last >= d.last
      AND (e.level > d.level OR e.level = d.level AND (e.first < d.first OR e.last > d.last OR e.rule < d.rule)))),
b AS (SELECT k, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word, list(DISTINCT label) AS labels FROM base GROUP BY k),
m AS (SELECT k, list(DISTINCT label) AS labels, {score} AS score FROM kept GROUP BY k)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM words LEFT JOIN b ON words.k = b.k LEFT JOIN m ON words.k = m.k
"""


LINE_DEDUP = rf"""
WITH raw AS (SELECT doc_id, string_split(text, chr(10)) AS lines, text FROM documents),
pieces AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS raw, unnest(lines) AS line FROM raw),
seq AS (
  SELECT doc_id, raw, trim(line, chr(32) || chr(9) || chr(13)) AS line, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS pos
  FROM pieces WHERE trim(line, chr(32) || chr(9) || chr(13)) <> ''),
sized AS (SELECT *, len(string_split_regex(line, '[ \t\r]+')) AS words FROM seq),
repeated AS (SELECT line, row_number() OVER () AS number FROM seq GROUP BY line HAVING count(*) > 1),
islands AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM sized JOIN repeated USING (line)),
sums AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, island ORDER BY pos) AS after, sum(words) OVER (PARTITION BY doc_id, island) AS total FROM islands),
bounds AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, island ORDER BY after - words RANGE BETWEEN CURRENT ROW AND {linededup.MIN_WORDS - 1} FOLLOWING) AS ahead,
    count(*) OVER (PARTITION BY doc_id, island ORDER BY after RANGE BETWEEN {linededup.MIN_WORDS - 1} PRECEDING AND CURRENT ROW) AS behind
  FROM sums),
runs AS (
  SELECT doc_id, pos AS start, ahead AS n FROM bounds WHERE total - (after - words) >= {linededup.MIN_WORDS}
  UNION SELECT doc_id, pos - behind + 1, behind FROM bounds WHERE after >= {linededup.MIN_WORDS}),
content AS (
  SELECT r.doc_id, r.start, r.n, list(i.number ORDER BY i.pos) AS what
  FROM runs r JOIN islands i ON i.doc_id = r.doc_id AND i.pos BETWEEN r.start AND r.start + r.n - 1 GROUP BY ALL),
later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY what ORDER BY doc_id, start) AS copy FROM content) WHERE copy > 1),
gone AS (SELECT DISTINCT s.doc_id, s.raw FROM later l JOIN seq s ON s.doc_id = l.doc_id AND s.pos BETWEEN l.start AND l.start + l.n - 1),
figures AS (SELECT doc_id, count(*) AS n_lines FROM seq GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
left_over AS (
  SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.raw) AS text
  FROM pieces p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.raw = g.raw WHERE g.raw IS NULL GROUP BY p.doc_id)
SELECT raw.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN n_removed IS NULL THEN raw.text ELSE coalesce(left_over.text, '') END) AS text_sha256
FROM raw LEFT JOIN figures USING (doc_id) LEFT JOIN removed USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

WARC = f"""
WITH rows AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size, sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT *, CASE WHEN size >= {warc.REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY digest) END AS original FROM rows)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM firsts
"""

def _plus(value: str, cost: str, edit: str) -> str:
    """A value is the cost in twelve digits, then the audit, so that the least value is the cheapest and ASCII-least."""
    return f"lpad((left({value}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({value}, 13) || '{edit}'"


def conversation_repair() -> str:
    """Row after row with the least value for each state of the pattern, instead of intervals."""
    kept = lambda letter, froms: ", ".join(f"CASE WHEN letter = '{letter}' THEN {_plus(v, 'cut', 'K')} END" for v in froms)
    made = lambda froms: ", ".join(f"CASE WHEN letter <> '-' THEN {_plus(v, '2 + cut', 'R')} END" for v in froms)
    gone = {k: _plus(f"v{k}", "3", "D") for k in range(4)}
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (
  SELECT keyed.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: unicode(substr(k, i, 1))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n,
    trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS initial, left(lag(role) OVER (PARTITION BY conv_id ORDER BY n), 1) AS before FROM numbered),
symbols AS (
  SELECT conv_id, n, role, text, initial, CASE WHEN fault IN ('blank', 'duplicate') THEN '-' ELSE initial END AS letter, (fault = 'truncated')::BIGINT AS cut FROM faults),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS size FROM faults GROUP BY conv_id),
walk(conv_id, n, v0, v1, v2, v3) AS (
  SELECT conv_id, 0::BIGINT, repeat('0', 12), NULL::VARCHAR, '000000000002I', '000000000004II' FROM counts
  UNION ALL
  SELECT conv_id, n, m0, m1, least(m2, {_plus("m3", "2", "I")}), m3 FROM (
    SELECT conv_id, n, m0, m1, m2, least(n3, {_plus("m2", "2", "I")}) AS m3 FROM (
      SELECT conv_id, n, n0 AS m0, n1 AS m1, n3, least(n2, {", ".join(_plus(x, "2", "I") for x in ("n0", "n1", "n3"))}) AS m2 FROM (
        SELECT w.conv_id, s.n, {gone[0]} AS n0, least({gone[1]}, {kept("s", ["v0"])}) AS n1,
          least({gone[2]}, {made(["v0", "v1", "v3"])}, {kept("u", ["v0", "v1", "v3"])}) AS n2,
          least({gone[3]}, {made(["v2"])}, {kept("a", ["v2"])}) AS n3
        FROM walk w JOIN symbols s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.n + 1)))),
ends AS (
  SELECT w.conv_id, least(v0, v3) AS best FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.n = c.size),
edits AS (SELECT conv_id, unnest(range(1, length(best) - 11)) AS i, substr(best, 13) AS audit FROM ends),
placed AS (
  SELECT conv_id, i, substr(audit, i, 1) AS edit, length(replace(left(audit, i), 'I', '')) AS n, length(replace(left(audit, i), 'D', '')) AS j FROM edits),
lines AS (
  SELECT p.conv_id, i, edit, j, s.role, s.text, max((j = 1 AND edit = 'K' AND s.initial = 's')::INT) OVER (PARTITION BY p.conv_id) AS headed
  FROM placed p LEFT JOIN symbols s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.n = p.n AND p.edit <> 'I' WHERE edit <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i) AS body
  FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(best, 12)::BIGINT, 0) AS cost,
  coalesce(substr(best, 13), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def secret_scans() -> str:
    """Matches of every rule in every text, without ledger; places from the lengths of what lies before."""
    found = " UNION ALL ".join(rf"""
  SELECT k, {rank} AS rank, {_quoted(rule.kind)} AS kind, {max(rule.least, 1)} AS least, string_split_regex(text, {_quoted(secrets.pattern(rule))}) AS gaps,
    regexp_extract_all(text, {_quoted(secrets.pattern(rule))}) AS hits, regexp_extract_all(text, {_quoted(secrets.pattern(rule))}, {rule.group}) AS kept
  FROM docs WHERE regexp_matches(text, {_quoted(secrets.pattern(rule))})""" for rank, rule in enumerate(secrets.RULES))
    base = ", ".join(_quoted(kind) for kind in secrets.BASE_KINDS)
    return rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS text FROM documents),
found AS ({found}),
places AS (
  SELECT k, rank, kind, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start,
    length(hits[i]) AS size, length(kept[i]) >= least AS fits FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found)),
spans AS (SELECT k, rank, kind, start::BIGINT AS start, kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT AS span FROM places WHERE fits),
figures AS (
  SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY start, rank) FILTER (kind IN ({base})) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN figures USING (k)
"""


SQL = {
    "op11_conversation_repair": conversation_repair(),
    "op13_secret_scans": secret_scans(),
    "op1_license_scans": license_scans(),
    "op2_line_dedup": LINE_DEDUP,
    "op5_warc": WARC,
}
