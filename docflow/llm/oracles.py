"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

LOWER = "TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, REGEXP_EXTRACT_ALL({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  b AS (SELECT item_id, REGEXP_EXTRACT_ALL({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  item_windows AS (SELECT DISTINCT item_id, w[i:i + 9] AS win FROM
    (SELECT item_id, w, UNNEST(RANGE(1, GREATEST(LEN(w) - 9, 1) + 1)) AS i FROM b WHERE LEN(w) > 0)),
  sizes AS (SELECT DISTINCT LEN(win) AS n FROM item_windows),
  rows AS (SELECT doc_id, UNNEST(w) AS word, UNNEST(RANGE(LEN(w))) AS pos FROM d),
  ahead AS (SELECT doc_id, pos, LIST(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS win FROM rows),
  doc_keys AS (SELECT doc_id, pos, n, ARRAY_TO_STRING(win[1:n], ' ') AS key FROM ahead, sizes WHERE LEN(win) >= n),
  item_keys AS (SELECT item_id, LEN(win) AS n, ARRAY_TO_STRING(win, ' ') AS key FROM item_windows),
  found AS (SELECT doc_id, pos, i.n, item_id FROM doc_keys k JOIN item_keys i ON i.n = k.n AND i.key = k.key),
  hit AS (SELECT doc_id, COUNT(*) AS n_hit FROM (SELECT DISTINCT doc_id, UNNEST(RANGE(pos, pos + n)) AS p FROM found) GROUP BY 1),
  named AS (SELECT doc_id, COUNT(*) AS n_items, STRING_AGG(item, ',' ORDER BY item) AS items FROM
    (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT d.doc_id, CAST(LEN(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, SHA256(COALESCE(items, '')) AS items_sha256,
  COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN named ON named.doc_id = d.doc_id"""

# Patterns of the task's contract. Fixed values.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
}
DIGITS = "REGEXP_REPLACE(m, '[^0-9]', '', 'g')"
LUHN = f"""LIST_SUM(LIST_TRANSFORM(RANGE(1, LENGTH({DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(REVERSE({DIGITS})[i] AS INT)
  ELSE CAST(REVERSE({DIGITS})[i] AS INT) * 2 - CASE WHEN CAST(REVERSE({DIGITS})[i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
COMPACT = "REPLACE(m, ' ', '')"
MOD97 = f"""LIST_REDUCE(LIST_CONCAT([0], LIST_TRANSFORM(STRING_SPLIT(ARRAY_TO_STRING(LIST_TRANSFORM(
  STRING_SPLIT(SUBSTR({COMPACT}, 5) || SUBSTR({COMPACT}, 1, 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c
  ELSE CAST(ASCII(c) - 55 AS VARCHAR) END), ''), ''), lambda c: CAST(c AS INT))), lambda a, c: (a * 10 + c) % 97) = 1"""
VALID = {
    "email": "TRUE",
    "ip": "LIST_MAX(LIST_TRANSFORM(STRING_SPLIT(m, '.'), lambda x: CAST(x AS HUGEINT))) <= 255",
    "card": f"LENGTH({DIGITS}) BETWEEN 13 AND 19 AND {LUHN}",
    "phone": f"LENGTH({DIGITS}) BETWEEN 9 AND 15",
    "iban": f"LENGTH({COMPACT}) BETWEEN 15 AND 34 AND {MOD97}",
}


# Context words of the kinds, and the scores without and with one of them nearby.
CONTEXT = {
    "email": ("e-?mail|contact|write|mailto", "0.8", "1.0"), "ip": ("ip|host|server|address|login", "0.5", "0.7"),
    "card": ("card|visa|mastercard|credit|payment|cvv", "0.7", "0.9"), "phone": ("phone|tel|call|mobile|fax|whatsapp", "0.6", "0.8"),
    "iban": ("iban|account|bank|transfer|konto", "0.8", "1.0")}


def _spans(kind: str, order: int) -> str:
    pattern, (words, without, near) = PATTERNS[kind], CONTEXT[kind]
    around = "SUBSTR(text, GREATEST(s - 40, 0) + 1, s - GREATEST(s - 40, 0)) || CHR(10) || SUBSTR(text, s + LENGTH(m) + 1, 40)"
    return f"""SELECT doc_id, {order} AS k, '{kind}' AS kind, m, s, s + LENGTH(m) AS e,
  CASE WHEN REGEXP_MATCHES({around}, '(?i)\\b(?:{words})\\b') THEN '{near}' ELSE '{without}' END AS score FROM (
  SELECT doc_id, text, ms[i] AS m, CAST(LIST_SUM(LIST_TRANSFORM(ps[1:i], lambda x: LENGTH(x)))
    + COALESCE(LIST_SUM(LIST_TRANSFORM(ms[1:i - 1], lambda x: LENGTH(x))), 0) AS BIGINT) AS s FROM
  (SELECT doc_id, text, ms, ps, UNNEST(RANGE(1, LEN(ms) + 1)) AS i FROM (SELECT doc_id, text, REGEXP_EXTRACT_ALL(text, '{pattern}') AS ms,
    STRING_SPLIT_REGEX(text, '{pattern}') AS ps FROM documents WHERE text IS NOT NULL))) WHERE {VALID[kind]}"""


PERSONAL = "WITH s AS (" + "\n  UNION ALL ".join(_spans(k, i) for i, k in enumerate(PATTERNS)) + """),
  g AS (SELECT doc_id, COUNT(*) FILTER (kind = 'email') AS n_email, COUNT(*) FILTER (kind = 'ip') AS n_ip,
    COUNT(*) FILTER (kind = 'card') AS n_card, COUNT(*) FILTER (kind = 'phone') AS n_phone,
    STRING_AGG(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k < 4) AS base,
    STRING_AGG(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans, STRING_AGG(score, ',' ORDER BY k, s) AS scores FROM s GROUP BY 1)
SELECT d.doc_id, COALESCE(n_email, 0) AS n_email, COALESCE(n_ip, 0) AS n_ip, COALESCE(n_card, 0) AS n_card,
  COALESCE(n_phone, 0) AS n_phone, SHA256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans, COALESCE(scores, '') AS scores
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, REGEXP_EXTRACT_ALL({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
  rows AS (SELECT doc_id, LEN(w) AS n, UNNEST(w) AS word, UNNEST(RANGE(LEN(w))) AS pos FROM d),
  ahead AS (SELECT doc_id, n, pos, LIST(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS win FROM rows),
  sets AS (SELECT DISTINCT doc_id, ARRAY_TO_STRING(win, ' ') AS shingle FROM ahead WHERE LEN(win) = 5 OR n < 5 AND pos = 0),
  sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY 1),
  pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
  reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT r.doc_id, COALESCE(s.n, 0) AS n_shingles, r.component_id
FROM (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY 1) r LEFT JOIN sizes s ON s.doc_id = r.doc_id"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND LIST_COSINE_SIMILARITY(x.e, y.e) >= 0.9),
  reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
  degree AS (SELECT a, COUNT(*) AS n FROM links GROUP BY 1)
SELECT r.a AS vec_id, COALESCE(degree.n, 0) AS n_links, r.component_id, r.a = r.component_id AS kept
FROM (SELECT a, MIN(b) AS component_id FROM reach GROUP BY 1) r LEFT JOIN degree ON degree.a = r.a"""

MIXING = r"""
WITH d AS (SELECT doc_id, source, CAST(LEN(REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST(CAST('0x' || SUBSTR(MD5(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || COALESCE(text, '')), 1, 13) AS BIGINT) AS DOUBLE)
      / 4503599627370496 AS chance FROM documents),
  s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
  w AS (SELECT *, [5, 2, 1][(ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM s),
  before AS (SELECT *, SUM(cap) OVER o - cap AS cap_before, SUM(weight) OVER o - weight AS weight_before FROM w
    WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
  level AS (SELECT MAX(CAST((SELECT SUM(source_size) FROM w) - cap_before AS DOUBLE)
    / CAST((SELECT SUM(weight) FROM w) - weight_before AS DOUBLE)) AS l FROM before),
  t AS (SELECT source, source_size, LEAST(CAST(cap AS DOUBLE), l * weight) AS target,
    CASE WHEN source_size > 0 THEN LEAST(CAST(cap AS DOUBLE), l * weight) / source_size ELSE 0 END AS rate FROM w, level)
SELECT doc_id, size, source_size, target, size * CAST(FLOOR(rate) + CASE WHEN chance < rate - FLOOR(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source"""

P = "1 + (CAST(1000000000 AS HUGEINT) * ({c} + 2)) // ({n} + 2 * v)"
DIVERGENCE = rf"""
WITH d AS (SELECT COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
    REGEXP_EXTRACT_ALL({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
  groups AS (SELECT DISTINCT lang, source FROM d),
  kept AS (SELECT lang, term, COUNT(*) AS docs FROM (SELECT lang, UNNEST(LIST_DISTINCT(w)) AS term FROM d) GROUP BY 1, 2 HAVING COUNT(*) >= 10),
  counts AS (SELECT lang, source, term, COUNT(*) AS n FROM (SELECT lang, source, UNNEST(w) AS term FROM d) SEMI JOIN kept USING (lang, term)
    GROUP BY 1, 2, 3),
  v AS (SELECT lang, COUNT(kept.term) AS v FROM (SELECT DISTINCT lang FROM groups) LEFT JOIN kept USING (lang) GROUP BY 1),
  totals AS (SELECT lang, source, v, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total FROM groups JOIN v USING (lang) LEFT JOIN counts USING (lang, source)
    GROUP BY 1, 2, 3),
  grid AS (SELECT t.lang, t.source, k.term, COALESCE(n, 0) AS n, {P.format(c='COALESCE(n, 0)', n='total')} AS p
    FROM totals t JOIN kept k ON k.lang = t.lang LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
  whole AS (SELECT lang, term, {P.format(c='n', n='SUM(n) OVER (PARTITION BY lang)')} AS q FROM
    (SELECT lang, term, SUM(n) AS n FROM counts GROUP BY 1, 2) JOIN v USING (lang)),
  pair AS (SELECT x.lang, x.source, y.source AS item, SUM((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM grid x JOIN grid y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
  all_pairs AS (SELECT x.lang, x.source, y.source AS item, COALESCE(value, 0) AS value FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN pair ON pair.lang = x.lang AND pair.source = x.source AND pair.item = y.source),
  term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM grid JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
  parts AS (SELECT lang, source, 'pair' AS part, item, value FROM all_pairs UNION ALL SELECT lang, source, 'term', item, value FROM term),
  ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""


def _plus(state: str, cost: int | str, edit: str) -> str:
    """Six digits of cost and the audit, so that the least text has the least cost and audit; '~' can't be reached."""
    return f"""CASE WHEN {state} = '~' THEN '~' ELSE LPAD(CAST(CAST(SUBSTR({state}, 1, 6) AS INT) + {cost} AS VARCHAR), 6, '0') || SUBSTR({state}, 7) || '{edit}' END"""


def _taken(state: str, initial: str) -> str:
    """A row as the given initial: kept if it has it, else with a new role, unless it must go."""
    cut = "CASE WHEN x[1] IN ('S', 'U', 'A', '_') THEN 1 ELSE 0 END"
    new = "'~'" if initial == "s" else _plus(state, f"2 + {cut}", "R")
    return f"CASE WHEN x[1] = 'x' THEN '~' WHEN LOWER(x[1]) = '{initial}' THEN {_plus(state, cut, 'K')} ELSE {new} END"


DELETED = [_plus(f"v[{p}]", 3, "D") for p in range(1, 5)]
EDITED = f"""[{DELETED[0]}, LEAST({DELETED[1]}, {_taken('v[1]', 's')}),
  LEAST({DELETED[2]}, {_taken('v[1]', 'u')}, {_taken('v[2]', 'u')}, {_taken('v[4]', 'u')}), LEAST({DELETED[3]}, {_taken('v[3]', 'a')})]"""
INSERTED = f"""[v[1], v[2], LEAST(v[3], {_plus('v[1]', 2, 'I')}, {_plus('v[2]', 2, 'I')}, {_plus('v[4]', 2, 'I')}),
  LEAST(v[4], {_plus('v[3]', 2, 'I')}, {_plus('v[1]', 4, 'II')}, {_plus('v[2]', 4, 'II')})]"""
CRC = """XOR(LIST_REDUCE(LIST_PREPEND(CAST(4294967295 AS BIGINT), FLATTEN(LIST_TRANSFORM(STRING_SPLIT(key, ''),
  lambda c: [CAST(ASCII(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda a, b: XOR(XOR(a, b) >> 1, 3988292384 * (XOR(a, b) & 1))), 4294967295)"""
CONVERSATIONS = f"""
WITH keyed AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
    COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
  kinds AS (SELECT *, {CRC} % 20 AS kind FROM keyed),
  damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN ''
    WHEN kind = 2 THEN TRANSLATE(text, '.!?', '') ELSE text END AS text, UNNEST(RANGE(CASE WHEN kind = 3 THEN 2 WHEN kind = 0 THEN 0 ELSE 1 END)) FROM kinds),
  placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, MD5(text)) AS i,
    RTRIM(text, ' ' || CHR(9) || CHR(10) || CHR(11) || CHR(12) || CHR(13)) AS body FROM damaged),
  faults AS (SELECT *, LEFT(role, 1) AS initial, CASE WHEN body = '' THEN 'blank' WHEN ROW_NUMBER() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1
    THEN 'duplicate' WHEN RIGHT(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM placed),
  symbols AS (SELECT *, LAG(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS neighbours, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x'
    WHEN initial NOT IN ('s', 'u', 'a') THEN CASE WHEN fault IS NULL THEN '-' ELSE '_' END
    WHEN fault IS NULL THEN initial ELSE UPPER(initial) END AS symbol FROM faults),
  convs AS (SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) FILTER (fault = 'blank') AS blank,
    COUNT(*) FILTER (fault = 'duplicate') AS duplicate, COUNT(*) FILTER (fault = 'truncated') AS truncated,
    COUNT(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal,
    LIST_REDUCE(LIST_CONCAT([['000000', '~', '~', '~'], ['I']], FLATTEN(LIST([[symbol], ['I']] ORDER BY i))),
      lambda v, x: CASE WHEN x[1] = 'I' THEN {INSERTED} ELSE {EDITED} END) AS cells FROM symbols GROUP BY 1),
  solved AS (SELECT *, LEAST(cells[1], cells[4]) AS least FROM convs),
  letters AS (SELECT conv_id, SUBSTR(least, k, 1) AS edit, k, LENGTH(REPLACE(SUBSTR(least, 7), 'D', '')) % 2 AS odd FROM
    (SELECT conv_id, least, UNNEST(RANGE(7, LENGTH(least) + 1)) AS k FROM solved)),
  walked AS (SELECT *, COUNT(*) FILTER (edit <> 'I') OVER w AS i, COUNT(*) FILTER (edit <> 'D') OVER w - 1 AS place FROM letters
    WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
  fixed AS (SELECT l.conv_id, k, CASE WHEN edit = 'K' THEN role WHEN (place - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line FROM walked l JOIN placed p
    ON p.conv_id IS NOT DISTINCT FROM l.conv_id AND p.i = GREATEST(l.i, 1) WHERE edit <> 'D'),
  hashes AS (SELECT conv_id, SHA256(STRING_AGG(line, CHR(10) ORDER BY k)) AS sha FROM fixed GROUP BY 1)
SELECT c.conv_id, CAST(COALESCE(gaps, 0) AS BIGINT) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
  COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, CAST(COALESCE(SUBSTR(least, 1, 6), '0') AS BIGINT) AS cost,
  COALESCE(SUBSTR(least, 7), '') AS audit, COALESCE(sha, SHA256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN hashes h ON h.conv_id IS NOT DISTINCT FROM c.conv_id"""
