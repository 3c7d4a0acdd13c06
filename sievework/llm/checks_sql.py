"""DuckDB SQL of the operators that find runs, repeated bytes and faulty conversations."""

from __future__ import annotations

BLANKS = r"\x20\x09-\x0D"


def crc32(text: str) -> str:
    """The checksum bit by bit; for ASCII."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: list_transform([0,1,2,3,4,5,6,7], lambda b: ((ascii(c) >> b) & 1)::UBIGINT)))"
    return (
        f"xor(list_reduce(list_concat([4294967295::UBIGINT], {bits}),"
        " lambda x, b: xor(x >> 1, (xor(x, b) & 1) * 3988292384)), 4294967295)::BIGINT"
    )


# A run of period q holds four words in a row that stand at multiples of q; only such lags are looked at whole.
PERIODIC_RUNS = f"""
WITH given AS (
  SELECT row_number() OVER () AS rid, doc_id, {crc32("doc_id::VARCHAR")} AS h, regexp_extract_all(coalesce(text, ''), '[^{BLANKS}]+') AS w FROM documents
), sized AS (SELECT *, len(w)::BIGINT AS n, h // 10 AS g FROM given),
cycle AS (SELECT *, g % greatest(n, 1) AS a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) AS p FROM sized),
docs AS (SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
  THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM cycle),
words AS MATERIALIZED (SELECT rid, unnest(range(n)) AS i, rid * 1000000000 + unnest(range(n)) AS pos, unnest(w) AS word FROM docs),
lags AS (SELECT rid, n, unnest(range(1, n // 4 + 1)) AS q FROM docs),
places AS (SELECT q, rid * 1000000000 + unnest(range(0, n - 3 * q, q)) AS pos FROM lags),
one AS MATERIALIZED (SELECT q, p.pos + q AS pos, word FROM places p JOIN words w ON w.pos = p.pos),
two AS MATERIALIZED (SELECT q, o.pos + q AS pos, word FROM one o JOIN words w USING (pos, word)),
three AS MATERIALIZED (SELECT q, o.pos + q AS pos, word FROM two o JOIN words w USING (pos, word)),
likely AS MATERIALIZED (SELECT DISTINCT w.rid, q FROM three o JOIN words w USING (pos, word)),
pairs AS MATERIALIZED (SELECT l.rid, l.q, x.i, x.pos + l.q AS pos, x.word FROM likely l JOIN words x ON x.rid = l.rid),
matches AS (
  SELECT p.rid, p.q, p.i, p.i - row_number() OVER (PARTITION BY p.rid, p.q ORDER BY p.i) AS island FROM pairs p JOIN words y USING (pos, word)
), stretches AS (SELECT rid, q, min(i) AS start, count(*) + q AS length FROM matches GROUP BY rid, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT rid, start, length, min(q) AS period FROM stretches GROUP BY rid, start, length),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT w.rid, string_agg(w.word, ' ' ORDER BY w.i) AS text FROM words w ANTI JOIN gone g ON g.rid = w.rid AND g.i = w.i GROUP BY w.rid),
lists AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text FROM runs GROUP BY rid),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length::DOUBLE / period DESC, start, period) = 1)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(l.text, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN lists l USING (rid) LEFT JOIN best b USING (rid) LEFT JOIN kept k USING (rid)
"""

REPEATED_BYTES = """
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT rid, id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM docs),
windows AS (SELECT rid, id, i, substring(h, 2 * i + 1, 100) AS bytes FROM starts),
later AS (SELECT rid, i FROM (SELECT rid, id, i, min(id) OVER (PARTITION BY bytes) AS least FROM windows) WHERE least < id),
marked AS (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM later),
numbered AS (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS span FROM marked),
spans AS (SELECT rid, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY rid, span),
gaps AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM spans),
cut AS (
  SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS left_over FROM gaps JOIN docs USING (rid) GROUP BY rid
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_spans > 0 THEN left_over || substring(h, 2 * last + 1) ELSE h END)) AS kept_sha256
FROM docs LEFT JOIN cut USING (rid)
"""


def added(way: str, cost: str, letter: str) -> str:
    """A way (cost in eight digits, then a pair of letter and role for each edit) with one more edit; 'Z' is none."""
    return f"CASE WHEN {way} = 'Z' THEN 'Z' ELSE lpad((left({way}, 8)::INTEGER + {cost})::VARCHAR, 8, '0') || substr({way}, 9) || '{letter}' END"


def kept(way: str, initial: str) -> str:
    return f"CASE WHEN gone OR initial IS DISTINCT FROM '{initial}' THEN 'Z' ELSE {added(way, 'late', 'K.')} END"


def given(way: str, role: str) -> str:
    return f"CASE WHEN gone THEN 'Z' ELSE {added(way, '2 + late', 'R' + role)} END"


def closed(source: str) -> str:
    """The least ways to each state, rows that are inserted included."""
    return f"""
  SELECT c, i, n, s, u, least(a, {added('u', '2', 'Ia')}) AS a FROM (
    SELECT c, i, n, s, a, least(u, {added('n', '2', 'Iu')}, {added('s', '2', 'Iu')}, {added('a', '2', 'Iu')}) AS u FROM ({source}))"""


TURN_REPAIR = f"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations
), convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
  SELECT c, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed h JOIN convs v ON v.conv_id IS NOT DISTINCT FROM h.conv_id WHERE k <> 0
), numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^{BLANKS}]') AS blank,
    row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again, NOT regexp_matches(text, '[.!?][{BLANKS}]*\\z') AS cut FROM numbered
), faulty AS (
  SELECT *, blank OR again AS gone, (cut AND NOT blank AND NOT again)::INTEGER AS late,
    lag(initial) OVER (PARTITION BY c ORDER BY i) AS before_it FROM judged
), ways AS (
  {closed("SELECT c, 0::BIGINT AS i, '00000000' AS n, 'Z' AS s, 'Z' AS u, 'Z' AS a FROM convs")}
  UNION ALL
  {closed(f'''
    SELECT w.c, f.i, {added('n', '3', 'D-')} AS n, least({added('s', '3', 'D-')}, {kept('n', 's')}) AS s,
      least({added('u', '3', 'D-')}, {kept('n', 'u')}, {kept('s', 'u')}, {kept('a', 'u')}, {given('n', 'u')}, {given('s', 'u')}, {given('a', 'u')}) AS u,
      least({added('a', '3', 'D-')}, {kept('u', 'a')}, {given('u', 'a')}) AS a
    FROM ways w JOIN faulty f ON f.c = w.c AND f.i = w.i + 1''')}
), best AS (SELECT c, least(n, a) AS way FROM ways QUALIFY row_number() OVER (PARTITION BY c ORDER BY i DESC) = 1),
pairs AS (SELECT c, unnest(range(1, (length(way) - 8) // 2 + 1)) AS k, way FROM best),
letters AS (SELECT c, k, substr(way, 7 + 2 * k, 1) AS letter, substr(way, 8 + 2 * k, 1) AS role FROM pairs),
rows AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY c ORDER BY k) AS i FROM letters),
lines AS (
  SELECT r.c, r.k, CASE letter WHEN 'K' THEN f.role ELSE CASE r.role WHEN 'u' THEN 'user' ELSE 'assistant' END END
    || ':' || CASE letter WHEN 'I' THEN '' ELSE f.text END AS line
  FROM rows r LEFT JOIN faulty f ON f.c = r.c AND f.i = r.i WHERE letter <> 'D'
), repaired AS (SELECT c, string_agg(line, chr(10) ORDER BY k) AS text FROM lines GROUP BY c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (late = 1) AS truncated,
    count(*) FILTER (before_it IS NOT NULL AND before_it || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, left(way, 8)::BIGINT AS cost, regexp_replace(substr(way, 9), '(.).', '\\1', 'g') AS audit, sha256(coalesce(text, '')) AS repaired_sha256
FROM convs JOIN best USING (c) LEFT JOIN counts USING (c) LEFT JOIN repaired USING (c)
"""
