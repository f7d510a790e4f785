"""DuckDB SQL for those queries for training data that SQL can express, each by another way than the operator's."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8, byte by byte; needs ``crc_table`` (one row, ``t``) beside it."""
    digits = f"hex(encode({text}))"
    code = f"list_transform(range(0, length({digits}) // 2), lambda k: ('0x' || {digits}[2 * k + 1 : 2 * k + 2])::UBIGINT)"
    step = "lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])"
    return f"xor(list_reduce({code}, {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)::BIGINT"


CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(
    list_transform(range(0, 8), lambda z: 0::UBIGINT),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, i::UBIGINT)) AS t)"""

URL_CASCADE = r"""
WITH rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
         ('org', '/fr/', 'allow')),
parsed AS (
  SELECT row_number() OVER () AS row_no, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
fitting AS (
  SELECT row_no, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY row_no ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
  FROM parsed JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parsed LEFT JOIN (SELECT * FROM fitting WHERE k = 1) USING (row_no)"""

SPELLING_VARIANTS = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, n, length(run) AS size, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
  FROM runs, crc_table WHERE length(run) >= 5),
spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word, n
  FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, min({{'less': -other_n, 'form': other}}) AS best FROM near GROUP BY word),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best.less >= 2 * words.n THEN best.form END AS form,
    CASE WHEN -best.less >= 2 * words.n THEN -best.less END AS form_n
  FROM words LEFT JOIN best USING (word)),
chains AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT chains.word, forms.word, forms.form FROM chains JOIN forms ON chains.next = forms.word)
SELECT forms.word, forms.form, chains.root, forms.n, forms.n_near::BIGINT AS n_near, forms.form_n::BIGINT AS form_n
FROM forms JOIN chains ON chains.word = forms.word AND chains.next IS NULL"""

PERIODIC_RUNS = rf"""
WITH {CRC_TABLE},
split AS (
  SELECT row_number() OVER () AS row_no, doc_id, {crc32("coalesce(doc_id::VARCHAR, '')")} AS h,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents, crc_table),
numbered AS (
  SELECT row_no, doc_id, words, h, h // 10 AS g, len(words) AS n FROM split),
placed AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a,
    CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p
  FROM numbered),
texts AS (
  SELECT row_no, doc_id, n, CASE WHEN a IS NULL THEN words ELSE list_transform(range(0, n),
    lambda i: words[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END) + 1]) END AS words
  FROM placed),
spots AS (SELECT row_no, n, unnest(range(0, n)) AS i, unnest(words) AS w FROM texts),
fours AS (  -- a run has at least 16 words in a row that come again one period later, so four in a row do
  SELECT row_no, n, i, concat_ws(' ', w, lead(w, 1) OVER nearby, lead(w, 2) OVER nearby, lead(w, 3) OVER nearby) AS w
  FROM spots WINDOW nearby AS (PARTITION BY row_no ORDER BY i) QUALIFY i + 4 <= n),
equal AS (
  SELECT x.row_no, x.i, y.i - x.i AS q
  FROM fours x JOIN fours y ON x.row_no = y.row_no AND x.w = y.w AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (
  SELECT row_no, q, i, i - row_number() OVER (PARTITION BY row_no, q ORDER BY i) AS island FROM equal),
stretches AS (
  SELECT row_no, q, min(i) AS start, count(*) + 3 + q AS length FROM islands
  GROUP BY row_no, q, island HAVING count(*) + 3 + q >= greatest(24, 3 * q)),
runs AS (SELECT row_no, start, length, min(q) AS period FROM stretches GROUP BY row_no, start, length),
lines AS (
  SELECT row_no, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY row_no),
top AS (
  SELECT *, row_number() OVER (
    PARTITION BY row_no ORDER BY length::DOUBLE / period DESC, start, period) AS k FROM runs),
kept AS (
  SELECT row_no, string_agg(w, ' ' ORDER BY i) AS collapsed FROM spots
  WHERE NOT EXISTS (
    FROM runs r WHERE r.row_no = spots.row_no AND spots.i >= r.start + r.period AND spots.i < r.start + r.length)
  GROUP BY row_no)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.start, top.length, top.period,
  1000 * top.length // top.period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN lines USING (row_no) LEFT JOIN (FROM top WHERE k = 1) top USING (row_no)
  LEFT JOIN kept USING (row_no)"""

ORACLE = {
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_url_cascade": URL_CASCADE,
    "op13_periodic_runs": PERIODIC_RUNS,
}
