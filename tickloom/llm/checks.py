"""DuckDB SQL for the registered queries that SQL can express."""

CHECKS = {}

CHECKS["op2_decontaminate"] = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc_words, lengths WHERE len(w) >= n)),
found AS (SELECT DISTINCT doc_id, i, n, item FROM doc_windows JOIN item_windows USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM found GROUP BY doc_id),
item_places AS (
  SELECT item, i, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item_words WHERE len(w) > 0)),
pairs AS (
  SELECT d.doc_id, p.item, d.i AS di, d.i - p.i AS diagonal, d.n,
    d.i - row_number() OVER (PARTITION BY d.doc_id, p.item, d.n, d.i - p.i ORDER BY d.i) AS run
  FROM doc_windows d JOIN item_places p USING (n, win)),
longest AS (
  SELECT doc_id, max(size) AS longest FROM (SELECT doc_id, item, n, diagonal, run, count(*) - 1 + n AS size FROM pairs GROUP BY doc_id, item, n, diagonal, run) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest, 0) AS INTEGER) AS longest
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN longest USING (doc_id)
"""

CHECKS["op10_odd_sketches"] = r"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM doc_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(start, node) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.start, l.b FROM reached r JOIN both_ways l ON l.a = r.node),
named AS (SELECT start, min(node) AS component_id FROM reached GROUP BY start)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM doc_words d LEFT JOIN sizes USING (doc_id) LEFT JOIN named ON start = d.doc_id
"""

CHECKS["op9_line_dedup"] = r"""
WITH cut AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
numbered AS (
  SELECT doc_id, place, line, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS i,
    length(line) - length(replace(line, ' ', '')) + 1 AS words, CAST('0x' || substr(md5(line), 1, 15) AS BIGINT) AS h
  FROM (
    SELECT doc_id, place, trim(regexp_replace(parts[place + 1], '[ \t\x0B\f\r]+', ' ', 'g')) AS line
    FROM (SELECT doc_id, parts, unnest(generate_series(0, len(parts) - 1)) AS place FROM cut))
  WHERE line <> ''),
grown AS (
  SELECT a.doc_id, a.i, a.words AS first_words, b.i AS e, b.h,
    sum(b.words) OVER (PARTITION BY a.doc_id, a.i ORDER BY b.i) AS total,
    sum(b.words) OVER (PARTITION BY a.doc_id, a.i ORDER BY b.i) - b.words AS total_before
  FROM numbered a JOIN numbered b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 24),
units AS (
  SELECT doc_id, i, any_value(first_words) AS first_words,
    CAST('0x' || substr(md5(' ' || string_agg(CAST(h AS VARCHAR), ' ' ORDER BY e)), 1, 15) AS BIGINT) AS unit
  FROM grown WHERE total_before < 25 GROUP BY doc_id, i HAVING max(total) >= 25),
windowed AS (
  SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY doc_id) AS n,
    lag(first_words) OVER w AS words_before,
    lag(unit) OVER w AS earlier, lead(unit) OVER w AS later FROM units WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
prints AS (
  SELECT doc_id, i, unit, lag(i) OVER (PARTITION BY doc_id, unit ORDER BY i) AS prior FROM windowed
  WHERE first_words >= 25 OR words_before >= 25 OR n = 1 OR unit <= earlier OR unit < later),
firsts AS (SELECT unit, min({'d': doc_id, 'i': i}) AS f FROM prints WHERE prior IS NULL GROUP BY unit HAVING count(*) > 1),
diagonals AS (
  SELECT p.doc_id, f.d AS source, p.i - f.i AS diagonal FROM prints p JOIN firsts USING (unit) WHERE prior IS NULL AND p.doc_id <> f.d
  UNION SELECT doc_id, doc_id, i - prior FROM prints WHERE prior IS NOT NULL),
same AS (
  SELECT g.doc_id, g.source, g.diagonal, a.place, a.words, a.i - row_number() OVER (PARTITION BY g.doc_id, g.source, g.diagonal ORDER BY a.i) AS run
  FROM diagonals g JOIN numbered a ON a.doc_id = g.doc_id JOIN numbered b ON b.doc_id = g.source AND b.i = a.i - g.diagonal
  WHERE a.line = b.line),
ranges AS (
  SELECT DISTINCT doc_id, min(place) AS x, max(place) AS y FROM same GROUP BY doc_id, source, diagonal, run HAVING sum(words) >= 25),
opened AS (
  SELECT *, max(y) OVER (PARTITION BY doc_id ORDER BY x, y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ranges),
parts AS (
  SELECT *, sum(CASE WHEN x <= before THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY x, y ROWS UNBOUNDED PRECEDING) AS part FROM opened),
merged AS (SELECT doc_id, part, min(x) AS x, max(y) AS y FROM parts GROUP BY doc_id, part),
removed AS (SELECT doc_id, list({'x': x, 'y': y} ORDER BY x, y) AS r FROM merged GROUP BY doc_id)
SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(parts) END AS BIGINT) AS n_lines,
  coalesce(array_to_string(list_transform(r, lambda q: q.x || '-' || q.y), ','), '') AS removed,
  sha256(CASE WHEN r IS NULL THEN coalesce(text, '') ELSE array_to_string(list_filter(parts, lambda p, k: len(list_filter(r, lambda q: k - 1 BETWEEN q.x AND q.y)) = 0), chr(10)) END) AS text_sha256
FROM cut LEFT JOIN removed USING (doc_id)
"""

CHECKS["op4_pii"] = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
patterns(k, kind, p) AS (VALUES
  (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'),
  (2, 'ip', '[0-9]+(?:\.[0-9]+){3}'),
  (3, 'card', '[0-9](?:[ -]?[0-9])+'),
  (4, 'phone', '\+[0-9][ ().0-9-]+[0-9]'),
  (5, 'iban', '[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?'),
  (6, 'ssn', '[0-9]+(?:-[0-9]+)+')),
cut AS (SELECT doc_id, t, k, kind, regexp_extract_all(t, p) AS m, regexp_split_to_array(t, p) AS g FROM texts, patterns WHERE regexp_matches(t, p)),
one AS (SELECT *, unnest(generate_series(1, len(m))) AS i FROM cut),
placed AS (
  SELECT doc_id, t, k, kind, m[i] AS x, CAST(list_sum(list_transform(g[1:i], lambda q: length(q))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda q: length(q))), 0) AS BIGINT) AS s
  FROM one),
cleaned AS (
  SELECT *, regexp_replace(x, '[^0-9]', '', 'g') AS digits, replace(x, ' ', '') AS code,
    substr(t, greatest(s - 40, 0) + 1, least(s, 40)) AS near FROM placed),
valid AS (
  SELECT * FROM cleaned WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(x, '.'), lambda q: length(ltrim(q, '0')) > 3 OR CAST('0' || right(ltrim(q, '0'), 3) AS INTEGER) > 255)) = 0
    WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''), lambda q, j:
      CASE WHEN j % 2 = 1 THEN CAST(q AS INTEGER) WHEN CAST(q AS INTEGER) > 4 THEN 2 * CAST(q AS INTEGER) - 9 ELSE 2 * CAST(q AS INTEGER) END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
    WHEN 'iban' THEN length(code) = map {'AT': 20, 'BE': 16, 'CH': 21, 'CZ': 24, 'DE': 22, 'DK': 18, 'ES': 24, 'FI': 18, 'FR': 27, 'GB': 22, 'IE': 22,
        'IT': 27, 'LU': 20, 'NL': 18, 'NO': 15, 'PL': 28, 'PT': 25, 'SE': 24}[left(code, 2)]
      AND list_reduce(list_transform(string_split(substr(code, 5) || left(code, 4), ''), lambda q: CASE WHEN q BETWEEN '0' AND '9' THEN ascii(q) - 48 ELSE ascii(q) - 55 END),
        lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97) = 1
    ELSE regexp_full_match(x, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND left(x, 3) NOT IN ('000', '666') AND left(x, 1) <> '9' AND substr(x, 5, 2) <> '00' AND right(x, 4) <> '0000'
      AND regexp_matches(lower(near), '\bssn\b|social security') END)
SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
  count(*) FILTER (kind = 'phone') AS n_phone,
  sha256(coalesce(string_agg(kind || ':' || s || ':' || (s + length(x)), ',' ORDER BY k, s) FILTER (k <= 4), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || (s + length(x)), ',' ORDER BY k, s), '') AS spans
FROM texts LEFT JOIN valid USING (doc_id) GROUP BY doc_id
"""

CHECKS["op3_cross_polytope"] = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda q: q IS NULL OR NOT isfinite(q))) = 0 AND len(list_filter(embedding, lambda q: q <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached(start, node) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.start, l.b FROM reached r JOIN links l ON l.a = r.node),
named AS (SELECT start, min(node) AS component_id FROM reached GROUP BY start),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN counted ON a = vec_id LEFT JOIN named ON start = vec_id
"""


def _licences() -> str:
    from tickloom.llm.licences import TEMPLATES

    notices = ", ".join(f"({i}, '{licence}', '{text}')" for i, (licence, text) in enumerate(TEMPLATES))
    return rf"""
WITH templates(template, licence, notice) AS (VALUES {notices}),
files AS (
  SELECT doc_id, coalesce(text, '') AS text, CASE WHEN doc_id % 500 = 0 THEN source || '/LICENSE' ELSE source || '/' || lang || '/' || (doc_id // 1000) || '/' ||
    CASE WHEN doc_id % 20 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END END AS path FROM documents),
t_terms AS (
  SELECT template, licence, term, count(*) AS tf FROM (SELECT template, licence, unnest(regexp_extract_all(lower(notice), '[a-z0-9]+(?:\.[0-9]+)*')) AS term FROM templates) GROUP BY ALL),
present AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+(?:\.[0-9]+)*')) AS term FROM files),
weights AS (
  SELECT term, ln((1.0 + (SELECT count(*) FROM files)) / (1.0 + count(*))) + 1.0 AS idf FROM present WHERE term IN (SELECT term FROM t_terms) GROUP BY term),
t_raw AS (SELECT template, licence, term, tf * coalesce(idf, 1.0) AS tw FROM t_terms LEFT JOIN weights USING (term)),
t_norm AS (SELECT template, sqrt(sum(tw * tw)) AS norm FROM t_raw GROUP BY template),
lines AS (SELECT doc_id, place, parts[place + 1] AS line FROM (SELECT doc_id, parts, unnest(generate_series(0, len(parts) - 1)) AS place FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM files))),
statements AS (
  SELECT doc_id, place, line FROM lines WHERE regexp_matches(line, '(?i)licen[cs]|copyright|copyleft|spdx|rights reserved|redistribut|permission|public domain|\bgnu\b|\bcc[ -]|\bcc0\b')
  UNION ALL SELECT doc_id, -1, text FROM files WHERE path LIKE '%/LICENSE'),
s_terms AS (
  SELECT doc_id, place, term, count(*) * coalesce(any_value(idf), 1.0) AS w
  FROM (SELECT doc_id, place, unnest(regexp_extract_all(lower(line), '[a-z0-9]+(?:\.[0-9]+)*')) AS term FROM statements) LEFT JOIN weights USING (term) GROUP BY doc_id, place, term),
s_norm AS (SELECT doc_id, place, sqrt(sum(w * w)) AS length FROM s_terms GROUP BY doc_id, place),
scores AS (
  SELECT doc_id, licence, round(dot / norm / length, 6) AS score FROM (
    SELECT doc_id, place, template, licence, sum(w * tw) AS dot FROM s_terms JOIN t_raw USING (term) GROUP BY ALL) JOIN t_norm USING (template) JOIN s_norm USING (doc_id, place)),
own AS (SELECT doc_id, score, licence FROM scores WHERE score >= 0.6 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1),
placed AS (SELECT doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS directory FROM files),
granted AS (
  SELECT directory, licence, score FROM placed JOIN own USING (doc_id) WHERE path LIKE '%/LICENSE'
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, licence) = 1),
inherited AS (
  SELECT p.doc_id, g.licence, g.score, g.directory AS origin FROM placed p JOIN granted g ON p.directory = g.directory OR starts_with(p.directory, g.directory || '/')
  WHERE p.doc_id NOT IN (SELECT doc_id FROM own) QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY length(g.directory) DESC) = 1)
SELECT doc_id, path, coalesce(o.licence, i.licence) AS licence, coalesce(o.score, i.score) AS licence_score,
  CASE WHEN o.doc_id IS NOT NULL THEN 'self' ELSE i.origin END AS licence_from
FROM files LEFT JOIN own o USING (doc_id) LEFT JOIN inherited i USING (doc_id)
"""


CHECKS["op1_licences"] = _licences()

CHECKS["op11_fill_in_middle"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS p, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS q,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(p, q)], '') AS a, array_to_string(u[least(p, q) + 1:greatest(p, q)], '') AS b,
    array_to_string(u[greatest(p, q) + 1:], '') AS c FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

CHECKS["op13_bag_search"] = r"""
WITH doc_terms AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT *, row_number() OVER () AS r FROM documents)),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
lengths AS (SELECT r, doc_id, count(*) AS n FROM doc_terms GROUP BY r, doc_id),
totals AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
measured AS (SELECT r, doc_id, 100 - 50 + ((50 * n * big_n) // big_l) AS m FROM lengths, totals),
tfs AS (SELECT r, term, count(*) AS tf FROM doc_terms GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tfs, totals GROUP BY term),
scores AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM item_terms JOIN tfs USING (term) JOIN weights USING (term) JOIN measured USING (r) GROUP BY item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""
