"""DuckDB statements for the queries of this package that SQL can express."""

from __future__ import annotations

import re

from .license_templates import TEMPLATES


def _license_rows() -> str:
    rows = [(t.label, t.kind, re.findall("[a-z0-9]+", t.text.lower())) for t in TEMPLATES]
    return ", ".join(f"({i}, '{label}', '{kind}', {words})" for i, (label, kind, words) in enumerate(rows))


# Word lists are compared outright; bodies by their runs of four words, whose
# diagonals are merged as the library does.
OP11 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
template(of, label, kind, w) AS (VALUES """ + _license_rows() + r"""),
gram AS (
  SELECT nr, i - 1 AS place, w[i:i + 3] AS four FROM doc, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)),
exact AS (
  SELECT nr, label, kind, place AS first, place + len(t.w) - 1 AS last, 1.0::DOUBLE AS score
  FROM gram JOIN template t ON four[1] = t.w[1] AND four[2] = t.w[2] JOIN doc d USING (nr)
  WHERE kind <> 'body' AND d.w[place + 1:place + len(t.w)] = t.w),
body_gram AS (
  SELECT of, label, kind, len(w) AS size, i - 1 AS spot, w[i:i + 3] AS four FROM template, LATERAL (SELECT unnest(range(1, len(w) - 2)) AS i)
  WHERE kind = 'body'),
vote AS (SELECT DISTINCT nr, of, label, kind, size, place - spot AS diagonal, spot FROM gram JOIN body_gram USING (four)),
cell AS (
  SELECT v.nr, v.of, v.label, v.kind, v.size, c.diagonal, min(v.diagonal + v.spot) AS s, max(v.diagonal + v.spot + 3) AS e, count(DISTINCT x) AS covered
  FROM (SELECT DISTINCT nr, of, diagonal FROM vote) c JOIN vote v ON v.nr = c.nr AND v.of = c.of AND v.diagonal BETWEEN c.diagonal AND c.diagonal + 3,
    LATERAL (SELECT unnest([v.spot, v.spot + 1, v.spot + 2, v.spot + 3]) AS x) GROUP BY ALL),
body AS (
  SELECT nr, label, kind, s AS first, e AS last, covered::DOUBLE / greatest(size, e - s + 1) AS score FROM cell c
  WHERE covered::DOUBLE / greatest(size, e - s + 1) >= 0.8 AND NOT EXISTS (SELECT 1 FROM cell o WHERE o.nr = c.nr AND o.of = c.of
    AND abs(o.diagonal - c.diagonal) <= 3 AND (o.covered > c.covered OR (o.covered = c.covered AND o.diagonal < c.diagonal)))),
found AS (
  SELECT nr, count(*) FILTER (kind = 'base') AS n_base, min(first) FILTER (kind = 'base') AS first_word, max(first) FILTER (kind = 'base') AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (kind = 'base') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(score) AS score FROM (SELECT * FROM exact UNION ALL SELECT * FROM body) GROUP BY nr)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score FROM doc LEFT JOIN found USING (nr)
"""

# Every n-gram is listed and counted on its own.
OP13 = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM piece, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i),
    (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidate AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 30),
cut AS (
  SELECT c.*, x AS k, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f + r.f))::BIGINT AS score
  FROM candidate c, LATERAL (SELECT unnest(range(1, size)) AS x)
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:x], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[x + 1:size], ' ')),
best AS (
  SELECT lang, phrase, a, min_by(l, (score, k)) AS l, min_by(r, (score, k)) AS r, min(score) AS score FROM cut GROUP BY lang, phrase, a),
inner_phrase AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[i:i + z - 1], ' ') AS phrase, c.a AS around FROM candidate c, LATERAL (SELECT unnest(range(1, size)) AS i),
    (SELECT unnest([2, 3]) AS z) WHERE z < size AND i + z - 1 <= size),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_phrase o WHERE o.lang = b.lang AND o.phrase = b.phrase AND 100 * o.around >= 80 * b.a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

OP10 = r"""
WITH cut AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', ['host', 'path']) AS p FROM pages),
parts AS (
  SELECT page_id, translate(p.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, p.path AS path FROM cut),
site(rule, rule_host, rule_path, verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
word(pattern) AS (VALUES ('adult'), ('ads'), ('bets'), ('casino'), ('escort'), ('pills'), ('poker'), ('porn'),
  ('spam'), ('torrent'), ('viagra'), ('warez'), ('xxx')),
fits AS (
  SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS site_verdict
  FROM parts LEFT JOIN site ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY ALL),
hits AS (
  SELECT host, min(pattern) AS found FROM (SELECT DISTINCT host FROM parts) JOIN word
    ON list_contains(regexp_split_to_array(host, '[.-]'), pattern) GROUP BY host)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN found END AS pattern,
  coalesce(site_verdict, CASE WHEN found IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM fits LEFT JOIN hits USING (host)
"""

# Quotients are listed outright and the highest ones seated; blocks and their
# copies are rows. The library computes both by arithmetic.
OP8 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('42:' || coalesce(doc_id::VARCHAR, 'null')) AS spot FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][(pos - 1) % 3 + 1] AS w, 3 * words AS cap FROM totals),
filled AS (
  SELECT *, sum(words) OVER () - coalesce(sum(cap) OVER lower_caps, 0) AS rest, sum(w) OVER higher_caps AS weight
  FROM weighed WINDOW lower_caps AS (ORDER BY cap / w, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    higher_caps AS (ORDER BY cap / w, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
cut AS (
  SELECT min_by(rest::DOUBLE / weight, (cap / w, pos)) AS share FROM filled WHERE cap::HUGEINT * weight >= rest::HUGEINT * w),
plan AS (
  SELECT source, words, pos, CASE WHEN cap < share * w THEN cap::DOUBLE ELSE share * w END AS target,
    (words + 31) // 32 AS blocks FROM weighed, cut),
quotients AS (
  SELECT pos, target / (2 * k + 1) AS quotient FROM plan, LATERAL (SELECT unnest(range(0, 3 * blocks)) AS k)),
seats AS (
  SELECT pos, count(*) AS seats FROM (SELECT pos FROM quotients ORDER BY quotient DESC, pos
    LIMIT (SELECT (2 * sum(words) + 32) // 64 FROM totals)) GROUP BY pos),
named AS (
  SELECT *, md5('42:' || coalesce('s' || source, 'null')) AS code, greatest(1, blocks) AS m FROM plan LEFT JOIN seats USING (pos)),
stepped AS (
  SELECT *, ('0x' || substr(code, 6, 5))::BIGINT % m AS shift, (SELECT min(s) FROM (
      SELECT ('0x' || substr(code, 1, 5))::BIGINT + i AS s FROM range(1, 500) t(i)) WHERE gcd(s, m) = 1) AS step FROM named),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY spot, doc_id NULLS LAST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM sized),
copies AS (
  SELECT doc_id, p.source, first, size, k, c FROM placed p JOIN stepped s ON p.source IS NOT DISTINCT FROM s.source,
    LATERAL (SELECT unnest(range(first // 32, (first + size + 31) // 32)) AS k), (SELECT unnest([0, 1, 2]) AS c)
  WHERE size > 0 AND c * m + (step * k + shift) % m < coalesce(seats, 0)),
taken AS (
  SELECT doc_id, first, size, source, sum(least(32 * (k + 1), first + size) - greatest(32 * k, first))::BIGINT AS taken
  FROM copies GROUP BY ALL)
SELECT p.doc_id, p.size, s.words AS source_size, s.target AS target, coalesce(t.taken, 0)::BIGINT AS taken
FROM placed p JOIN plan s ON p.source IS NOT DISTINCT FROM s.source
  LEFT JOIN taken t ON t.doc_id IS NOT DISTINCT FROM p.doc_id AND t.first = p.first AND t.size = p.size AND t.source IS NOT DISTINCT FROM p.source
"""

OP7 = r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
ranked AS (
  SELECT doc_id, sha256(body) AS text_sha256, count(*) OVER (PARTITION BY body) AS group_size,
    first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id NULLS LAST) AS keep_id FROM normal)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM ranked
"""

OP2 = r"""
WITH page AS (
  SELECT row_number() OVER () AS nr, doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
line AS (
  SELECT nr, source, p.i AS i, parts[p.i] AS line, trim(parts[p.i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM page, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) p),
body AS (
  SELECT p.nr, p.source, min(p.nr) OVER (PARTITION BY p.source, b.lines) AS stands_for
  FROM page p LEFT JOIN (SELECT nr, list(bare ORDER BY i) AS lines FROM line WHERE bare <> '' GROUP BY nr) b USING (nr)),
boiler AS (
  SELECT source, bare FROM (SELECT l.source, bare, count(DISTINCT nr) AS pages FROM line l JOIN body USING (nr)
      WHERE bare <> '' AND nr = stands_for GROUP BY ALL)
    JOIN (SELECT source AS of, count(*) AS host_pages FROM body WHERE nr = stands_for GROUP BY ALL) ON source IS NOT DISTINCT FROM of
  WHERE pages >= 2 AND pages > host_pages * 0.1),
marked AS (
  SELECT l.*, b.bare IS NOT NULL AS gone FROM line l LEFT JOIN boiler b
    ON l.bare = b.bare AND l.source IS NOT DISTINCT FROM b.source),
joined AS (
  SELECT nr, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS cleaned FROM marked GROUP BY nr)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE cleaned END AS text,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped FROM page LEFT JOIN joined USING (nr)
"""
