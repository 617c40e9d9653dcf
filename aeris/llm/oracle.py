"""DuckDB SQL of the queries that SQL can express, written from their definitions."""

from __future__ import annotations

URL_REPUTATION = r"""
WITH urls AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
marks AS (SELECT doc_id AS page_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 WHEN quality IS NOT NULL THEN 0 END) AS good FROM labels GROUP BY 1),
named AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), '\.?(:[0-9]*)?$', '') AS name, good
  FROM urls JOIN marks USING (page_id) WHERE good IS NOT NULL),
parts AS (SELECT host, good, string_split(name, '.') AS l FROM named),
shaped AS (SELECT host, good, l, array_to_string(l[-2:], '.') AS two FROM parts),
hosts AS (
  SELECT host,
    any_value(CASE WHEN two IN ('co.uk','org.uk','ac.uk','gov.uk','com.au','com.br','co.jp','co.nz','co.in','com.cn') THEN array_to_string(l[-3:], '.') ELSE two END) AS domain,
    any_value(CASE WHEN two IN ('co.uk','org.uk','ac.uk','gov.uk','com.au','com.br','co.jp','co.nz','co.in','com.cn') THEN two ELSE l[-1] END) AS suffix,
    sum(good)::BIGINT AS good, count(*) AS n
  FROM shaped GROUP BY host),
domains AS (SELECT domain, suffix, sum(good)::BIGINT AS good, sum(n)::BIGINT AS n FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(good)::BIGINT AS good, sum(n)::BIGINT AS n FROM domains GROUP BY ALL),
s0 AS (SELECT *, (SELECT (sum(good) + 0.5::DOUBLE) / (sum(n) + 1.0::DOUBLE) FROM suffixes) AS prior FROM suffixes),
s1 AS (SELECT coalesce(least(greatest(1 / greatest(sum((pow(good - n * prior, 2) / (prior * (1 - prior)) - n)::DECIMAL(30, 9))::DOUBLE / nullif(sum(n * (n - 1)), 0)::DOUBLE, 1e-9) - 1, 2), 1000), 1000) AS s FROM s0),
s2 AS (SELECT suffix, (s * prior + good) / (s + n) AS mean FROM s0, s1),
d0 AS (SELECT domains.*, mean AS prior FROM domains JOIN s2 USING (suffix)),
d1 AS (SELECT coalesce(least(greatest(1 / greatest(sum((pow(good - n * prior, 2) / (prior * (1 - prior)) - n)::DECIMAL(30, 9))::DOUBLE / nullif(sum(n * (n - 1)), 0)::DOUBLE, 1e-9) - 1, 2), 1000), 1000) AS s FROM d0),
d2 AS (SELECT domain, (s * prior + good) / (s + n) AS mean FROM d0, d1),
h0 AS (SELECT hosts.*, mean AS prior FROM hosts JOIN d2 USING (domain)),
h1 AS (SELECT coalesce(least(greatest(1 / greatest(sum((pow(good - n * prior, 2) / (prior * (1 - prior)) - n)::DECIMAL(30, 9))::DOUBLE / nullif(sum(n * (n - 1)), 0)::DOUBLE, 1e-9) - 1, 2), 1000), 1000) AS s FROM h0),
h2 AS (SELECT host, good, n, (s * prior + good) / (s + n) AS mean, s + n AS total FROM h0, h1),
reputation AS (SELECT host, good, n, mean, mean + 2 * sqrt(mean * (1 - mean) / (total + 1)) AS upper FROM h2),
rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
judged AS (
  SELECT DISTINCT ON (u.host, u.path) u.host, u.path, r.host || r.path AS rule, r.verdict
  FROM (SELECT DISTINCT host, path FROM urls) u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  ORDER BY u.host, u.path, length(r.host || r.path) DESC, length(r.host) DESC)
SELECT page_id, urls.host, urls.path, rule, coalesce(verdict, CASE WHEN upper < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(good, 0)::BIGINT AS good, coalesce(n, 0)::BIGINT AS n, round(mean, 6) AS reputation, round(upper, 6) AS upper
FROM urls LEFT JOIN reputation USING (host) LEFT JOIN judged ON judged.host = urls.host AND judged.path = urls.path
"""

MIX = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix|' || coalesce(doc_id::VARCHAR, 'null')) AS place FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sizes GROUP BY source),
shares AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER filled, 0) AS left_words,
    sum(weight) OVER () - coalesce(sum(weight) OVER filled, 0) AS left_weight
  FROM ranked WINDOW filled AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, left_words::DOUBLE / left_weight AS lv, cap <= left_words::DOUBLE / left_weight * weight AS capped FROM shares),
targets AS (
  SELECT source, source_size, CASE WHEN capped OR max(CASE WHEN NOT capped THEN lv END) OVER () IS NULL THEN cap::DOUBLE
    ELSE max(CASE WHEN NOT capped THEN lv END) OVER () * weight END AS target FROM levels),
queued AS (
  SELECT s.doc_id, s.place, s.size, t.source_size, t.target,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id NULLS FIRST, s.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
served AS (
  SELECT *, (e * source_size + upto)::DOUBLE / target AS finish FROM queued, (VALUES (0), (1), (2)) AS v(e) WHERE size > 0),
cut AS (
  SELECT doc_id, place, size, finish,
    coalesce(sum(size) OVER (ORDER BY finish, place, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM served),
taken AS (SELECT doc_id, place, count(*) AS repeats FROM cut WHERE before < (SELECT sum(size) FROM sizes) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size::BIGINT AS source_size, q.target, (q.size * coalesce(t.repeats, 0))::BIGINT AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id IS NOT DISTINCT FROM t.doc_id
"""


NEAR_DUPLICATES = r"""
WITH RECURSIVE toks AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+3], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM toks WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
twoway AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN twoway l ON l.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) m USING (doc_id)
"""


TOP_K = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, generate_subscripts(vec, 1) AS i, unnest(vec) AS x FROM v),
scores AS (
  SELECT q.vec_id AS query_id, r.vec_id, sum(q.x * r.x)::BIGINT AS score
  FROM parts q JOIN parts r ON q.i = r.i AND q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


DIVERGENCE = r"""
WITH lists(lang, wanted) AS (VALUES
  ('en', ['the','of','and','to','in','a','is','that','for','it','with','as','was','on','be','at','by','this','from','are']),
  ('de', ['der','die','und','in','den','von','zu','das','mit','sich','des','auf','für','ist','im','dem','nicht','ein','eine','als']),
  ('fr', ['de','la','le','et','les','des','en','un','du','une','que','est','pour','qui','dans','a','par','plus','pas','au']),
  ('es', ['de','la','que','el','en','y','a','los','se','del','las','un','por','con','no','una','su','para','es','al'])),
every AS (SELECT list_sort(list_distinct(flatten(list(wanted)))) AS wanted FROM lists),
plain AS (
  SELECT lang, lower(w) AS word, count(*) AS n
  FROM (SELECT lang, unnest(string_split_regex(text, '[\x20\x09-\x0D]+')) AS w FROM documents WHERE lang IS NOT NULL AND lang NOT IN (SELECT lang FROM lists))
  WHERE regexp_matches(w, '^\p{L}\p{Ll}*$') GROUP BY ALL),
own AS (
  SELECT lang, list(word ORDER BY word) AS wanted FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM plain)
  WHERE place <= 20 GROUP BY lang),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(d.lang, chr(1)) AS lang,
    CASE WHEN lists.lang IS NOT NULL THEN lists.wanted WHEN d.lang IS NULL THEN every.wanted ELSE coalesce(own.wanted, []) END AS wanted,
    CASE WHEN lists.lang IS NOT NULL OR d.lang IS NULL THEN every.wanted ELSE coalesce(own.wanted, []) END AS every, t,
    regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
    regexp_replace(t, '[\x20\x09-\x0D\p{Ll}]+', '', 'g') AS large
  FROM (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents) d LEFT JOIN lists ON lists.lang = d.lang LEFT JOIN own ON own.lang = d.lang, every),
windows AS (SELECT rid, i, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM docs WHERE len(w) > 5)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, (VALUES (0), (1), (2), (3), (4)) AS o(j) GROUP BY rid),
counts AS MATERIALIZED (
  SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(large, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    list_transform(['[^\p{Lu}]+', '[^0-9]+', '[^.,;:''()"\-]+', '[^!?]+', '[^#*$%&|<>{}\[\]=~^_\\@+/]+'], lambda c: length(regexp_replace(large, c, '', 'g'))) AS kinds,
    length(array_to_string(w, '')) - length(large) AS small,
    list_transform(list_filter(w, lambda x: list_contains(every, x) OR list_contains(list_transform(every, lambda e: upper(e[1]) || e[2:]), x)), lambda x: lower(x)) AS known, wanted
  FROM docs LEFT JOIN covered USING (rid)),
common AS (SELECT *, list_transform(wanted, lambda v: len(list_filter(known, lambda x: x = v))) AS found FROM counts),
bins AS MATERIALIZED (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    list_concat(kinds, [small, word_chars - list_sum(kinds) - small])::BIGINT[] AS chars, list_concat(found, [n_words - list_sum(found)])::BIGINT[] AS words
  FROM common),
ref_chars AS (SELECT lang, list(s ORDER BY i) AS r FROM (SELECT lang, i, sum(x)::BIGINT AS s FROM (SELECT lang, generate_subscripts(chars, 1) AS i, unnest(chars) AS x FROM bins WHERE NOT base_failed) GROUP BY 1, 2) GROUP BY 1),
ref_words AS (SELECT lang, list(s ORDER BY i) AS r FROM (SELECT lang, i, sum(x)::BIGINT AS s FROM (SELECT lang, generate_subscripts(words, 1) AS i, unnest(words) AS x FROM bins WHERE NOT base_failed) GROUP BY 1, 2) GROUP BY 1),
pairs AS (
  SELECT bins.*,
    list_transform(list_zip(chars, c.r), lambda z: [z[1] / nullif(list_sum(chars), 0), z[2] / nullif(list_sum(c.r), 0)]) AS pc,
    list_transform(list_zip(words, v.r), lambda z: [z[1] / nullif(list_sum(words), 0), z[2] / nullif(list_sum(v.r), 0)]) AS pw
  FROM bins LEFT JOIN ref_chars c USING (lang) LEFT JOIN ref_words v USING (lang)),
distances AS (
  SELECT *,
    CASE WHEN list_sum(chars) > 0 THEN sqrt(greatest(list_sum(list_transform(pc, lambda z: (CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0 END + CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0 END) / 2)), 0)) END AS jc,
    CASE WHEN list_sum(words) > 0 THEN sqrt(greatest(list_sum(list_transform(pw, lambda z: (CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0 END + CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0 END) / 2)), 0)) END AS jw
  FROM pairs)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(jc, 6) AS js_chars, round(jw, 6) AS js_common,
  NOT base_failed AND NOT (n_words >= 100 AND (coalesce(jc, 0) > 0.30 OR coalesce(jw, 0) > 0.32)) AS kept
FROM distances
"""

SPELLING = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents) GROUP BY ALL),
bytes AS (SELECT *, hex(id || ':' || run) AS x FROM runs WHERE length(run) >= 7),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i+1])::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS h FROM bytes, crc),
typed AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
lost AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM lost a JOIN lost b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM lost a JOIN words b ON b.word = a.rest
  UNION SELECT b.word, a.word, a.n FROM lost a JOIN words b ON b.word = a.rest),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS other, max(other_n) AS other_n FROM near GROUP BY word),
links AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * words.n THEN other END AS form, CASE WHEN other_n >= 10 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
ways(word, reached, step) AS (SELECT word, word, 0 FROM links UNION ALL SELECT ways.word, links.form, step + 1 FROM ways JOIN links ON links.word = ways.reached WHERE links.form IS NOT NULL),
ends AS (SELECT word, arg_max(reached, step) AS root FROM ways GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM links JOIN ends USING (word)
"""

HARD_NEGATIVES = r"""
WITH v AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT DISTINCT ON (vec_id) * FROM v WHERE vec_id % 100 = 0 ORDER BY vec_id, label, x),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM anchors a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_reputation": URL_REPUTATION,
        "op2_parity_jaccard": NEAR_DUPLICATES,
        "op3_cover_tree_topk": TOP_K,
        "op4_divergence_rules": DIVERGENCE,
        "op5_weighted_fair_mix": MIX,
        "op11_spelling_variants": SPELLING,
        "op13_segment_negatives": HARD_NEGATIVES,
    }
