"""SQL that gives the same rows as the queries of this subpackage, where SQL can express them."""

from glossa.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

SQL: dict[str, str] = {
    "op1_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS x FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d),
hits AS (SELECT p.doc_id, p.k, i.n, i.item_id FROM (SELECT DISTINCT n FROM iw) s JOIN p ON p.k + s.n - 1 <= len(p.w) JOIN iw i ON i.n = s.n AND i.x = array_to_string(p.w[p.k:p.k + s.n - 1], ' ')),
iw2 AS (SELECT item_id, j, n, array_to_string(w[j:j + n - 1], ' ') AS x FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS j FROM b WHERE len(w) > 0)),
runs AS (SELECT doc_id, item_id, n, k, k - j AS diagonal, k - row_number() OVER (PARTITION BY doc_id, item_id, n, k - j ORDER BY k) AS run FROM (SELECT DISTINCT h.doc_id, h.item_id, h.n, h.k, i.j FROM hits h JOIN d USING (doc_id) JOIN iw2 i ON i.item_id = h.item_id AND i.n = h.n AND i.x = array_to_string(d.w[h.k:h.k + h.n - 1], ' '))),
longest AS (SELECT doc_id, min(row(-span, pos, item)) AS best FROM (SELECT doc_id, CAST(item_id AS VARCHAR) AS item, min(k) - 1 AS pos, count(*) + n - 1 AS span FROM runs GROUP BY doc_id, item_id, n, diagonal, run) GROUP BY 1),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS k FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, (-best[1])::BIGINT AS longest_words, best[2]::BIGINT AS longest_at, best[3] AS longest_item
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)""",
    # the tables' pages mark their main text, so SQL can read it off the mark, which the operator never does
    "op2_main_text": r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(coalesce(regexp_extract(html, '<article>(.*)</article>', 1, 's'), ''), '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS x FROM pages),
u AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(x, '&#x27;', chr(39)), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', chr(34), 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM u""",
    "op7_warc_revisits": r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to FROM g""",
    "op10_line_dedup": r"""
WITH r0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS no FROM documents),
l AS (SELECT doc_id, no, raw, list_filter(string_split(translate(raw, chr(9) || chr(11) || chr(12) || chr(13), '    '), ' '), lambda x: x <> '') AS ws FROM r0),
firsts AS (SELECT ws, min(doc_id * 2147483648 + no) AS first FROM l WHERE len(ws) > 0 GROUP BY 1),
big AS (SELECT *, len(ts) AS n FROM (SELECT row_number() OVER () AS id, ws, first, CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' '))) END AS ts FROM firsts)),
t AS (SELECT id, n, unnest(ts) AS token FROM big),
f AS (SELECT token, count(*) AS m FROM t GROUP BY 1),
o AS (SELECT id, n, token, row_number() OVER (PARTITION BY id ORDER BY m, token) AS pos FROM t JOIN f USING (token)),
pre AS (SELECT * FROM o WHERE pos <= n - ceil(0.8 * n - 1e-9) + 1),
pairs AS (SELECT DISTINCT x.id AS x, y.id AS y FROM pre x JOIN pre y ON x.token = y.token AND x.id < y.id AND x.n >= 0.8 * y.n - 1e-9 AND y.n >= 0.8 * x.n - 1e-9),
alike AS (SELECT a.id AS x, b.id AS y, a.first AS fx, b.first AS fy, len(list_intersect(a.ts, b.ts)) AS k, a.n + b.n AS n FROM pairs JOIN big a ON a.id = pairs.x JOIN big b ON b.id = pairs.y),
dup AS (SELECT DISTINCT CASE WHEN fx > fy THEN x ELSE y END AS id FROM alike WHERE k >= 0.8 * (n - k) - 1e-9),
marks AS (SELECT big.ws, big.first, dup.id IS NOT NULL AS dup FROM big LEFT JOIN dup USING (id)),
kept AS (SELECT l.doc_id, l.no, l.raw, m.ws IS NOT NULL AND (m.dup OR m.first <> l.doc_id * 2147483648 + l.no) AS gone FROM l LEFT JOIN marks m ON m.ws = l.ws),
r AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY no) FILTER (NOT gone) AS text, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed FROM kept GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(r.text, '') END AS text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed FROM documents d LEFT JOIN r USING (doc_id)""",
    "op11_source_mix": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS z, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS no FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][no % 3 + 1] AS w, z * 2.0 / [5, 2, 1][no % 3 + 1] AS ratio FROM s),
r AS (SELECT *, (SELECT sum(z) FROM s)::DOUBLE * 1.5 - 2.0 * coalesce(sum(z) OVER before, 0)::DOUBLE AS rest, ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER before, 0))::DOUBLE AS over_w FROM w WINDOW before AS (ORDER BY ratio, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT rest, over_w FROM r WHERE ratio >= rest / over_w ORDER BY ratio, no LIMIT 1),
t AS (SELECT source, z, least(z * 2.0::DOUBLE, w.w * l.rest / l.over_w)::DOUBLE AS target FROM w, l),
b AS (SELECT *, CASE WHEN z > 0 THEN floor(target / z) ELSE 0 END AS whole FROM t),
g AS (SELECT source, key, sum(size) AS n, sum(sum(size)) OVER (PARTITION BY source ORDER BY key) AS upto FROM d GROUP BY source, key)
SELECT d.doc_id, d.size, b.z AS source_size, b.target, (d.size * (b.whole + (2.0::DOUBLE * (g.upto - g.n)::DOUBLE + g.n::DOUBLE <= 2.0::DOUBLE * (b.target - b.whole * b.z))::INT))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN g ON d.source IS NOT DISTINCT FROM g.source AND d.key = g.key
""",
    "op12_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
o AS (SELECT lang, w, s.n, unnest(range(1, len(w) - s.n + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) s(n) WHERE len(w) >= s.n),
g AS (SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase, count(*)::BIGINT AS f FROM o GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, n, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE n > 1),
sub AS (SELECT c.lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM (SELECT *, unnest(range(1, n - m + 2)) AS i FROM (SELECT *, unnest(range(2, n)) AS m FROM c)) c GROUP BY ALL),
k AS (SELECT c.* FROM c LEFT JOIN sub USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
x AS (SELECT *, unnest(range(1, n)) AS cut FROM k),
s AS (SELECT x.lang, x.phrase, a, cut, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f::HUGEINT + r.f::HUGEINT))::BIGINT AS score
FROM x JOIN g l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:cut], ' ') JOIN g r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, t.n, score FROM z JOIN t USING (lang) WHERE rank <= 2000
""",
    "op13_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
n AS (SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid, coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
""",
}


def _license_sql() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = r"regexp_extract_all(" + lower + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    rows = ", ".join(f"('{label}', '{text}', '{required}')" for label, text, required in TEMPLATES)
    hits = " UNION ALL ".join(f"SELECT doc_id, k - 1 AS word, '{label}' AS label FROM p WHERE array_to_string(ws[k:k + {len(phrase.split()) - 1}], ' ') = '{phrase}'" for phrase, label in PHRASES.items())
    return rf"""
WITH w AS (SELECT doc_id, {words.format("coalesce(text, '')")} AS ws FROM documents),
t AS (SELECT label, list_distinct(ts) AS ts, len(ts) + len(ts) // 8 AS width, string_split(req, ' ') AS req FROM (SELECT label, {words.format("body")} AS ts, req FROM (VALUES {rows}) v(label, body, req))),
c AS (SELECT doc_id, ws, label, ts, width, req FROM (SELECT doc_id, ws, list_distinct(ws) AS ds FROM w) JOIN t ON list_has_all(ds, req) AND len(list_intersect(ds, ts)) >= ceil({THRESHOLD} * len(ts) - 1e-9)),
b AS (SELECT label, ts, req, doc_id, list_distinct(ws[k:k + width - 1]) AS block FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS k FROM c)),
f AS (SELECT doc_id, label, max(len(list_intersect(block, ts)) / len(ts)) AS share FROM b WHERE list_has_all(block, req) AND len(list_intersect(block, ts)) >= ceil({THRESHOLD} * len(ts) - 1e-9) GROUP BY 1, 2),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS k FROM w),
h AS ({hits}),
base AS (SELECT doc_id, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word FROM h GROUP BY 1),
both_ AS (SELECT DISTINCT doc_id, label FROM (SELECT doc_id, label FROM h UNION ALL SELECT doc_id, label FROM f)),
listed AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM both_ GROUP BY 1),
named AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS base_labels FROM (SELECT DISTINCT doc_id, label FROM h) GROUP BY 1),
best AS (SELECT doc_id, max(share) AS share FROM f GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
 CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)"""


SQL["op6_license_scan"] = _license_sql()
