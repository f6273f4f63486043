"""DuckDB SQL of the text queries that SQL can express."""

from clusterloom.llm import fill_middle, mixing, url_model, variant_grams, warc

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP5 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS t FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE c = na.n AND c = nb.n),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.b FROM r JOIN l ON r.y = l.a),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY 1),
k AS (SELECT a AS x, min(b) AS other FROM e GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, least(d.doc_id, coalesce(k.other, d.doc_id)) AS class_id
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.x = d.doc_id LEFT JOIN k ON k.x = d.doc_id
"""

OP3 = f"""
WITH norm AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 10 THEN list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS t, least(len(w), 10) AS size FROM item),
sizes AS (SELECT DISTINCT size FROM win),
place AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM norm, sizes WHERE len(w) >= size),
occ AS (SELECT doc_id, i, x.size, item_id FROM place x JOIN win y ON x.size = y.size AND array_to_string(w[i:i + x.size - 1], ' ') = y.t),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM occ) GROUP BY 1),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM norm LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)
"""


def _quoted(text: str) -> str:
    """A DuckDB string literal with its control characters."""
    return "E'" + text.replace("\\", "\\\\").replace("'", "''").replace("\t", "\\t").replace("\r", "\\r").replace("\n", "\\n").replace("\f", "\\f") + "'"


def _uuid(parts: str) -> str:
    return f"'urn:uuid:' || regexp_replace(md5(concat_ws('|', {parts})), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def _plain_text(html: str, steps=warc.TEXT_STEPS) -> str:
    for pattern, by in steps:
        html = f"regexp_replace({html}, {_quoted(pattern)}, {_quoted(by)}, 'g')"
    return html


def _decoded() -> str:
    """The text column ``t`` with its references decoded: its parts at each &, the first as it is."""
    names = ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in warc.NAMES.items())
    ref = f"regexp_extract(p, '^(#[0-9]{{1,9}}|#[xX][0-9A-Fa-f]{{1,8}}|[A-Za-z][A-Za-z0-9]{{0,{warc.LONGEST_NAME - 1}}});', 1)"
    number = "CASE WHEN lower(substr(r, 2, 1)) = 'x' THEN ('0x' || lpad(substr(r, 3), 8, '0'))::BIGINT ELSE substr(r, 2)::BIGINT END"
    return f"""
entity AS MATERIALIZED (SELECT MAP {{{names}}} AS m),
parts AS (SELECT i, unnest(string_split(t, '&')) AS p, generate_subscripts(string_split(t, '&'), 1) AS j FROM plain),
refs AS (SELECT *, CASE WHEN j > 1 THEN {ref} ELSE '' END AS r FROM parts),
chars AS (SELECT *, CASE WHEN r LIKE '#%' THEN CASE WHEN {number} BETWEEN 1 AND 1114111 AND NOT {number} BETWEEN 55296 AND 57343 THEN chr(({number})::INTEGER) ELSE chr(65533) END WHEN r <> '' THEN m[r] END AS ch FROM refs, entity),
joined AS (SELECT i, string_agg(CASE WHEN j = 1 THEN p WHEN ch IS NULL THEN '&' || p ELSE ch || substr(p, length(r) + 2) END, '' ORDER BY j) AS body FROM chars GROUP BY 1)"""


OP7 = f"""
WITH p AS (SELECT row_number() OVER () AS i, page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload FROM pages),
plain AS (SELECT i, {_plain_text("payload")} AS t FROM p),{_decoded()},
h AS (SELECT *, {_quoted("HTTP/1.1 200 OK" + warc.CRLF + "Content-Type: text/html; charset=utf-8" + warc.CRLF + "Content-Length: ")} || strlen(payload) || {_quoted(warc.CRLF * 2)} AS source_headers, 'sha256:' || sha256(payload) AS source_payload_digest FROM p),
r AS (SELECT *, 'sha256:' || sha256(source_headers || payload) AS source_block_digest, {_uuid("'response', coalesce(page_id::VARCHAR, ''), target_uri, source_payload_digest")} AS refers_to,
  trim(regexp_replace(regexp_extract({_plain_text("payload", warc.UNSHOWN)}, {_quoted("(?is)<title(?:[ \t\r\n][^>]*)?>(.*?)</title")}, 1), {_quoted("[ \t\r\n]+")}, ' ', 'g')) AS title,
  regexp_extract(payload, {_quoted("(?i)<html[^>]*[ \t\r\n]lang=[\"']?([A-Za-z0-9-]+)")}, 1) AS lang,
  len(regexp_extract_all(payload, {_quoted("(?i)<a[ \t\r\n][^>]*href")})) AS links FROM h),
b AS (
  SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS content_type, concat('title: ', title, {_quoted(warc.CRLF)}, 'language: ', lang, {_quoted(warc.CRLF)}, 'outlinks: ', links, {_quoted(warc.CRLF)},
    'source-payload-digest: ', source_payload_digest, {_quoted(warc.CRLF)}, 'source-block-digest: ', source_block_digest, {_quoted(warc.CRLF)}) AS body FROM r
  UNION ALL SELECT r.*, 'conversion', 'text/plain; charset=utf-8', regexp_replace(regexp_replace(joined.body, {_quoted("^[ " + chr(10) + "]+")}, ''), {_quoted("[ " + chr(10) + "]+$")}, '') FROM r JOIN joined USING (i))
SELECT page_id, warc_type, {_uuid("warc_type, refers_to")} AS record_id, refers_to, target_uri, '{warc.DATE}' AS date, content_type, strlen(body) AS content_length, 'sha256:' || sha256(body) AS block_digest,
  source_payload_digest, source_block_digest, source_headers, body FROM b
"""


def _op6() -> str:
    u, k = url_model, url_model.ORDER
    rule = verdict = "NULL"
    for h, p, v in sorted(u.RULES, key=lambda r: (len(r[0] + r[1]), r)):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{h}{p}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{v}' ELSE {verdict} END"
    orders = []
    for m in range(1, k + 2):
        lower = ("1 / 256.0", "1 / 256.0", "") if m == 1 else ("l.pa", "l.pr", f"JOIN m{m - 1} l ON l.gram = substr(c.gram, 2)")
        least = f"HAVING sum(a) + sum(r) >= {u.LEAST_CONTEXT if m > 1 else 0}"
        orders.append(
            f"m{m} AS MATERIALIZED (SELECT c.gram, (c.a + {u.SMOOTH} * {lower[0]}) / (t.na + {u.SMOOTH}) AS pa, (c.r + {u.SMOOTH} * {lower[1]}) / (t.nr + {u.SMOOTH}) AS pr FROM counts c "
            f"JOIN (SELECT substr(gram, 1, {m - 1}) AS context, sum(a)::DOUBLE AS na, sum(r)::DOUBLE AS nr FROM counts WHERE length(gram) = {m} GROUP BY 1 {least}) t ON t.context = substr(c.gram, 1, {m - 1}) {lower[2]} WHERE length(c.gram) = {m})"
        )
    best = "coalesce(" + ", ".join(f"ln(x{m}.pa) - ln(x{m}.pr)" for m in range(k + 1, 0, -1)) + ", 0)"
    joins = " ".join(f"LEFT JOIN m{m} x{m} ON i >= {m} AND x{m}.gram = substr(t, i - {m - 1}, {m})" for m in range(1, k + 2))
    draw = "('0x' || substr(md5(page_id::VARCHAR), {}, 8))::BIGINT / 4294967296.0"
    return f"""
WITH s AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM s),
base AS (SELECT *, {rule} AS rule, {verdict} AS ruled, '^' || translate(rest, '{UPPER}', '{LOWER}') || '$' AS t FROM h),
sized AS (SELECT *, ruled IS NOT NULL AND {draw.format(1)} < {u.TRAIN_URLS} / (count(*) OVER (PARTITION BY ruled))::DOUBLE AS keep, {draw.format(9)} < 0.2 AS held FROM base),
fitted AS (SELECT t, ruled = 'allow' AS accepted FROM sized WHERE keep AND NOT held),
chars AS (SELECT t, accepted, unnest(range(2, length(t) + 1)) AS i FROM fitted),
grams AS (SELECT accepted, substr(t, i - k, k + 1) AS gram FROM chars, range(0, {k + 1}) o(k) WHERE i > k),
counts AS MATERIALIZED (SELECT gram, count(*) FILTER (accepted) AS a, count(*) FILTER (NOT accepted) AS r FROM grams GROUP BY 1),
{", ".join(orders)},
place AS (SELECT page_id, t, unnest(range(2, length(t) + 1)) AS i FROM base),
scores AS (SELECT page_id, round(sum({best}) / count(*), 9) AS score FROM place {joins} GROUP BY 1),
cut AS (SELECT coalesce(round(quantile_cont(score, {u.MISSED}), 9), 0) AS cut FROM sized JOIN scores USING (page_id) WHERE keep AND held AND ruled = 'allow')
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score >= cut THEN 'allow' ELSE 'block' END) AS verdict, score FROM base JOIN scores USING (page_id), cut
"""


def _op1() -> str:
    m, names, targets = mixing, list(mixing.TARGETS), list(mixing.TARGETS.values())
    ks = range(len(names))
    listed = ", ".join(f"'{d}'" for d in names)
    draw = "('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0"
    each = lambda f, sep=", ": sep.join(f(k) for k in ks)
    steps = ["r0 AS MATERIALIZED (SELECT c.*, 1.0::DOUBLE AS r FROM cells c)", "t0 AS MATERIALIZED (SELECT sum(tokens)::DOUBLE AS total FROM cells)"]
    steps.append("w AS MATERIALIZED (SELECT " + each(lambda k: f"1 / greatest(sum(tokens * (h{k} / 100.0::DOUBLE)) / any_value(total), 1e-6) AS w{k}") + " FROM cells, t0)")
    for n in range(m.STEPS):
        steps.append(f"g{n} AS MATERIALIZED (SELECT " + each(lambda k: f"any_value(w{k}) * (sum(tokens * (h{k} / 100.0::DOUBLE) * r) / any_value(total) - {targets[k]!r}::DOUBLE) AS g{k}") + f" FROM r{n}, t0, w)")
        steps.append(f"r{n + 1} AS MATERIALIZED (SELECT r{n}.* REPLACE (greatest(0, r - (" + each(lambda k: f"h{k} / 100.0::DOUBLE * g{k}", " + ") + f")) AS r) FROM r{n}, g{n})")
    return f"""
WITH lab AS (SELECT doc_id, CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END || CASE toxic WHEN 1 THEN '_toxic' WHEN 0 THEN '' END AS domain FROM labels),
known AS (SELECT * FROM lab WHERE domain IN ({listed})),
chosen AS MATERIALIZED (SELECT * FROM known WHERE {draw} < {m.TRAIN_DOCS} / (SELECT greatest(count(*), 1) FROM known)::DOUBLE),
n AS MATERIALIZED (SELECT count(*)::DOUBLE AS n, {each(lambda k: f"count(*) FILTER (domain = '{names[k]}')::DOUBLE AS n{k}")} FROM chosen),
split AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
words AS MATERIALIZED (SELECT doc_id, substr(unnest(ws), 1, {m.WORD_LENGTH}) AS w FROM split),
perdoc AS (SELECT doc_id, domain, w, count(*) AS c FROM words JOIN chosen USING (doc_id) GROUP BY ALL),
counts AS (SELECT w, count(*)::DOUBLE AS seen, {each(lambda k: f"count(*) FILTER (domain = '{names[k]}')::DOUBLE AS d{k}, coalesce(sum(c) FILTER (domain = '{names[k]}'), 0) AS c{k}")} FROM perdoc GROUP BY 1),
chi AS (SELECT counts.*, round({each(lambda k: f"CASE WHEN n{k} > 0 THEN (d{k} - seen * (n{k} / n)) * (d{k} - seen * (n{k} / n)) / (seen * (n{k} / n)) ELSE 0 END", " + ")}, 6) AS chi FROM counts, n),
best AS MATERIALIZED (SELECT * FROM chi WHERE chi >= {m.LEAST_CHI} ORDER BY chi DESC, w LIMIT {m.WORDS}),
tot AS MATERIALIZED (SELECT count(*) AS m, {each(lambda k: f"coalesce(sum(c{k}), 0) AS s{k}")} FROM best),
model AS MATERIALIZED (SELECT w, {each(lambda k: f"ln((c{k} + 1.0::DOUBLE) / (s{k} + m)::DOUBLE) AS v{k}")} FROM best, tot),
summed AS (SELECT doc_id, count(words.w) AS nt, count(v0) AS m, {each(lambda k: f"coalesce(sum(v{k}), 0) AS v{k}")} FROM split LEFT JOIN words USING (doc_id) LEFT JOIN model ON model.w = words.w GROUP BY 1),
z AS (SELECT doc_id, nt, {each(lambda k: f"ln((n{k} + 1) / (n + {len(names)})) + v{k} * least(1.0::DOUBLE, {m.FULL_WORDS}.0::DOUBLE / greatest(m, 1)) AS v{k}")} FROM summed, n),
e AS (SELECT doc_id, nt, {each(lambda k: f"exp(v{k} - greatest({each(lambda j: f'v{j}')})) AS v{k}")} FROM z),
hs AS (SELECT doc_id, nt, {", ".join(f"floor(100 * v{k} / ({each(lambda j: f'v{j}', ' + ')}) + 1e-6)::INTEGER AS h{k}" for k in ks if k)} FROM e),
post AS MATERIALIZED (SELECT *, 100 - ({" + ".join(f"h{k}" for k in ks if k)}) AS h0 FROM hs),
cells AS MATERIALIZED (SELECT {each(lambda k: f"h{k}")}, sum(nt) AS tokens FROM post GROUP BY ALL),
{", ".join(steps)}
SELECT doc_id, nt AS n_tokens, {each(lambda k: f"post.h{k} / 100.0::DOUBLE AS p_{names[k]}")}, round(r, 6) AS rate, floor(round(r, 6) + {draw})::INTEGER AS n_copies
FROM post JOIN r{m.STEPS} USING ({each(lambda k: f"h{k}")})
"""


OP6, OP1 = _op6(), _op1()


def _op11() -> str:
    draw = lambda k: f"('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), {8 * k + 1}, 8))::BIGINT"
    p, s, m = fill_middle.PREFIX, fill_middle.SUFFIX, fill_middle.MIDDLE
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u, {draw(0)} AS h1, {draw(1)} AS h2, {draw(3)} AS h4 FROM documents),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
x AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{p}' || pre || '{s}' || suf || '{m}' || mid ELSE '{s}' || suf || '{p}' || pre || '{m}' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM x
"""


def _op12() -> str:
    v = variant_grams
    byte = "list_transform(range(1, strlen(k) + 1), lambda i: ('0x' || substr(hex(encode(k)), 2 * i - 1, 2))::BIGINT)"
    return f"""
WITH RECURSIVE codes AS MATERIALIZED (SELECT list(list_reduce(range(8), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS code FROM range(256) r(i)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
once AS MATERIALIZED (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS k, run, count(*) AS c FROM runs GROUP BY 1, 2),
crc AS (SELECT run, c, xor(list_reduce({byte}, lambda s, b: xor(s >> 8, code[(xor(s, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM once, codes),
drawn AS (SELECT CASE WHEN h % {v.DROP_EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM crc),
words AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM drawn WHERE length(word) >= {v.LEAST_LENGTH} GROUP BY 1 HAVING sum(c) >= {v.LEAST_COUNT}),
cut AS MATERIALIZED (SELECT word, length(word) AS l, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.l = y.l AND x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT cut.word, w.word FROM cut JOIN words w ON w.word = cut.rest UNION SELECT w.word, cut.word FROM cut JOIN words w ON w.word = cut.rest),
best AS (SELECT a, count(*) AS n_near, max(n) AS m, first(b ORDER BY n DESC, b) AS b FROM pairs JOIN words ON word = b GROUP BY 1),
judged AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {v.RATIO} * n THEN b END AS form, CASE WHEN m >= {v.RATIO} * n THEN m END AS form_n FROM words LEFT JOIN best ON a = word),
way(word, last, up) AS (SELECT word, word, form FROM judged UNION ALL SELECT way.word, j.word, j.form FROM way JOIN judged j ON j.word = way.up)
SELECT j.word, j.form, way.last AS root, j.n, j.n_near, j.form_n FROM judged j JOIN way ON way.word = j.word AND way.up IS NULL
"""


OP11, OP12 = _op11(), _op12()

ORACLES = {"op1_mixing": OP1, "op3_decontamination": OP3, "op5_jaccard_join": OP5, "op6_url_filter": OP6, "op7_warc_derivatives": OP7, "op11_fill_middle": OP11, "op12_spelling_variants": OP12}
