"""The registered queries of this subpackage in DuckDB's SQL."""

from __future__ import annotations

import hashlib

from haulmetrics.llm.decontamination import UNITS


def url_filters(entries: str, host: str) -> str:
    path = r"^[^/?#]*//[^/?#]*([^?#]*)"
    return f"""
WITH pg AS (SELECT page_id, DATE '2024-01-01' + CAST(page_id % 366 AS INT) AS day, coalesce(regexp_extract(url, '{path}', 1), '') AS path,
            regexp_replace(lower(coalesce(regexp_extract(url, '{host}', 1), '')), '[.]$', '') AS host FROM pages),
captured AS (SELECT DISTINCT host FROM pg),
words AS (SELECT DISTINCT unnest(string_split_regex(host, '[.-]')) AS unnest_words FROM pg),
entries AS ({entries}),
dated AS (SELECT list, kind, rule, CAST(day AS DATE) AS day, max(action) AS action FROM entries GROUP BY ALL),
spans AS (SELECT *, lead(day) OVER (PARTITION BY list, kind, rule ORDER BY day) AS until FROM dated),
keys AS (
  SELECT page_id, host, day, 'domain' AS kind, unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS rule FROM pg WHERE host <> ''
  UNION ALL SELECT page_id, host, day, 'word', unnest(list_distinct(string_split_regex(host, '[.-]'))) FROM pg WHERE host <> ''
  UNION ALL SELECT page_id, host, day, 'path', unnest(list_distinct(list_transform(range(1, len(string_split(path, '/')) + 1), lambda i: host || array_to_string(string_split(path, '/')[1:i], '/')))) FROM pg WHERE host <> ''),
hits AS (SELECT page_id, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM keys JOIN spans USING (kind, rule)
         WHERE action = 'add' AND keys.day >= spans.day AND (until IS NULL OR keys.day < until) GROUP BY page_id)
SELECT page_id, CAST(day AS DATE) AS day, host, coalesce(n, 0) AS n_active, coalesce(lists, '') AS lists, coalesce(n, 0) > 0 AS blocked
FROM pg LEFT JOIN hits USING (page_id)"""


def sharding(size: int, shards: int, seed: str) -> str:
    """The table as a text of two hex digits a slot; filled here turn by turn, apart from the operator."""
    def number(what: str) -> int:
        return int(hashlib.md5(f"{seed}/{what}".encode()).hexdigest()[:16], 16)

    def order(s: int):
        start, stride = number(f"{s}/start"), number(f"{s}/stride") % (size - 1) + 1
        return ((start + k * stride) % size for k in range(size))
    orders = [order(s) for s in range(shards)]
    owner: dict[int, int] = {}
    while len(owner) < size:
        for s, order in enumerate(orders):
            if len(owner) < size:
                owner[next(p for p in order if p not in owner)] = s
    table = "".join(f"{owner[p]:02x}" for p in range(size))
    return f"""
WITH keyed AS (SELECT doc_id, md5('{seed}/' || coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, '')))) AS order_key FROM documents),
placed AS (SELECT *, CAST(('0x' || order_key[1:12]) AS BIGINT) % {size} AS slot FROM keyed)
SELECT doc_id, slot, CAST(('0x' || substr('{table}', 2 * slot + 1, 2)) AS INT) AS shard, order_key FROM placed"""


def _pour(parent: str, level: str, nodes: str, shares: str) -> str:
    """Water filling by trying the level that each child's capacity gives."""
    by = f"PARTITION BY {parent} ORDER BY capacity / nullif(weight, 0) NULLS LAST, {level}"
    return f"""(
SELECT * EXCLUDE (budget, lvl, ok, capacity, weight), CASE WHEN ok THEN capacity::DOUBLE ELSE coalesce(
  first_value(CASE WHEN NOT ok THEN lvl END IGNORE NULLS) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) * weight, 0) END AS budget FROM (
SELECT *, coalesce(capacity / nullif(weight, 0) <= lvl, false) AS ok FROM (
SELECT n.*, s.budget, (s.budget - coalesce(sum(capacity) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / nullif(sum(weight) OVER ({by} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS lvl FROM {nodes} n JOIN {shares} s USING ({parent}))))"""


MIXING = f"""
WITH d AS (SELECT doc_id, 'domain' || CAST(coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT), 0) % 4 AS VARCHAR) AS domain,
  coalesce(lang, '') AS l, coalesce(source, '') AS s, lang, source, coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, ''))) AS k,
  CAST(coalesce(len(regexp_extract_all(text, '[^\\t\\n\\x0B\\f\\r ]+')), 0) AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT 1 AS one, domain, l, s, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL),
b0 AS (SELECT 1 AS one, sum(tokens)::DOUBLE AS budget FROM leaves),
n1 AS (SELECT one, domain, CAST(4 * sum(tokens) AS DOUBLE) AS capacity, 4 - CAST(substr(domain, 7, 1) AS INT) AS weight FROM leaves GROUP BY ALL),
b1 AS {_pour("one", "domain", "n1", "b0")},
n2 AS (SELECT one, domain, l, CAST(4 * sum(tokens) AS DOUBLE) AS capacity, CASE WHEN l = 'en' THEN 3 ELSE 2 END AS weight FROM leaves GROUP BY ALL),
b2 AS {_pour("one, domain", "l", "n2", "b1")},
n3 AS (SELECT one, domain, l, s, CAST(4 * tokens AS DOUBLE) AS capacity, CASE WHEN s IN ('src0', 'src8', 'src9') THEN 2 ELSE 1 END AS weight FROM leaves),
b3 AS {_pour("one, domain, l", "s", "n3", "b2")},
plan AS (SELECT domain, l, s, tokens, CAST(floor(budget + 1e-6) AS BIGINT) AS budget FROM leaves JOIN b3 USING (domain, l, s)),
o AS (SELECT d.*, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest,
  md5('mix-' || CAST((CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END) + 1 AS VARCHAR) || '-' || k) AS place FROM d JOIN plan USING (domain, l, s))
SELECT doc_id, domain, lang, source, n_tokens, CAST(epochs + CASE WHEN rest > 0 AND
  sum(n_tokens) OVER (PARTITION BY domain, l, s ORDER BY place RANGE UNBOUNDED PRECEDING) <= rest THEN 1 ELSE 0 END AS BIGINT) AS n_copies FROM o"""

_SHARE = "CAST(length(bin(CAST((n - length(translate(t, '{}', ''))) * 1000 // greatest(n, 1) AS BIGINT))) AS INT)"
_MEASURES = {
    "size": "CAST(length(bin(n)) AS INT)", "symbols": _SHARE.format("#$%&*+=<>|~^@_{}[]"), "shouts": _SHARE.format("!?"),
    "capitals": _SHARE.format("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _SHARE.format("0123456789"), "blanks": _SHARE.format(" "),
    "lines": _SHARE.format("\n"), "variety": "CAST(len(list_distinct(string_split(t, ' '))) * 16 // len(string_split(t, ' ')) AS INT)",
}

_CLAMP = "least(greatest({}, 1.0), 1e6)"
QUALITY = f"""
WITH m0 AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(lang, '') AS path, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n FROM documents),
lab AS (SELECT doc_id, CAST(max(quality) AS INT) AS label FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT row_number() OVER () AS row, doc_id, host, path, label, {", ".join(f"{e} AS {k}" for k, e in _MEASURES.items())} FROM m0 LEFT JOIN lab USING (doc_id)),
u AS ({" UNION ALL ".join(f"SELECT row, label, '{k}' AS measure, {i} AS nr, {k} AS b FROM m" for i, k in enumerate(_MEASURES))}),
tot AS (SELECT count(*) FILTER (label = 1) AS t1, count(*) FILTER (label = 0) AS t0 FROM m),
used AS (SELECT measure, count(DISTINCT b) + 1 AS k FROM u WHERE label IS NOT NULL GROUP BY measure),
bins AS (SELECT measure, b, count(*) FILTER (label = 1) AS c1, count(*) FILTER (label = 0) AS c0 FROM u GROUP BY measure, b),
ue AS (SELECT row, nr, ln((c1 - coalesce(label, 0) + 1.0) / (t1 - coalesce(label, 0) + k)) - ln((c0 - coalesce(1 - label, 0) + 1.0) / (t0 - coalesce(1 - label, 0) + k)) AS r
       FROM u JOIN bins USING (measure, b) JOIN used USING (measure) CROSS JOIN tot),
e AS (SELECT row, 0.5 * list_sum(list(r ORDER BY nr)) AS evidence FROM ue GROUP BY row),
prior AS (SELECT (t1 + 1.0) / (t1 + t0 + 2.0) AS p FROM tot),
rows_ AS (SELECT m.row, doc_id, host, path, evidence, CAST(coalesce(label * 1000000, round(1e6 / (1 + exp(-(ln(p / (1 - p)) + evidence))))) AS BIGINT) AS mass FROM m JOIN e USING (row) CROSS JOIN prior),
paths AS (SELECT host, path, count(*) AS n, sum(mass) / 1e6 AS s FROM rows_ GROUP BY ALL),
hosts AS (SELECT host, sum(n) AS n, sum(s) AS s FROM paths GROUP BY host),
g AS (SELECT least(greatest(sum(s) / sum(n), 1e-6), 1 - 1e-6) AS rate, sum(n) AS nn FROM hosts),
g1 AS (SELECT any_value(rate) AS rate, any_value(nn) AS nn, (sum(n * (s / n - rate) ** 2) - any_value(rate * (1 - rate)) * count(*)) / any_value(nn) AS tau FROM hosts CROSS JOIN g),
g2 AS (SELECT rate, nn, CASE WHEN tau > 0 THEN {_CLAMP.format("rate * (1 - rate) / tau - 1")} ELSE 1e6 END AS st FROM g1),
hr AS (SELECT host, (s + st * rate) / (n + st) AS hrate FROM hosts CROSS JOIN g2),
j AS (SELECT * FROM paths JOIN hr USING (host)),
g3 AS (SELECT (sum(n * (s / n - hrate) ** 2) - sum(hrate * (1 - hrate))) / sum(n) AS tau, sum(hrate * (1 - hrate) * n) / sum(n) AS chance FROM j),
g4 AS (SELECT CASE WHEN tau > 0 THEN {_CLAMP.format("chance / tau - 1")} ELSE 1e6 END AS st FROM g3),
rest AS (SELECT doc_id, host, path, evidence, paths.n - 1 AS pn, paths.s - mass / 1e6 AS ps, hosts.n - 1 AS hn, hosts.s - mass / 1e6 AS hs,
  (SELECT count(*) FROM rows_) - 1 AS an, (SELECT sum(mass) FROM rows_) / 1e6 - mass / 1e6 AS gs FROM rows_ JOIN paths USING (host, path) JOIN hosts USING (host)),
r1 AS (SELECT *, CASE WHEN an > 0 THEN least(greatest(gs / an, 1e-6), 1 - 1e-6) ELSE p END AS rate_ FROM rest CROSS JOIN prior),
r2 AS (SELECT r1.*, (hs + g2.st * rate_) / (hn + g2.st) AS hrate_ FROM r1 CROSS JOIN g2),
sited AS (SELECT r2.*, least(greatest((ps + g4.st * hrate_) / (pn + g4.st), 1e-6), 1 - 1e-6) AS site_prior FROM r2 CROSS JOIN g4),
f AS (SELECT doc_id, host, path, evidence, site_prior, 1 / (1 + exp(-(ln(site_prior / (1 - site_prior)) + evidence))) AS score FROM sited)
SELECT doc_id, host, path, round(evidence, 6) AS evidence, round(site_prior, 6) AS site_prior, round(score, 6) AS score, score >= 0.5 AS good FROM f"""


def _typed_tokens(table: str, id_col: str) -> str:
    """``id, ts``: tokens without marks as ``c`` (placeholder or word), ``v`` (a placeholder's value) and ``w`` (in lower case)."""
    token = r"\p{L}[\p{L}\p{M}\p{N}]*|\p{N}+(?:[.,]\p{N}+)*|[.!?]"
    return f"""
SELECT id, list_transform(list_filter(list_transform(range(1, len(a) + 1), lambda i: {{'t': a[i], 'k': CASE
  WHEN regexp_matches(a[i], '^\\p{{N}}') THEN '<num>'
  WHEN regexp_matches(coalesce(a[i - 1], ''), '^\\p{{N}}') AND list_contains(us, lower(a[i])) THEN '<unit>'
  WHEN a[i] <> lower(a[i]) AND i > 1 AND NOT list_contains(['.', '!', '?'], a[i - 1]) AND (a[i] <> upper(a[i]) OR length(a[i]) = 1) THEN '<name>' END}}),
  lambda x: NOT list_contains(['.', '!', '?'], x.t)),
  lambda x: {{'c': coalesce(x.k, lower(x.t)), 'v': CASE WHEN x.k IS NOT NULL THEN lower(x.t) END, 'w': lower(x.t)}}) AS ts
FROM (SELECT {id_col} AS id, regexp_extract_all(coalesce(text, ''), '{token}') AS a, us FROM {table} CROSS JOIN (SELECT list(unit) AS us FROM units))"""


_CUT = """SELECT id, i - 1 AS pos, list_transform(ts[i:i + 4], lambda x: x.c) AS c, list_transform(ts[i:i + 4], lambda x: x.w) AS w,
  list_filter(list_transform(ts[i:i + 4], lambda x: x.v), lambda x: x IS NOT NULL) AS v
FROM (SELECT id, ts, unnest(range(1, greatest(len(ts) - 4, 1) + 1)) AS i FROM {0} WHERE len(ts) > 0)"""


def decontamination(units: list[str]) -> str:
    return f"""
WITH units AS (SELECT unnest({units!r}) AS unit),
bt AS MATERIALIZED ({_typed_tokens("benchmark", "item_id")}),
dt AS MATERIALIZED ({_typed_tokens("documents", "doc_id")}),
bw AS (SELECT *, len(c) - len(v) >= least(3, ceil(len(c) / 2)) AS used FROM ({_CUT.format("(SELECT min(id) AS id, ts FROM bt GROUP BY ts HAVING min(id) IS NOT NULL)")})),
dw AS ({_CUT.format("dt")}),
sizes AS (SELECT id AS item, count(*) AS n_all, count(*) FILTER (used) AS n_used FROM bw GROUP BY id),
hits AS (SELECT dw.id AS doc, bw.id AS item, dw.pos - bw.pos AS diag, bw.pos AS spot, list_zip(bw.v, dw.v) AS pairs FROM dw JOIN bw ON dw.c = bw.c AND bw.used),
values_ AS (SELECT doc, item, diag, spot, p[1] AS a, p[2] AS b FROM (SELECT * EXCLUDE (pairs), unnest(pairs) AS p FROM hits)),
torn AS (SELECT doc, item, diag, a FROM values_ GROUP BY ALL HAVING count(DISTINCT b) > 1),
lost AS (SELECT DISTINCT doc, item, diag, spot FROM values_ JOIN torn USING (doc, item, diag, a) WHERE a <> b),
typed AS (SELECT DISTINCT doc, item, diag, spot FROM hits ANTI JOIN lost USING (doc, item, diag, spot)),
lw AS (SELECT id, pos - 1 AS pos, list_transform(ts[pos:pos + width - 1], lambda x: x.w) AS w FROM (
  SELECT id, ts, width, unnest(range(1, len(ts) - width + 2)) AS pos FROM dt CROSS JOIN (SELECT DISTINCT len(w) AS width FROM bw))),
literal AS (SELECT DISTINCT lw.id AS doc, bw.id AS item, lw.pos - bw.pos AS diag, bw.pos AS spot FROM lw JOIN bw USING (w)),
spots AS (SELECT DISTINCT doc, item, diag, spot FROM (SELECT * FROM typed UNION ALL SELECT * FROM literal)),
runs AS (SELECT doc, item, max(n) AS run FROM (SELECT doc, item, diag, count(*) AS n FROM spots GROUP BY ALL) GROUP BY ALL),
either AS (SELECT doc, item, count(DISTINCT spot) AS n FROM spots JOIN bw ON bw.id = item AND bw.pos = spot AND bw.used GROUP BY ALL),
as_is AS (SELECT doc, item, count(DISTINCT spot) AS n FROM literal GROUP BY ALL),
found AS (SELECT doc, item, run, greatest(CASE WHEN n_used > 0 THEN coalesce(either.n, 0) / n_used END, coalesce(as_is.n, 0) / n_all) AS sim
          FROM runs JOIN sizes USING (item) LEFT JOIN either USING (doc, item) LEFT JOIN as_is USING (doc, item)),
best AS (SELECT doc, count(DISTINCT item) AS n_items, first(item ORDER BY sim DESC, item) AS item_id FROM found WHERE sim >= 0.8 OR run >= 9 GROUP BY doc)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, item_id FROM documents LEFT JOIN best ON doc = doc_id"""


DECONTAMINATION = decontamination(UNITS)


def _crc32(text: str) -> str:
    """SQL of the unsigned crc32 of a text, four bits at a time with a table from the polynomial."""
    table = []
    for i in range(16):
        for _ in range(4):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    half_bytes = f"list_transform(range(length(hex({text}))), lambda i: instr('0123456789ABCDEF', hex({text})[1 + xor(i, 1)]) - 1)"
    step = f"lambda crc, x: xor(crc >> 4, {table}[1 + xor(crc & 15, x & 15)])"
    return f"xor(list_reduce(list_prepend(4294967295, {half_bytes}), {step}), 4294967295)"


SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT run, count(*) AS c, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, c, {_crc32("key")} AS h FROM counted),
slipped AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
            FROM hashed),
vocab AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, v.word, v.n FROM cut a JOIN vocab v ON a.rest = v.word
  UNION SELECT v.word, a.word, a.n FROM cut a JOIN vocab v ON a.rest = v.word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near
           FROM pairs),
formed AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form,
                  CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
           FROM vocab v LEFT JOIN (SELECT * FROM ranked WHERE place = 1) b ON v.word = b.word),
walk AS (SELECT word, word AS at FROM formed
         UNION ALL SELECT walk.word, form FROM walk JOIN formed ON walk.at = formed.word WHERE form IS NOT NULL)
SELECT formed.word, formed.n, formed.n_near, formed.form, formed.form_n, walk.at AS root
FROM formed JOIN walk ON walk.word = formed.word JOIN formed ends ON ends.word = walk.at AND ends.form IS NULL"""


PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(text, '') AS t, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h, list(id ORDER BY turn NULLS FIRST, id) AS ids,
               list(length(t) ORDER BY turn NULLS FIRST, id) AS lens FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT own.conv_id AS c, list_concat(coalesce(list_slice(first.ids, 1, own.h), []), own.ids[own.h + 1:]) AS ids,
         list_concat(coalesce(list_slice(first.lens, 1, own.h), []), own.lens[own.h + 1:]) AS lens
  FROM own LEFT JOIN own first ON first.conv_id = own.conv_id - own.conv_id % 100),
steps AS (SELECT c, d, len(ids) = d AS ends, CASE WHEN d > 0 THEN lens[d] ELSE 0 END AS size, left(array_to_string(ids, ''), 64 * d) AS node,
                 CASE WHEN d > 0 THEN left(array_to_string(ids, ''), 64 * d - 64) END AS above
          FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT node, any_value(above) AS above, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                 sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
          FROM steps GROUP BY node),
children AS (SELECT above AS node, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children ON nodes.node = children.node),
sums AS (SELECT left(node, 64 * k) AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
         FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM full_nodes) GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums ON sums.node = n.node LEFT JOIN nodes p ON p.node = n.above"""
