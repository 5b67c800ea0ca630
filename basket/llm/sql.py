"""DuckDB SQL for the queries that SQL can express."""

_SPACE = r"[\x20\x09-\x0D]"

OP3 = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
f AS (
  SELECT *, 4 + length(regexp_replace(regexp_replace(role, '(\\|###|</turn>)', '\\\1', 'g'), ':', '\\:', 'g'))
    + 2 + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + 8 AS n
  FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

_ROUNDS, _DAMPING = 10, 0.85


def _op5() -> str:
    """The rules, the host graph, and the rounds of propagation one after the other."""
    rounds = []
    for k in range(1, _ROUNDS + 1):
        rounds.append(f"""
r{k} AS (
  SELECT b.host, b.st * {1 - _DAMPING!r} + coalesce(t.t, 0) * {_DAMPING} AS t, b.sd * {1 - _DAMPING!r} + coalesce(d.d, 0) * {_DAMPING} AS d
  FROM r0 b
  LEFT JOIN (SELECT e.dst AS host, sum(r.t * e.down) AS t FROM flow e JOIN r{k - 1} r ON r.host = e.src GROUP BY 1) t ON t.host = b.host
  LEFT JOIN (SELECT e.src AS host, sum(r.d * e.up) AS d FROM flow e JOIN r{k - 1} r ON r.host = e.dst GROUP BY 1) d ON d.host = b.host)""")
    return rf"""
WITH rules(h, p, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (
  SELECT page_id, coalesce(url, '') AS url, html FROM pages),
p AS (
  SELECT page_id, html,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM u),
j AS (
  SELECT page_id, arg_max(h || p.rp, length(h || p.rp)) AS rule, arg_max(verdict, length(h || p.rp)) AS ruled
  FROM (SELECT p.page_id, r.h, r.p AS rp, r.verdict FROM p JOIN rules r
        ON (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p)) p
  GROUP BY page_id),
links AS (
  SELECT host AS src, unnest(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?([^"''>\s]*)', 1)) AS link FROM p),
hops AS (
  SELECT src, translate(regexp_extract(CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END, '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM links WHERE regexp_matches(link, '^([A-Za-z][A-Za-z0-9+.\-]*:)?//')),
edge AS (SELECT src, dst, count(*) AS n FROM hops WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY 1, 2),
flow AS (
  SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS down, n / sum(n) OVER (PARTITION BY dst) AS up FROM edge),
seeds AS (
  SELECT host, avg(CASE WHEN ruled = 'allow' THEN 1.0 ELSE 0.0 END) AS st, avg(CASE WHEN ruled = 'block' THEN 1.0 ELSE 0.0 END) AS sd
  FROM p LEFT JOIN j USING (page_id) WHERE host <> '' GROUP BY host),
r0 AS (
  SELECT coalesce(s.host, h.host) AS host, coalesce(st, 0) AS st, coalesce(sd, 0) AS sd, coalesce(st, 0) AS t, coalesce(sd, 0) AS d
  FROM seeds s FULL JOIN (SELECT src AS host FROM edge UNION SELECT dst FROM edge) h ON h.host = s.host),
{",".join(rounds).lstrip()}
SELECT p.page_id, p.host, p.path, j.rule,
  coalesce(j.ruled, CASE WHEN r.d > 0.5 * (r.t + r.d) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN j USING (page_id) LEFT JOIN r{_ROUNDS} r ON r.host = p.host
"""


OP9 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, greatest(len(w) - 1, 1))) AS i,
    unnest([w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] for k in range(1, greatest(len(w) - 1, 1))]) AS gram
  FROM d),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)),
b AS (
  SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failures
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures
FROM b
"""

OP10 = r"""
WITH norm AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT item, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM iw),
lengths AS (SELECT DISTINCT n FROM windows),
dw AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM norm, lengths WHERE len(w) >= n),
hits AS (SELECT doc_id, i, dw.n, item FROM (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM dw) dw
  JOIN windows USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM norm LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# crc32 of a word's UTF-8 bytes: its table from the polynomial, then one look-up for each byte.
OP12 = r"""
WITH RECURSIVE bit8(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit8 WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bit8 WHERE k = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
f AS (SELECT r, unnest(w) AS w FROM d),
tf AS (SELECT unnest(w) AS w FROM b),
words AS (SELECT w, xor(list_reduce(list_prepend(4294967295, [CAST('0x' || substr(hex(encode(w)), 2 * k - 1, 2) AS BIGINT) for k in range(1, strlen(w) + 1)]),
    lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INT) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT w FROM f UNION SELECT w FROM tf), crc),
s AS (SELECT bucket, count(*) AS n FROM f JOIN words USING (w) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM tf JOIN words USING (w) GROUP BY 1),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM tf) + 10000)))) AS BIGINT) AS g FROM s FULL JOIN t USING (bucket)),
sums AS (SELECT r, count(*) AS n, sum(g) AS g FROM f JOIN words USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, coalesce(n, 0) AS n_features, coalesce(g, 0) AS weight, coalesce(g, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN sums USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS bits
  FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
x(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
p AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS o
  FROM x a, x b, x c, x d, x e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
s AS (
  SELECT filter_order, step, o[step] AS own, CAST(list_sum(o[:step]) AS INT) - o[step] AS before
  FROM p, (SELECT unnest(range(1, 6)) AS step) t),
r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN bits & (before | own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN bits & before = 0 AND bits & own <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bits & before <> 0 AND bits & own <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bits = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bits & before = 0 AND bits & own <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN bits & before = 0 AND bits & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""

ORACLES: dict[str, str] = {
    "op3_prefix_tree": OP3,
    "op5_link_trust": _op5(),
    "op9_rule_ledger": OP9,
    "op10_decontaminate": OP10,
    "op12_resampling": OP12,
    "op13_filter_audit": OP13,
}
