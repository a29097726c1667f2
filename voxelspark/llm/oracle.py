"""DuckDB SQL for the text queries that SQL can express over whole tables."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[a:a + 9] AS q, array_to_string(w[a:a + 9], ' ') AS k, least(len(w), 10) AS n FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS a FROM i WHERE len(w) > 0)),
pos AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS a FROM d),
cand AS (SELECT p.r, p.a, n.n, array_to_string(p.w[p.a:p.a + n.n - 1], ' ') AS k FROM pos p, (SELECT DISTINCT n FROM win) n WHERE p.a + n.n - 1 <= len(p.w)),
hit AS (SELECT c.r, c.a, c.n, win.item_id FROM cand c JOIN win ON c.k = win.k AND c.n = win.n),
words AS (SELECT r, count(DISTINCT a) AS n_hit FROM (SELECT r, unnest(range(a, a + n)) AS a FROM hit) GROUP BY 1),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id) FILTER (item_id IS NOT NULL)), ',') AS ids FROM hit GROUP BY 1),
freq AS (SELECT w[a] AS t, count(*) AS n FROM pos GROUP BY 1),
term AS (SELECT DISTINCT k, q, n, unnest(range(0, n)) AS o FROM win),
rare AS (SELECT k, any_value(q) AS q, any_value(term.n) AS n, arg_min(o, coalesce(freq.n, 0)) AS o, min(coalesce(freq.n, 0)) AS least FROM term LEFT JOIN freq ON q[o + 1] = t GROUP BY k),
start AS (SELECT DISTINCT p.r, p.w, rare.k, rare.q, rare.n, p.a - rare.o + e - 2 AS s FROM pos p JOIN rare ON p.w[p.a] = rare.q[rare.o + 1], range(5) g(e) WHERE least > 0),
close AS (SELECT DISTINCT r, k FROM start WHERE len(list_filter(range(0, n), lambda j: list_contains(w[greatest(1, s + j - 2):greatest(0, s + j + 2)], q[j + 1]))) = n),
near AS (SELECT r, count(DISTINCT item_id) AS n_near, array_to_string(list_sort(list(DISTINCT item_id) FILTER (item_id IS NOT NULL)), ',') AS ids FROM close JOIN win USING (k) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near, sha256(coalesce(near.ids, '')) AS near_sha256
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r) LEFT JOIN near USING (r)
"""


def _kind(name: str, pattern: str, rank: int, least: str) -> str:
    """Spans of one kind: pieces between matches and the matches give each match's place."""
    return f"""SELECT doc_id, '{name}' AS kind, {rank} AS rank, pos AS s, pos + len(hit) AS e FROM (
  SELECT doc_id, hits[i] AS hit, coalesce(list_sum([len(x) for x in gaps[1:i]]), 0) + coalesce(list_sum([len(x) for x in hits[1:i-1]]), 0) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, {pattern}) AS hits, regexp_split_to_array(text, {pattern}) AS gaps, unnest(range(1, len(regexp_extract_all(text, {pattern})) + 1)) AS i FROM d)) WHERE {least}"""


_ASSIGN = """'(?i:(?:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?[A-Za-z0-9+/_.=-]+)'"""
_INNER = """'(?i:(?:password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?)([A-Za-z0-9+/_.=-]+)'"""
_MORE = (
    ("private_key", "'-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----'", 3, "true"),
    ("jwt", "'eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}'", 4, "true"),
    ("bearer", "'(?i:bearer)\\x20[A-Za-z0-9._~+/-]{20,}'", 5, "true"),
    ("url_login", "'[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._%-]{1,64}:[^\\x20\\x09-\\x0D/@:]{3,64}@'", 6, "true"),
)
_KINDS = (("assign", _ASSIGN, 0, f"len(regexp_extract(hit, {_INNER}, 1)) >= 8"), ("access", "'AKIA[A-Z0-9]+'", 1, "len(hit) >= 16"), ("hex", "'[0-9a-f]+'", 2, "len(hit) >= 32"), *_MORE)

SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(_kind(*k) for k in _KINDS)}),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b, count(*) FILTER (kind = 'hex') AS c,
  string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, rank) AS every FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans FROM d LEFT JOIN g USING (doc_id)
"""

_H = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"
_D = "CAST({} AS DOUBLE)".format
_POWERS = "list_sum([pow(x, m) for x in p])"
MIXING = f"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS BIGINT) AS tokens FROM documents),
s AS (SELECT source, count(*) AS n_docs, CAST(sum(tokens) AS BIGINT) AS n FROM t GROUP BY 1),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS total, list(n / (SELECT sum(n) FROM s) ORDER BY n) FILTER (n > 0) AS p FROM s),
b AS (SELECT 0 AS i, {_D(0)} AS lo1, {_D(1)} AS hi1, {_D(0)} AS lo2, {_D(1)} AS hi2 UNION ALL
  SELECT i + 1, if(one, lo1, m1), if(one, m1, hi1), if(two, lo2, m2), if(two, m2, hi2) FROM (
    SELECT i, lo1, hi1, lo2, hi2, m1, m2, ln(list_sum([pow(x, m1) for x in p])) - m1 * list_sum([pow(x, m1) * ln(x) for x in p]) / list_sum([pow(x, m1) for x in p]) <= 0.9 * ln(len(p)) AS one,
      list_max([pow(x, m2 - 1) for x in p]) / list_sum([pow(x, m2) for x in p]) <= 4.0 AS two FROM (SELECT *, (lo1 + hi1) / 2 AS m1, (lo2 + hi2) / 2 AS m2 FROM b WHERE i < 50), tot)),
e AS (SELECT round(greatest(hi1, hi2), 6) AS m FROM b WHERE i = 50),
w AS (SELECT source, n_docs, n, m AS exponent, if(n = 0, {_D(0)}, round(pow(n / total, m) / (SELECT {_POWERS} FROM tot, e), 9)) AS weight, total FROM s, tot, e),
q AS (SELECT *, CAST(floor(weight * total) AS BIGINT) AS budget FROM w),
k AS (SELECT t.doc_id, t.source, t.tokens, digest, exponent, weight, budget, n, CAST({_H.format("'1:block:' || digest")} % CAST(ceil(n_docs / 4096) AS BIGINT) AS INT) AS block FROM t JOIN q USING (source)),
l AS (SELECT *, CAST(sum(tokens) OVER (PARTITION BY source, block) AS BIGINT) AS bt FROM k),
r AS (SELECT *, if(n > 0, CAST((CAST(budget AS HUGEINT) * bt) // n AS BIGINT), 0) AS bb FROM l),
x AS (SELECT *, if(bt > 0, bb // bt, 0) AS whole, if(bt > 0, bb % bt, bb) AS rest FROM r),
y AS (SELECT *, unnest(range(0, whole + 1)) AS epoch FROM x),
z AS (SELECT *, {_H.format("'1:' || epoch || ':' || digest")} AS h FROM y),
v AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source, block, epoch ORDER BY h, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY source, block, epoch ORDER BY h, digest) AS place FROM z)
SELECT doc_id, source, tokens, epoch, block, CAST(place AS INT) AS place, if(bb > 0, round((epoch * bt + before) / CAST(bb AS DOUBLE), 9), 0) AS mix_key, weight, exponent FROM v WHERE epoch < whole OR 2 * before + tokens <= 2 * rest
"""

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
t AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY 1, 2),
m AS (SELECT r, doc_id, 10 + (90 * CAST(len(w) AS BIGINT) * docs) // terms AS m FROM d, s WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT DISTINCT i, unnest({_WORDS}) AS term FROM i),
f AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS weight FROM t, s WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
x AS (SELECT i, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN f USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY 1, 2),
o AS (SELECT i, r, m.doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, m.doc_id NULLS LAST) AS INT) AS rank FROM x JOIN m USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o JOIN i USING (i) WHERE rank <= 10
"""

COLLOCATIONS = """
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM d),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p FROM w, (SELECT unnest(range(1, 5)) AS k)),
f AS (SELECT lang, k, p, CAST(count(*) AS BIGINT) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
parts AS (SELECT lang, k, p, a, p[1:s] AS head, p[s + 1:k] AS tail, s FROM (SELECT c.*, unnest(range(1, k)) AS s FROM c)),
e AS (SELECT * FROM f WHERE a >= 30),
cut AS (SELECT h.lang, h.k, h.p, h.a, s, x.a AS l, y.a AS r, CAST((2000000::HUGEINT * h.a) // (x.a + y.a) AS BIGINT) AS score FROM parts h JOIN e x ON x.lang = h.lang AND x.p = h.head JOIN e y ON y.lang = h.lang AND y.p = h.tail),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, s) = 1),
inside AS (SELECT lang, p[i:j] AS p, max(a) AS most FROM (SELECT *, unnest(range(i + 1, k + 1)) AS j FROM (SELECT *, unnest(range(1, k)) AS i FROM c)) WHERE j - i + 1 < k GROUP BY lang, p[i:j]),
o AS (SELECT low.lang, array_to_string(low.p, ' ') AS phrase, a, l, r, score FROM low LEFT JOIN inside USING (lang, p) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) QUALIFY rank <= 2000
"""

SQL: dict[str, str] = {"op1_mixing": MIXING, "op6_decontamination": DECONTAMINATION, "op10_secrets": SECRETS, "op11_search": SEARCH, "op12_collocations": COLLOCATIONS}
