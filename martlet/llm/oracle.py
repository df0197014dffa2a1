"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from martlet.llm import audit, decontaminate, jaccard, spelling, urls

_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES)
_LOW, _HIGH = urls.PRIOR_PAGES


def _level(name: str, source: str) -> str:
    """Rate and prior strength of one level's (n, k) rows."""
    return f"""
{name} AS (
  SELECT CASE WHEN n IS NULL OR n = 0 THEN 1.0 ELSE k / n END AS rate,
    CASE WHEN n IS NULL OR n = 0 THEN {_LOW}
         WHEN k / n * (1 - k / n) <= 0 OR (kk - k * (k / n)) / n - k / n * (1 - k / n) * g / n <= 0 THEN {_HIGH}
         ELSE least({_HIGH}, greatest({_LOW},
           k / n * (1 - k / n) / ((kk - k * (k / n)) / n - k / n * (1 - k / n) * g / n) - 1)) END AS m
  FROM (SELECT sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, count(*) FILTER (WHERE n > 0)::DOUBLE AS g,
          sum(CASE WHEN n > 0 THEN k::DOUBLE * k / n END) AS kk FROM {source}) t
)"""


URL_FILTERS = f"""
WITH parsed AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{urls.UPPER}', '{urls.LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
),
marks AS (SELECT doc_id, min(quality) AS good FROM labels GROUP BY doc_id),
seen AS (
  SELECT p.host, m.good
  FROM parsed p LEFT JOIN marks m ON m.doc_id = try_cast(regexp_extract(p.path, '/([0-9]{{1,18}})', 1) AS BIGINT)
),
hosts AS (
  SELECT *, array_to_string(list_slice(string_split(bare, '.'), -2, -1), '.') AS domain,
    string_split(bare, '.')[-1] AS suffix
  FROM (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare,
          count(good) AS n, coalesce(sum(good), 0) AS k FROM seen GROUP BY host)
),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
{_level("of_suffix", "suffixes")},
{_level("of_domain", "domains")},
{_level("of_host", "hosts")},
p_suffix AS (SELECT s.suffix, (s.k + l.m * l.rate) / (s.n + l.m) AS p FROM suffixes s, of_suffix l),
p_domain AS (
  SELECT d.domain, (d.k + l.m * s.p) / (d.n + l.m) AS p FROM domains d JOIN p_suffix s USING (suffix), of_domain l
),
p_host AS (
  SELECT h.host, (h.k + l.m * d.p) / (h.n + l.m) AS p, h.n + l.m AS total
  FROM hosts h JOIN p_domain d USING (domain), of_host l
),
rules(verdict, rule_host, rule_path) AS (VALUES {_RULE_ROWS}),
fits AS (
  SELECT p.host, p.path, arg_max(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) AS rule,
    arg_max(r.verdict, length(r.rule_host || r.rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parsed) p
  JOIN rules r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  GROUP BY p.host, p.path
)
SELECT p.page_id, p.host, p.path, f.rule,
  coalesce(f.verdict, CASE WHEN h.p + {urls.BOUND_SD} * sqrt(h.p * (1 - h.p) / (h.total + 1)) < {urls.MIN_GOOD}
                           THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p LEFT JOIN fits f USING (host, path) LEFT JOIN p_host h USING (host)
"""


_FOLD = f"translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}')"

# Windows of the documents, of every length that some item's windows have, joined by their text.
DECONTAMINATION = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
items AS (
  SELECT item_id::VARCHAR AS id, w, least({decontaminate.WINDOW}, len(w)) AS n
  FROM (SELECT item_id, regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0
),
windows AS (SELECT DISTINCT id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM items, unnest(range(1, len(w) - n + 2)) t(i)),
found AS (
  SELECT DISTINCT d.r, d.n, d.i, v.id
  FROM (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM docs, (SELECT DISTINCT n FROM items) l, unnest(range(1, len(w) - n + 2)) t(i)) d
  JOIN windows v ON v.n = d.n AND v.s = d.s
),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) t(p) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, id FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

JACCARD = rf"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= {jaccard.WIDTH}
      THEN list_distinct(list_transform(range(1, len(w) - {jaccard.WIDTH} + 2), lambda i: array_to_string(w[i:i + {jaccard.WIDTH} - 1], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g
  FROM words
),
members AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= {jaccard.PERCENT} * (a.n + b.n - count(*))
),
reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
labels AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id FROM sets JOIN labels USING (doc_id)
"""

_LETTER = "(VALUES " + ", ".join(f"('{x}')" for x in audit.LETTERS) + ")"

# Every order is applied to every set of failed filters, step by step.
FILTER_AUDIT = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{audit.WORD}') AS w
  FROM documents
),
failed AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < {audit.MIN_WORDS} THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < {audit.MIN_DISTINCT} * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {audit.MAX_CAPITALS} * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '{audit.MARKS}') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS f
  FROM docs
),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
combos AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, f
),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o
  FROM {_LETTER} a(x), {_LETTER} b(x), {_LETTER} c(x), {_LETTER} d(x), {_LETTER} e(x)
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
placed AS (
  SELECT *, coalesce(list_min(list_transform(string_split(f, ''), lambda y: CASE WHEN y <> '' THEN instr(o, y) END)), 9) AS gone
  FROM combos, orders
),
steps AS (
  SELECT part, o, s, o[s] AS letter, sum(n) FILTER (WHERE gone > s) AS kept, sum(n) FILTER (WHERE gone = s) AS removed,
    sum(n) FILTER (WHERE gone < s AND contains(f, o[s])) AS redundant, sum(n) FILTER (WHERE f = o[s]) AS unique_fails,
    sum(good) FILTER (WHERE gone = s) AS good_lost, sum(toxic) FILTER (WHERE gone = s) AS toxic_lost
  FROM placed, range(1, 6) t(s) GROUP BY part, o, s
)
SELECT part, o AS filter_order, s::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM steps
"""

_BIT = "CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END"
_BYTES = """flatten(list_transform(string_split(s, ''), lambda c:
      CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + (ord(c) >> 6)::BIGINT, 128 + (ord(c) & 63)::BIGINT] END))"""

# The checksum bit by bit; near words by their words with one code point deleted.
SPELLING = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '{spelling.RUN}')) AS run
  FROM documents
),
told AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda d, e: {_BIT})), 4294967295) AS h
  FROM (SELECT run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS s
        FROM runs WHERE length(run) >= {spelling.MIN_LENGTH} GROUP BY doc_id, run)
),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % {spelling.SLIP} = 0
      THEN substr(run, 1, h % length(run)) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word FROM told)
  WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}
),
cut AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM words, unnest(range(1, length(word) + 1)) t(i)),
pairs AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM cut a JOIN words b ON a.v = b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM words a JOIN cut b ON b.v = a.word
),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM pairs GROUP BY word),
named AS (SELECT p.word, min(p.other) AS other FROM pairs p JOIN best b ON b.word = p.word AND b.top = p.n GROUP BY p.word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
    CASE WHEN b.top >= {spelling.RATIO} * w.n THEN o.other END AS form, CASE WHEN b.top >= {spelling.RATIO} * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b USING (word) LEFT JOIN named o USING (word)
),
chain(word, root) AS (
  SELECT word, word FROM forms WHERE form IS NULL
  UNION ALL SELECT f.word, c.root FROM forms f JOIN chain c ON f.form = c.word
)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN chain USING (word)
"""


def all_sql() -> dict[str, str]:
    return {
        "op2_jaccard_join": JACCARD,
        "op4_decontamination": DECONTAMINATION,
        "op10_url_filters": URL_FILTERS,
        "op11_filter_audit": FILTER_AUDIT,
        "op12_spelling_variants": SPELLING,
    }
