"""SQL that gives the same rows as the queries for which SQL is practical."""

from __future__ import annotations

from tidemark.llm import quality, urlrules


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


WORDS = r"'[^\x20\x09-\x0D]+'"

CHAT = """WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) AS k,
  replace(replace(replace(r, '%', '%25'), '<|', '%3C|'), chr(10), '%0A') AS er, replace(replace(x, '%', '%25'), '<|', '%3C|') AS ex FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, string_agg(r || chr(10) || x || chr(10), '' ORDER BY k) AS said,
  coalesce(string_agg(x, '' ORDER BY k) FILTER (r = 'assistant'), '') AS loss, sum(length(er) + length(ex) + 24) AS n FROM o GROUP BY 1)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(n AS BIGINT) AS formatted_chars FROM c"""

TOP_K = """WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= 5"""

_RULES = quality.LineRules()
_MARKS = " + ".join(f"(length(l) - length(replace(l, '{m}', ''))) // {len(m)}" for m in quality.NAVIGATION_MARKS)
_CLOSERS = quality.CLOSERS.replace("'", "''")
QUALITY = f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, {WORDS}) AS w FROM d),
g AS (SELECT k, i, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
again AS (SELECT k, i FROM g QUALIFY count(*) OVER (PARTITION BY k, gram) > 1),
rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + 5)) AS p FROM again) GROUP BY 1),
l AS (SELECT k, unnest(string_split(t, chr(10))) AS l FROM d),
f AS (SELECT *, list_filter(string_split_regex(low, '\\s+'), lambda x: x <> '') AS words FROM (SELECT k, l, lower(l) AS low,
  length(l) - (length(l) - length(replace(l, ' ', ''))) AS size FROM l WHERE trim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '')),
j AS (SELECT k, size, regexp_matches(low, '{"|".join(quality.BOILERPLATE)}') OR {_MARKS} >= {_RULES.navigation_marks}
  OR (len(words) > 0 AND len(list_filter(words, lambda x: trim(x, '.,|>»›/:') IN ({_quoted(quality.NAVIGATION_WORDS)}))) >= {_RULES.navigation_share} * len(words))
  OR (len(words) >= {_RULES.min_words_for_punctuation}
    AND (e = '' OR NOT contains('{quality.TERMINALS}', right(e, 1)))) AS bad
  FROM (SELECT *, rtrim(rtrim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '{_CLOSERS}') AS e FROM f)),
c AS (SELECT k, sum(size) AS before, coalesce(sum(size) FILTER (NOT bad), 0) AS after, count(*) FILTER (bad) AS n_removed_lines FROM j GROUP BY 1),
dup AS (SELECT k, count(*) - count(DISTINCT l) AS n FROM l WHERE regexp_matches(l, {WORDS}) GROUP BY 1),
b AS (SELECT w.k, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_removed_lines, 0) AS BIGINT) AS n_removed_lines,
  CASE WHEN before > 0 THEN 1 - after / before ELSE 0.0 END AS lost_share
  FROM w LEFT JOIN rep ON w.k = rep.k LEFT JOIN dup ON w.k = dup.k LEFT JOIN c ON w.k = c.k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND lost_share <= {_RULES.max_lost_share} AS kept,
  n_removed_lines, lost_share FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)"""

_MINING = urlrules.Mining()
_CURATED = ", ".join(f"('{r}', '{v}', '{r[: r.index('/')]}', '{r[r.index('/') :]}')" for r, v in urlrules.RULES)
_PART = "list_transform(list_filter(string_split_regex(translate({text}, '{upper}', '{lower}'), '{between}'), lambda x: x <> ''), lambda x: '{name}:' || x)"
_TOKENS = ",\n    ".join(
    _PART.format(text=p, name=p, upper=urlrules.UPPER, lower=urlrules.LOWER, between=urlrules.BETWEEN) for p in ("host", "path", "query", "fragment")
)
URLS = f"""WITH RECURSIVE p0 AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS given FROM (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)),
p1 AS (SELECT page_id, given, substr(rest, length(given) + 1) AS rest FROM p0),
p2 AS (SELECT page_id, given, regexp_extract(rest, '^[^?#]*') AS path, rest FROM p1),
p3 AS (SELECT page_id, given, path, substr(rest, length(path) + 1) AS rest FROM p2),
p4 AS (SELECT page_id, given, path, regexp_extract(rest, '^[^#]*') AS query, rest FROM p3),
p AS MATERIALIZED (SELECT row_number() OVER () AS k, page_id, translate(given, '{urlrules.UPPER}', '{urlrules.LOWER}') AS host, path, query,
  substr(rest, length(query) + 1) AS fragment FROM p4),
t AS (SELECT *, list_distinct(flatten([
    {_TOKENS}])) AS tokens FROM p),
cur AS (SELECT k, rule, verdict FROM p JOIN (VALUES {_CURATED}) r(rule, verdict, domain, prefix)
  ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix)
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY length(rule) DESC) = 1),
b AS MATERIALIZED (SELECT row_number() OVER () AS b, tokens, coalesce(quality = 0 OR toxic = 1, false) AS bad FROM t JOIN labels ON page_id = doc_id),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM b),
least AS (SELECT ceil(least(1.0, greatest({_MINING.support}, CAST({_MINING.least_urls} AS DOUBLE) / n)) * n) AS n FROM total),
x AS (SELECT b, bad, unnest(tokens) AS w FROM b),
s AS (SELECT w, count(*) AS n, count(*) FILTER (bad) AS n_bad, list(b ORDER BY b) AS held FROM x GROUP BY w
  HAVING count(*) FILTER (bad) >= (SELECT n FROM least)),
i AS MATERIALIZED (SELECT w, min(w) OVER (PARTITION BY held) AS item, n, CAST(n_bad AS DOUBLE) / n >= {_MINING.confidence} AS sure FROM s),
y AS MATERIALIZED (SELECT DISTINCT b, bad, item FROM x JOIN i USING (w) WHERE NOT sure AND n < (SELECT n FROM total)),
g AS (SELECT [item] AS needs, item AS final, b, bad, false AS sure FROM y
  UNION ALL SELECT needs, final, b, bad, CAST(count(*) FILTER (bad) OVER r AS DOUBLE) / count(*) OVER r >= {_MINING.confidence}
    FROM (SELECT list_append(g.needs, y.item) AS needs, y.item AS final, g.b, g.bad FROM g JOIN y ON g.b = y.b AND y.item > g.final WHERE NOT g.sure)
    WINDOW r AS (PARTITION BY needs) QUALIFY count(*) FILTER (bad) OVER r >= (SELECT n FROM least)),
told AS MATERIALIZED (SELECT DISTINCT [item] AS needs FROM i WHERE sure UNION ALL SELECT DISTINCT needs FROM g WHERE sure),
rules AS (SELECT needs FROM told l WHERE NOT EXISTS (SELECT 1 FROM told o WHERE len(o.needs) < len(l.needs) AND list_has_all(l.needs, o.needs))),
u AS (SELECT k, list(DISTINCT item) AS items FROM (SELECT k, unnest(tokens) AS w FROM t) JOIN i USING (w) GROUP BY k),
hits AS (SELECT k, count(*) AS n FROM u JOIN rules ON list_has_all(items, needs) GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(cur.verdict, CASE WHEN hits.n > 0 THEN 'block' ELSE 'allow' END) AS verdict, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_rules
FROM p LEFT JOIN cur USING (k) LEFT JOIN hits USING (k)"""

#: crc32 by its table of 256 entries, which follows from the polynomial; ``{bytes}`` is a list of numbers 0 to 255.
CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i)))"""
CRC = """xor(list_reduce(list_prepend(4294967295, {bytes}),
  lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295)"""
_DIGITS = CRC.format(bytes="list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x))")
_RUN_BYTES = CRC.format(
    bytes="""flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END))"""
)

#: Every prefix of a rebuilt conversation is named by its content; each node's totals come from all nodes below it.
TRIE = f"""WITH {CRC_TABLE},
ordered AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT c FROM ordered),
heads AS (SELECT c, c - c % 20 AS leader, {_DIGITS} % 4 AS h FROM convs, crc_table),
parts AS (SELECT h.c, 0 AS part, o.p, role, text FROM heads h JOIN ordered o ON o.c = h.leader AND o.p <= h.h
  UNION ALL SELECT h.c, 1, o.p, role, text FROM heads h JOIN ordered o ON o.c = h.c AND o.p > h.h),
built AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, sha256(role || chr(1) || text) AS sign,
  len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM parts),
paths AS (SELECT c, d, words, string_agg(sign, '') OVER (PARTITION BY c ORDER BY d) AS path FROM built
  UNION ALL SELECT c, 0, 0, '' FROM convs),
named AS (SELECT *, min(c) OVER (PARTITION BY d, path) AS node, max(d) OVER (PARTITION BY c) AS ends FROM paths),
nodes AS (SELECT node, d, count(*) AS n_convs, any_value(words) AS words,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = ends), '')) AS ends_sha256
  FROM named GROUP BY node, d),
up AS (SELECT a.node, a.d, b.node AS parent FROM named a JOIN named b ON a.c = b.c AND b.d = a.d - 1 WHERE a.c = a.node),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM up GROUP BY 1, 2),
own AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node, d)),
below AS (SELECT a.node, a.d, sum(CASE WHEN o.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((o.n_convs - 1) * o.words) AS saved
  FROM own o JOIN named a ON a.c = o.node AND a.d <= o.d GROUP BY 1, 2)
SELECT o.node AS conv_id, o.d AS depth, u.parent AS parent_conv_id, o.n_convs, o.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, o.ends_sha256
FROM own o JOIN below b USING (node, d) LEFT JOIN up u USING (node, d)"""

#: Near words share the pattern of a replaced letter, or one is the other without a letter.
SPELLING = f"""WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'),
  lambda r: translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS w FROM documents) GROUP BY 1, 2),
hashed AS (SELECT w, n, {_RUN_BYTES} AS h FROM runs, crc_table),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 199 = 0
    THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
shorter AS (SELECT DISTINCT word, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS i FROM words)),
patterns AS (SELECT word, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS pattern
  FROM (SELECT word, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS i FROM words)),
near AS (SELECT a.word, b.word AS other FROM patterns a JOIN patterns b ON a.pattern = b.pattern AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, less FROM shorter WHERE less IN (SELECT word FROM words)
  UNION SELECT less, word FROM shorter WHERE less IN (SELECT word FROM words)),
best AS (SELECT a.word, count(*) AS n_near, arg_min(o.word, (-o.n, o.word)) AS best, max(o.n) AS best_n
  FROM near a JOIN words o ON o.word = a.other GROUP BY 1),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form,
  CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n FROM words w LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS root FROM forms
  UNION ALL SELECT ways.word, forms.form FROM ways JOIN forms ON forms.word = ways.root WHERE forms.form IS NOT NULL),
ends AS (SELECT ways.word, ways.root FROM ways JOIN forms ON forms.word = ways.root WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""
