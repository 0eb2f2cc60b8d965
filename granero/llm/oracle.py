"""The same questions in SQL, for the operators that SQL can express."""

from __future__ import annotations

from granero.llm.quality_rules import COMMON_WORDS, MAX_REPEAT_PERCENT, MIN_WORDS

_WHITE = r"[\x20\x09-\x0D]+"
_COMMON = sorted({w for group in COMMON_WORDS.values() for w in group})

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS b FROM pages),
m AS (SELECT h, max(page_id) AS r FROM p WHERE b >= 1000 GROUP BY h)
SELECT page_id, b AS payload_bytes, sha1(p.h) AS payload_digest, CASE WHEN r <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN r <> page_id THEN r END AS refers_to
FROM p LEFT JOIN m ON m.h = p.h"""

TOP_K = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""

PERSPECTIVES = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unnamed') AS speaker, coalesce(text, '') AS body FROM conversations),
v AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t),
s AS (SELECT t.conv_id, perspective, turn, speaker, CASE WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
    CASE WHEN speaker = perspective THEN body ELSE speaker || ': ' || body END AS content
  FROM t JOIN v ON t.conv_id IS NOT DISTINCT FROM v.conv_id),
g AS (SELECT *, '<|' || role || '|>' || chr(10) || content || '<|end|>' || chr(10) AS segment FROM s),
o AS (SELECT *, CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, content
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM g)
SELECT *, CASE WHEN role = 'assistant' THEN start + 14 END AS mask_start,
  CASE WHEN role = 'assistant' THEN start + length(segment) END AS mask_end FROM o"""

NEAR_COPIES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END AS g
  FROM w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach(u, v) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.u, l.v FROM reach r JOIN l ON l.u = r.v)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(v) FROM reach r WHERE r.u = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id"""

_CLASS_COUNTS = ", ".join((
    r"length(regexp_replace(t, '[^\p{Ll}]', '', 'g'))", r"length(regexp_replace(t, '[^\p{Lu}]', '', 'g'))",
    r"length(regexp_replace(t, '[^\p{Lt}\p{Lm}\p{Lo}]', '', 'g'))", r"length(regexp_replace(t, '[^\p{Nd}]', '', 'g'))",
    "length(t) - word_chars", "n_symbols"))
_WORD_COUNTS = ", ".join(f"len(list_filter(lw, lambda x: x = '{w}'))" for w in _COMMON)


def _nearest(histogram: str, count: int, least: int) -> str:
    """Distance of every document's histogram to the nearest language's, where it is large enough."""
    return f"""
  SELECT doc_id, min(sqrt(greatest(0, d / 2))) AS d FROM (
    SELECT f.doc_id, r.lang, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) AS d
    FROM (SELECT doc_id, i, {histogram}[i] / CAST(list_sum({histogram}) AS DOUBLE) AS p FROM f, unnest(range(1, {count + 1})) u(i)
      WHERE list_sum({histogram}) >= {least}) f
    JOIN (SELECT lang, i, sum({histogram}[i]) / CAST(sum(sum({histogram}[i])) OVER (PARTITION BY lang) AS DOUBLE) AS q
      FROM f, unnest(range(1, {count + 1})) u(i) WHERE NOT base_failed GROUP BY lang, i) r ON r.i = f.i
    GROUP BY f.doc_id, r.lang) x WHERE NOT isnan(d) GROUP BY doc_id"""


QUALITY = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{_WHITE}'), lambda x: x <> '') AS ws,
  regexp_split_to_array(lower(t), '{_WHITE}') AS lw, length(regexp_replace(t, '{_WHITE}', '', 'g')) AS word_chars,
  length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 2]) AS c FROM w, unnest(range(1, len(ws) - 1)) u(i)),
k AS (SELECT doc_id, count(DISTINCT j) AS n FROM g, unnest([i, i + 1, i + 2]) u(j) WHERE c > 1 GROUP BY 1),
b AS (SELECT w.*, len(ws) AS n_words, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(k.n, 0) AS n_repeat_words,
  len(ws) < {MIN_WORDS} OR 100 * coalesce(k.n, 0) > {MAX_REPEAT_PERCENT} * len(ws) AS base_failed FROM w LEFT JOIN k ON k.doc_id = w.doc_id),
h AS (SELECT *, [{_CLASS_COUNTS}] AS six, [{_WORD_COUNTS}] AS common FROM b),
f AS (SELECT *, list_append(six, greatest(0, word_chars - six[1] - six[2] - six[3] - six[4] - six[6])) AS classes FROM h),
c AS ({_nearest('classes', 7, 200)}),
m AS ({_nearest('common', len(_COMMON), 20)})
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(c.d, 0) <= 0.3 AND coalesce(m.d, 0) <= 0.8 AS kept
FROM f LEFT JOIN c ON c.doc_id = f.doc_id LEFT JOIN m ON m.doc_id = f.doc_id"""

FILTER_AUDIT = r"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY 1),
t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
    CASE WHEN len(w) < 50 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN first < t.doc_id THEN 'E' ELSE '' END) AS fails
  FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT concat(a.k, b.k, c.k, d.k, e.k) AS filter_order FROM x a JOIN x b ON b.k <> a.k JOIN x c ON c.k NOT IN (a.k, b.k)
  JOIN x d ON d.k NOT IN (a.k, b.k, c.k) JOIN x e ON e.k NOT IN (a.k, b.k, c.k, d.k)),
s AS (SELECT filter_order, step, filter_order[step:step] AS k, filter_order[1:step - 1] AS before FROM o, unnest(range(1, 6)) u(step)),
r AS (SELECT part, filter_order, step, k, sum(n) FILTER (WHERE before || k = translate(before || k, fails, '')) AS kept,
    sum(n) FILTER (WHERE contains(fails, k) AND before = translate(before, fails, '')) AS removed,
    sum(n) FILTER (WHERE contains(fails, k) AND before <> translate(before, fails, '')) AS redundant,
    sum(n) FILTER (WHERE fails = k) AS unique_fails,
    sum(good) FILTER (WHERE contains(fails, k) AND before = translate(before, fails, '')) AS good_lost,
    sum(toxic) FILTER (WHERE contains(fails, k) AND before = translate(before, fails, '')) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM r"""

PHRASES = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f FROM w, unnest([1, 2, 3, 4]) u(k), unnest(range(1, len(w) - k + 2)) v(i) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT * FROM g WHERE f >= 30),
c AS (SELECT c.lang, c.k, c.g, c.f AS a, x.k AS cut, x.f AS l, y.f AS r, (CAST(c.f AS HUGEINT) * 2000000) // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM f c JOIN f x ON x.lang = c.lang AND x.k < c.k AND x.g = c.g[1:x.k] JOIN f y ON y.lang = c.lang AND y.g = c.g[x.k + 1:]),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
i AS (SELECT DISTINCT s.lang, s.g FROM f o, unnest(range(1, o.k)) u(m), unnest(range(1, o.k - m + 2)) v(j)
  JOIN f s ON s.lang = o.lang AND s.k = m AND s.g = o.g[j:j + m - 1] AND 100 * o.f >= 80 * s.f),
r AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(array_to_string(b.g, ' '))) AS rank,
    array_to_string(b.g, ' ') AS phrase, a, l, r, score FROM b LEFT JOIN i ON i.lang = b.lang AND i.g = b.g WHERE i.g IS NULL)
SELECT r.lang, CAST(rank AS INTEGER) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
  CAST(score AS BIGINT) AS score FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000"""

ORACLE: dict[str, str] = {
    "op1_warc_archive": WARC, "op5_exact_topk": TOP_K, "op6_chat_perspectives": PERSPECTIVES, "op8_ngram_jaccard": NEAR_COPIES,
    "op9_quality_rules": QUALITY, "op11_phrase_collocations": PHRASES, "op12_filter_audit": FILTER_AUDIT,
}
