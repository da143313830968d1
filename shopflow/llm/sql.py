"""DuckDB SQL of the queries that SQL can express.

Not among them: op1 (quantiles are sketches), op2 and op8 (trained models), op5, op6 and op13 (tokenizers, frames, packing), op9
and the pipeline (XXH64). Their tests compare with brute force.
"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
tri AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)),
twice AS (SELECT r, i FROM tri QUALIFY count(*) OVER (PARTITION BY r, t) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, i + unnest([0, 1, 2]) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT r, count(*) AS n, count(DISTINCT line) AS kinds FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (SELECT d.r, doc_id, lang, source, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(ln.n - ln.kinds, 0) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words, coalesce(ln.n, 0) AS n_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_capitals
  FROM d LEFT JOIN ln ON ln.r = d.r LEFT JOIN rep ON rep.r = d.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  coalesce('v' || lang, 'n') AS kl, coalesce('v' || source, 'n') AS ks FROM f),
rules AS (SELECT r, kl, ks, base_failed, unnest([
   {{'rule': 'symbols', 'v': n_symbols / greatest(n_words, 1), 'gap': 0.25}}, {{'rule': 'dup_lines', 'v': n_dup_lines / greatest(n_lines, 1), 'gap': 0.5}},
   {{'rule': 'repeats', 'v': n_repeat_words / greatest(n_words, 1), 'gap': 0.4}}, {{'rule': 'capitals', 'v': n_capitals / greatest(n_words, 1), 'gap': 0.25}},
   {{'rule': 'long_words', 'v': word_chars / greatest(n_words, 1), 'gap': 3.0}}]) AS x FROM b),
binned AS (SELECT r, kl, ks, x.rule AS rule, x.v AS v, x.gap AS gap,
   CASE WHEN x.v > 0 THEN 2 * pow(1.02, ceil(ln(x.v) / ln(1.02))) / 2.02 ELSE 0 END AS q FROM rules WHERE NOT base_failed),
g2 AS (SELECT kl, ks, rule, count(*) AS n, quantile_disc(q, 0.5) AS median, quantile_disc(q, 0.75) AS upper FROM binned GROUP BY ALL),
g1 AS (SELECT kl, rule, count(*) AS n, quantile_disc(q, 0.5) AS median, quantile_disc(q, 0.75) AS upper FROM binned GROUP BY ALL),
g0 AS (SELECT rule, any_value(gap) AS gap, quantile_disc(q, 0.5) AS median, quantile_disc(q, 0.75) AS upper FROM binned GROUP BY ALL),
lim AS (SELECT g2.kl, g2.ks, g2.rule,
   coalesce(CASE WHEN g2.n >= 200 THEN g2.upper + greatest(6.0 * (g2.upper - g2.median), gap) END,
     CASE WHEN g1.n >= 200 THEN g1.upper + greatest(6.0 * (g1.upper - g1.median), gap) END,
     g0.upper + greatest(6.0 * (g0.upper - g0.median), gap)) AS most
   FROM g2 JOIN g1 ON g1.kl = g2.kl AND g1.rule = g2.rule JOIN g0 ON g0.rule = g2.rule),
bad AS (SELECT binned.r, string_agg(binned.rule, ',' ORDER BY list_position(['symbols', 'dup_lines', 'repeats', 'capitals', 'long_words'], binned.rule)) AS failed
   FROM binned JOIN lim ON lim.kl = binned.kl AND lim.ks = binned.ks AND lim.rule = binned.rule WHERE v > most GROUP BY binned.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed IS NULL AS kept,
  coalesce(failed, '') AS failed_rules FROM b LEFT JOIN bad ON bad.r = b.r"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s QUALIFY rank <= 20"""

MIX = rf"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size, coalesce('v' || source, 'n') AS k FROM documents),
h AS (SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(size AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0 AS h FROM d),
src AS (SELECT k, any_value(source) AS source, sum(size) AS source_size FROM d GROUP BY k),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class FROM src),
ww AS (SELECT *, [5.0, 2.0, 1.0][class + 1]::DOUBLE AS weight, 2.0 * source_size::DOUBLE AS lim FROM w),
fill AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5 AS demand,
   coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
   sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS "left" FROM ww),
op AS (SELECT *, lim / weight > (demand - filled) / "left" AS open FROM fill),
lev AS (SELECT *, (SELECT (demand - filled) / "left" FROM op WHERE open ORDER BY lim / weight, source NULLS LAST LIMIT 1) AS level FROM op),
t AS (SELECT k, class, source_size, CASE WHEN open THEN weight * level ELSE lim END AS target FROM lev),
p AS (SELECT h.*, coalesce(sum(size) OVER (PARTITION BY k ORDER BY h, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM h),
j AS (SELECT doc_id, size, CAST(t.source_size AS BIGINT) AS source_size, target, start, class,
   CASE WHEN size > 0 AND start < target THEN start / target END AS u FROM p JOIN t ON t.k = p.k),
z AS (SELECT *, [1.5, 1.0, 0.5][class + 1]::DOUBLE AS f0, [-1.0, 0.0, 1.0][class + 1]::DOUBLE AS slope FROM j)
SELECT doc_id, size, source_size, target,
  CAST(greatest(least(floor(target) - start, size), 0) + greatest(least(floor(target) - start - source_size, size), 0) AS BIGINT) AS taken,
  CASE WHEN size > 0 AND start + size / 2 <= target THEN 1 ELSE 0 END + CASE WHEN size > 0 AND start + source_size + size / 2 <= target THEN 1 ELSE 0 END AS copies,
  CASE WHEN u IS NOT NULL THEN least(greatest(2 * u / (f0 + sqrt(greatest(f0 * f0 + 2 * slope * u, 0))), 0), 1) END AS position FROM z"""

SUBSTRING = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS k, {WORDS} AS w FROM documents),
win AS (SELECT r, k, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h FROM (SELECT r, k, w, unnest(range(1, greatest(len(w) - 48, 1))) AS i FROM d)),
hit AS (SELECT r, i FROM win QUALIFY min(k) OVER (PARTITION BY h) < k),
gone AS (SELECT DISTINCT r, i + o AS p FROM hit, range(50) t(o)),
word AS (SELECT r, p, w[p] AS x FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (SELECT word.r, string_agg(x, ' ' ORDER BY word.p) AS t FROM word LEFT JOIN gone ON gone.r = word.r AND gone.p = word.p WHERE gone.p IS NULL GROUP BY word.r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.r = d.r LEFT JOIN n ON n.r = d.r"""

DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
gc AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN gc USING (lang, source) GROUP BY ALL),
p AS (SELECT lang, source, term, coalesce(gc.c, 0) AS c, CAST(1 + 1000000000 * (coalesce(gc.c, 0) + 1)::HUGEINT // (g.n + v.v) AS BIGINT) AS p,
  CAST(1 + 1000000000 * (k.c + 1)::HUGEINT // (v.n + v.v) AS BIGINT) AS q FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN gc USING (lang, source, term)),
f AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL
SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM term QUALIFY rank <= 200"""


def _assigned(name: str, books: str) -> str:
    """Each part with its nearest entry of ``books`` (p, e, v) and the squared distance."""
    return f"""{name} AS (SELECT r, p, x, unnest(min_by({{'e': e, 'd': d}}, d * 256 + e, 1)) AS a FROM (SELECT part.r, part.p, part.x, b.e,
  CAST(list_sum(list_transform(range(1, len(part.x) + 1), lambda i: (part.x[i] - b.v[i]) * (part.x[i] - b.v[i]))) AS BIGINT) AS d
  FROM part JOIN {books} b ON b.p = part.p) GROUP BY r, p, x)"""


def _updated(name: str, assigned: str, books: str) -> str:
    return f"""{name} AS (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM {books} b LEFT JOIN (
  SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS v FROM (SELECT p, a.e AS e, i, sum(x[i]) AS s, count(*) AS n
  FROM {assigned}, range(1, 1 + (SELECT max(len(x)) FROM part)) t(i) GROUP BY ALL) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""


LLOYD = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (SELECT r, p, list_slice(v, p * len(v) // 16 + 1, (p + 1) * len(v) // 16) AS x FROM v, range(16) t(p)),
first AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v QUALIFY e < 64),
b0 AS (SELECT p, e, x AS v FROM part JOIN first USING (r)),
{_assigned('a1', 'b0')}, {_updated('b1', 'a1', 'b0')}, {_assigned('a2', 'b1')}, {_updated('b2', 'a2', 'b1')}, {_assigned('a3', 'b2')},
sha AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS h FROM b2),
c AS (SELECT r, string_agg(lpad(lower(to_hex(a.e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(a.d) AS BIGINT) AS error FROM a3 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM sha) AS codebooks_sha256 FROM c JOIN v USING (r)"""

ORACLES = {"op3_quality": QUALITY, "op4_branch_and_bound": TOP_K, "op7_curriculum": MIX, "op10_suffix_automata": SUBSTRING,
           "op11_translate_divergence": DIVERGENCE, "op12_resident_lloyd": LLOYD}
