from __future__ import annotations

from pyspark.sql import functions as F

from catalog_queries.registry import query
from catalog_queries.tables import LINES_SQL
from shopflow.functions import text as T, urls as U
from shopflow.operators import boilerplate as B, pages as P
from shopflow.plans import jobs
from shopflow.runtime import cut

BLANK = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query("SELECT doc_id, sha256(text) AS hash FROM documents")
def content_hash(read):
    return read.spread("documents").select("doc_id", T.content_hash(F.col("text")).alias("hash"))


@query("""SELECT doc_id, length(text) >= 500 AS long_enough, sha256(text) AS dedupe_key,
  sha256(substr(text, 1, 10000)) AS extractor_input, length(text) > 20000 AS too_long FROM documents""")
def text_gates(read):
    c = F.col("text")
    return read.spread("documents").select(
        "doc_id", T.long_enough(c).alias("long_enough"), T.dedupe_key(c).alias("dedupe_key"),
        F.sha2(T.extractor_input(c, 10_000), 256).alias("extractor_input"), T.too_long(c).alias("too_long"))


@query(r"""SELECT doc_id, count(*) AS lines_seen FROM (
  SELECT doc_id, unnest(CASE WHEN s[-1] = '' THEN s[1:len(s)-1] ELSE s END) AS line
  FROM (SELECT doc_id, string_split(replace(replace(text, '. ', '.' || chr(13) || chr(10)), chr(13) || chr(10), chr(10)), chr(10)) AS s FROM documents))
GROUP BY doc_id""", name="line_split")
def line_split(read):
    """Lines with two kinds of line ends."""
    mixed = F.replace("text", F.lit(". "), F.lit(".\r\n"))
    return read.spread("documents").select("doc_id", F.size(T.lines(mixed)).cast("long").alias("lines_seen")).where("lines_seen > 0")


def _marked_lines(read):
    lines = T.lines(F.col("text"))
    marked = F.transform(lines, lambda l, i: (
        F.when(i % 11 == 3, F.concat(F.lit("Price: "), l)).when(i % 11 == 5, F.concat(l, F.lit(" 12 €")))
        .when(i % 11 == 7, F.concat(F.lit("# "), l)).when(i % 11 == 9, F.concat(F.lit("VERFÜGBARKEIT "), l)).otherwise(l)))
    return read.spread("documents").select("doc_id", F.posexplode(marked).alias("line_no", "line"))


@query(rf"""WITH {LINES_SQL}, m AS (SELECT doc_id, line_no, CASE line_no % 11 WHEN 3 THEN 'Price: ' || line WHEN 5 THEN line || ' 12 €'
  WHEN 7 THEN '# ' || line WHEN 9 THEN 'VERFÜGBARKEIT ' || line ELSE line END AS line FROM doc_lines)
SELECT doc_id, line_no, NOT (line LIKE '#%'
  OR regexp_matches(lower(line), '(^|[^\p{{L}}\p{{M}}\p{{N}}_])(price|inventory|sku|item|lot|verfügbarkeit|vorrätig|availability|stock|zustand)($|[^\p{{L}}\p{{M}}\p{{N}}_])')
  OR regexp_matches(line, '[$€£]\s*[0-9]|[0-9]\s*[$€£]')) AS safe FROM m""")
def safe_lines(read):
    return _marked_lines(read).select("doc_id", F.col("line_no").cast("long").alias("line_no"), T.is_safe_line(F.col("line")).alias("safe"))


@query(rf"""WITH {LINES_SQL}
SELECT doc_id, block_no, CAST(sum(len(list_filter(regexp_split_to_array(line, '{BLANK}+'), lambda x: x <> ''))) AS BIGINT) AS words,
  sum(len(list_filter(regexp_split_to_array(line, '{BLANK}+'), lambda x: x <> ''))) > 3 AS valid
FROM (SELECT *, line_no // 2 AS block_no FROM doc_lines) GROUP BY doc_id, block_no""")
def valid_blocks(read):
    """Blocks of two lines."""
    lines = T.lines(F.col("text"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 2).cast("int")), lambda i: F.slice(lines, i * 2 + 1, F.lit(2)))
    rows = read.spread("documents").where(F.size(lines) > 0).select("doc_id", F.posexplode(blocks).alias("block_no", "block"))
    return rows.select("doc_id", F.col("block_no").cast("long").alias("block_no"),
                       T.word_count(F.col("block")).cast("long").alias("words"), T.is_valid_block(F.col("block")).alias("valid"))


@query(rf"""WITH {LINES_SQL}, m AS (
  SELECT doc_id, line_no, CASE WHEN line_no % 6 = 2 THEN repeat('#', line_no % 4 + 1) || ' Research ' || line
    WHEN line_no % 6 = 5 THEN repeat('#', line_no % 3 + 1) || ' About ' || line ELSE line END AS line,
    CASE WHEN line_no % 6 = 2 THEN line_no % 4 + 1 WHEN line_no % 6 = 5 THEN line_no % 3 + 1 END AS level,
    line_no % 6 = 2 AS noise FROM doc_lines),
seg AS (SELECT *, sum(CASE WHEN noise THEN 1 ELSE 0 END) OVER w AS seg FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
lev AS (SELECT *, first(level) OVER w AS seg_level FROM seg WINDOW w AS (PARTITION BY doc_id, seg ORDER BY line_no)),
st AS (SELECT *, max(CASE WHEN NOT noise AND level IS NOT NULL AND level <= seg_level THEN 1 ELSE 0 END) OVER (
         PARTITION BY doc_id, seg ORDER BY line_no) AS stopped FROM lev)
SELECT d.doc_id, coalesce(sha256(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE seg = 0 OR stopped = 1)), sha256('')) AS clean_hash
FROM documents d LEFT JOIN st USING (doc_id) GROUP BY d.doc_id""")
def noise_removal(read):
    """Every sixth line is a noise header, another one a plain header, at changing levels."""
    def mark(line, i):
        return (F.when(i % 6 == 2, F.concat(F.repeat(F.lit("#"), i % 4 + 1), F.lit(" Research "), line))
                .when(i % 6 == 5, F.concat(F.repeat(F.lit("#"), i % 3 + 1), F.lit(" About "), line))
                .otherwise(line))

    marked = F.array_join(F.transform(T.lines(F.col("text")), mark), "\n")
    return read.spread("documents").select("doc_id", F.sha2(T.remove_noise(marked), 256).alias("clean_hash"))


@query(rf"""WITH {LINES_SQL}, s AS (SELECT *, trim(line) AS bare, max(CASE WHEN line_no = 1 THEN trim(line) END) OVER d AS b1,
    max(CASE WHEN line_no = 3 THEN trim(line) END) OVER d AS b2, max(CASE WHEN line_no = 4 THEN trim(line) END) OVER d AS b3,
    lag(trim(line)) OVER o AS before, lead(trim(line)) OVER o AS after FROM doc_lines
    WINDOW d AS (PARTITION BY doc_id), o AS (PARTITION BY doc_id ORDER BY line_no)),
k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT coalesce(bare = b1, false)
    AND NOT coalesce(bare = b2 AND after = b3, false) AND NOT coalesce(before = b2 AND bare = b3, false)) AS clean,
    max(n_lines) AS n FROM s GROUP BY doc_id)
SELECT doc_id, sha256(coalesce(clean, '')) AS clean_hash,
  CASE WHEN length(text) = 0 THEN 0 ELSE length(coalesce(clean, '')) / length(text) END AS kept
FROM documents LEFT JOIN k USING (doc_id)""")
def block_removal(read):
    """Each document loses its second line and the pair of its fourth and fifth line, wherever they occur and as far as it has them."""
    bare = T.stripped_lines(F.col("text"))
    rows = read.spread("documents").withColumn("bare", bare)
    blocks = F.array(F.slice("bare", 2, 1), F.when(F.size("bare") >= 5, F.slice("bare", 4, 2)).otherwise(F.array().cast("array<string>")))
    clean = T.remove_blocks(F.col("text"), blocks)
    return rows.withColumn("clean", clean).select("doc_id", F.sha2("clean", 256).alias("clean_hash"),
                                                  T.deletion_rate(F.col("text"), F.col("clean")).alias("kept"))


DOCS_SQL = """
docs AS (SELECT source AS domain, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS url,
  'Welcome to our house of fine old things' || chr(10) || text || chr(10) || 'All offers are subject to change' || chr(10) || 'Opening hours every day from nine' AS markdown
  FROM documents)"""

PAIRS_SQL = """
fresh AS (SELECT * FROM docs WHERE length(markdown) >= 500
  QUALIFY row_number() OVER (PARTITION BY domain, sha256(markdown) ORDER BY url) = 1),
sample AS (SELECT domain, row_number() OVER (PARTITION BY domain ORDER BY url) AS doc_no, url, markdown FROM fresh
  QUALIFY doc_no <= 3),
pairs AS (SELECT a.domain, CASE WHEN a.doc_no = 1 THEN b.doc_no - 2 ELSE 2 END AS pair_no, a.doc_no AS doc_a, b.doc_no AS doc_b,
  a.markdown AS text_a, b.markdown AS text_b FROM sample a JOIN sample b ON a.domain = b.domain AND a.doc_no < b.doc_no)
"""
SAMPLE_SQL = f"{DOCS_SQL}, {PAIRS_SQL}"


def _shop_docs(read):
    return read.spread("documents").select(
        F.col("source").alias("domain"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("url"),
        F.concat(F.lit("Welcome to our house of fine old things\n"), "text",
                 F.lit("\nAll offers are subject to change\nOpening hours every day from nine")).alias("markdown"),
        F.lit(True).alias("success"), F.lit("product").alias("type"))


def _sample(read):
    docs = _shop_docs(read)
    return B.sample_docs(docs.select("domain", "url"), docs)


@query(f"WITH {SAMPLE_SQL} SELECT domain, CAST(doc_no AS BIGINT) AS doc_no, url, length(markdown) AS chars FROM sample")
def sample_docs(read):
    return _sample(read).select("domain", F.col("doc_no").cast("long").alias("doc_no"), "url", F.length("markdown").cast("long").alias("chars"))


@query(f"""WITH {SAMPLE_SQL} SELECT domain, CAST(pair_no AS BIGINT) AS pair_no, CAST(doc_a AS BIGINT) AS doc_a, CAST(doc_b AS BIGINT) AS doc_b,
  length(text_a) AS chars_a, length(text_b) AS chars_b FROM pairs""")
def doc_pairs(read):
    return B.doc_pairs(_sample(read)).select(
        "domain", *[F.col(c).cast("long").alias(c) for c in ("pair_no", "doc_a", "doc_b")],
        F.length("text_a").cast("long").alias("chars_a"), F.length("text_b").cast("long").alias("chars_b"))


RUNS_SQL = r"""
la AS (SELECT *, row_number() OVER (PARTITION BY domain, pair_no, line ORDER BY i) AS down, row_number() OVER (PARTITION BY domain, pair_no, line ORDER BY i DESC) AS up
   FROM (SELECT domain, pair_no, i, trim(ls[i + 1]) AS line FROM (SELECT *, unnest(range(len(ls))) AS i FROM (
   SELECT domain, pair_no, string_split(text_a, chr(10)) AS ls FROM pairs)))),
lb AS (SELECT *, row_number() OVER (PARTITION BY domain, pair_no, line ORDER BY j) AS down, row_number() OVER (PARTITION BY domain, pair_no, line ORDER BY j DESC) AS up
   FROM (SELECT domain, pair_no, j, trim(ls[j + 1]) AS line FROM (SELECT *, unnest(range(len(ls))) AS j FROM (
   SELECT domain, pair_no, string_split(text_b, chr(10)) AS ls FROM pairs)))),
met AS (SELECT la.domain, la.pair_no, i, j FROM la JOIN lb ON la.domain = lb.domain AND la.pair_no = lb.pair_no AND la.line = lb.line AND la.down = lb.down
   UNION SELECT la.domain, la.pair_no, i, j FROM la JOIN lb ON la.domain = lb.domain AND la.pair_no = lb.pair_no AND la.line = lb.line AND la.up = lb.up),
eq AS (SELECT *, i - j AS diag, i - row_number() OVER (PARTITION BY domain, pair_no, i - j ORDER BY i) AS island FROM met),
runs AS (SELECT domain, pair_no, min(i) AS a, min(j) AS b, count(*) AS n FROM eq GROUP BY domain, pair_no, diag, island),
boxes AS (
  SELECT domain, pair_no, CAST(0 AS BIGINT) AS alo, (SELECT count(*) FROM la WHERE la.domain = p.domain AND la.pair_no = p.pair_no) AS ahi,
    CAST(0 AS BIGINT) AS blo, (SELECT count(*) FROM lb WHERE lb.domain = p.domain AND lb.pair_no = p.pair_no) AS bhi,
    CAST(NULL AS BIGINT) AS ma, CAST(NULL AS BIGINT) AS mn
  FROM pairs p
  UNION ALL
  SELECT domain, pair_no, CASE s WHEN 1 THEN alo WHEN 2 THEN a + n ELSE alo END, CASE s WHEN 1 THEN a WHEN 2 THEN ahi ELSE alo END,
    CASE s WHEN 1 THEN blo WHEN 2 THEN b + n ELSE blo END, CASE s WHEN 1 THEN b WHEN 2 THEN bhi ELSE blo END,
    CASE WHEN s = 3 THEN a END, CASE WHEN s = 3 THEN n END
  FROM (
    SELECT x.domain, x.pair_no, alo, ahi, blo, bhi, m.a, m.b, m.n
    FROM boxes x, LATERAL (
      SELECT a + o AS a, b + o AS b, e - o AS n FROM (
        SELECT a, b, greatest(0, x.alo - a, x.blo - b) AS o, least(n, x.ahi - a, x.bhi - b) AS e
        FROM runs r WHERE r.domain = x.domain AND r.pair_no = x.pair_no) WHERE e > o
      ORDER BY n DESC, a, b LIMIT 1) m
    WHERE x.ahi > x.alo AND x.bhi > x.blo) f, (VALUES (1), (2), (3)) v(s)
)"""


SHARED_SQL = rf"""{PAIRS_SQL}, {RUNS_SQL},
found AS (SELECT m.domain, m.pair_no, m.ma, la.i, la.line,
   NOT (line LIKE '#%' OR regexp_matches(lower(line), '(^|[^\p{{L}}\p{{M}}\p{{N}}_])(price|inventory|sku|item|lot|verfügbarkeit|vorrätig|availability|stock|zustand)($|[^\p{{L}}\p{{M}}\p{{N}}_])')
     OR regexp_matches(line, '[$€£]\s*[0-9]|[0-9]\s*[$€£]')) AS safe
   FROM boxes m JOIN la ON la.domain = m.domain AND la.pair_no = m.pair_no AND la.i >= m.ma AND la.i < m.ma + m.mn WHERE m.ma IS NOT NULL),
block AS (SELECT domain, pair_no, ma, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY i) AS body FROM found WHERE safe GROUP BY domain, pair_no, ma
   HAVING len(list_filter(regexp_split_to_array(string_agg(line, ' ' ORDER BY i), '{BLANK}+'), lambda x: x <> '')) > 3),
once AS (SELECT domain, pair_no, min(ma) AS ma, n_lines, body FROM block GROUP BY domain, pair_no, n_lines, body),
first AS (SELECT * FROM once QUALIFY pair_no = min(pair_no) OVER (PARTITION BY domain))"""
BLOCKS_SQL = f"{DOCS_SQL}, {SHARED_SQL}"
CLEAN_SQL = """split AS (SELECT domain, url, markdown, string_split(markdown, chr(10)) AS ls, list_transform(string_split(markdown, chr(10)), lambda x: trim(x)) AS bare FROM docs),
spot AS (SELECT s.domain, s.url, i, n_lines FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM split) s JOIN first f ON f.domain = s.domain
  AND array_to_string(list_slice(bare, i, i + n_lines - 1), chr(10)) = body),
gone AS (SELECT DISTINCT domain, url, i + unnest(range(n_lines)) AS i FROM spot),
kept AS (SELECT s.domain, s.url, string_agg(s.ls[s.i], chr(10) ORDER BY s.i) AS clean FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM split) s
  LEFT JOIN gone g ON g.domain = s.domain AND g.url = s.url AND g.i = s.i WHERE g.i IS NULL GROUP BY s.domain, s.url)"""


@query(f"""WITH RECURSIVE {BLOCKS_SQL}
SELECT domain, row_number() OVER (PARTITION BY domain ORDER BY ma) - 1 AS block_no, n_lines, sha256(body) AS block_hash FROM first""")
def common_blocks(read):
    """Blocks shared by the sample pages of a source; a line that a page repeats meets by its number from the top and from the
    bottom. The SQL follows the same longest-first matching by recursion."""
    docs = _shop_docs(read)
    found = B.discover(_sample(read), docs.select("domain"))
    return found.select("domain", F.posexplode("blocks").alias("block_no", "block")).select(
        "domain", F.col("block_no").cast("long").alias("block_no"), F.size("block").cast("long").alias("n_lines"),
        F.sha2(F.array_join("block", "\n"), 256).alias("block_hash"))


@query(f"""WITH RECURSIVE {BLOCKS_SQL}, d AS (SELECT DISTINCT domain FROM docs)
SELECT d.domain, count(f.ma) OVER (PARTITION BY d.domain) AS blocks_found, coalesce(sum(n_lines) OVER (PARTITION BY d.domain), 0) AS total_lines,
  CASE WHEN f.ma IS NOT NULL THEN row_number() OVER (PARTITION BY d.domain ORDER BY f.ma) - 1 END AS block_no, substr(body, 1, 100) || '...' AS preview, n_lines
FROM d LEFT JOIN first f ON f.domain = d.domain""")
def block_summary(read):
    docs = _shop_docs(read)
    found = cut(B.discover(_sample(read), docs.select("domain")))
    made = B.discovery_summary(found).join(B.preview_blocks(found), "domain", "left")
    return made.select("domain", "preview", *[F.col(c).cast("long").alias(c) for c in ("blocks_found", "total_lines", "block_no", "n_lines")])


@query(f"""WITH RECURSIVE {BLOCKS_SQL}, {CLEAN_SQL}
SELECT s.domain, s.url, length(markdown) > 20000 AS too_long, length(coalesce(clean, '')) AS clean_chars, sha256(coalesce(clean, '')) AS clean_hash
FROM split s LEFT JOIN kept k ON k.domain = s.domain AND k.url = s.url""")
def clean_documents(read):
    """Noise and shared blocks out of every document."""
    docs = _shop_docs(read)
    blocks = cut(B.discover(_sample(read), docs.select("domain")))
    return B.clean_pages(docs, blocks).select(
        "domain", "url", "too_long", F.length("clean").alias("clean_chars"), F.sha2("clean", 256).alias("clean_hash"))


TOKEN = (r"""(?si)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"""
         r"""|</?[a-z][\w:-]*(?:[^>"']|"[^"]*"|'[^']*')*>|<[!?][^>]*>""").replace("'", "''")
EXCLUDED = ", ".join(f"'{t}'" for t in sorted({*P.EXCLUDED_TAGS, "head"}))
INLINE, VOID = (", ".join(f"'{t}'" for t in names) for names in (P._INLINE, P._VOID))


def _unescaped(c):
    """The character references of the given pages."""
    for name, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = f"replace({c}, '{name}', '{char}')"
    return c


#: Tokens of a page, and a recursion over those of excluded names, which holds the name that is skipped and its depth.
MARKDOWN_SQL = rf"""
page AS (SELECT page_id, url, regexp_extract_all(html, '{TOKEN}') AS tags, regexp_split_to_array(html, '{TOKEN}') AS texts FROM pages),
tok AS (SELECT page_id, i, tags[i] AS tag, texts[i + 1] AS txt, CASE WHEN regexp_matches(tags[i], '(?i)^<(script|style)\b') THEN '' ELSE lower(regexp_extract(tags[i], '(?i)^</?([a-z][\w:-]*)', 1)) END AS name,
  tags[i] LIKE '</%' AS closing FROM (SELECT *, unnest(range(1, len(tags) + 1)) AS i FROM page)),
ex AS (SELECT page_id, i, name, closing, tag LIKE '%/>' OR name IN ({VOID}) AS alone, row_number() OVER (PARTITION BY page_id ORDER BY i) AS n FROM tok WHERE name IN ({EXCLUDED})),
st(page_id, n, name, depth, since, lo, hi) AS (SELECT page_id, 0::BIGINT, '', 0, 0::BIGINT, NULL::BIGINT, NULL::BIGINT FROM page
  UNION ALL SELECT ex.page_id, ex.n,
    CASE WHEN st.depth = 0 THEN CASE WHEN ex.closing OR ex.alone THEN '' ELSE ex.name END WHEN ex.name <> st.name THEN st.name WHEN ex.closing AND st.depth = 1 THEN '' ELSE st.name END,
    CASE WHEN st.depth = 0 THEN CASE WHEN ex.closing OR ex.alone THEN 0 ELSE 1 END WHEN ex.name <> st.name THEN st.depth WHEN ex.closing THEN st.depth - 1 ELSE st.depth + 1 END,
    CASE WHEN st.depth = 0 THEN ex.i ELSE st.since END, CASE WHEN st.depth = 1 AND ex.name = st.name AND ex.closing THEN st.since END, CASE WHEN st.depth = 1 AND ex.name = st.name AND ex.closing THEN ex.i END
  FROM st JOIN ex ON ex.page_id = st.page_id AND ex.n = st.n + 1),
hide AS (SELECT page_id, lo, hi FROM st WHERE hi IS NOT NULL UNION ALL
  SELECT page_id, since, 1000000000 FROM (SELECT * FROM st QUALIFY n = max(n) OVER (PARTITION BY page_id)) WHERE depth > 0),
piece AS (SELECT t.page_id, t.i, CASE WHEN bool_or(t.i > lo AND t.i <= hi) THEN '' WHEN any_value(name) = '' THEN ''
    WHEN any_value(name) IN ({EXCLUDED}) THEN CASE WHEN any_value(closing) OR any_value(tag) LIKE '%/>' OR any_value(name) IN ({VOID}) THEN '' ELSE chr(1) || chr(2) END
    WHEN any_value(name) IN ({INLINE}) THEN ''
    ELSE chr(1) || CASE WHEN any_value(closing) THEN '' WHEN regexp_full_match(any_value(name), 'h[1-6]') THEN repeat('#', any_value(name)[2]::INTEGER) || ' ' WHEN any_value(name) = 'li' THEN '* ' ELSE '' END || chr(2) END
  || CASE WHEN bool_or(t.i >= lo AND t.i < hi) THEN '' ELSE {_unescaped('any_value(txt)')} END AS s
  FROM tok t LEFT JOIN hide h ON h.page_id = t.page_id GROUP BY t.page_id, t.i),
whole AS (SELECT p.page_id, any_value(p.url) AS url, {_unescaped('any_value(texts[1])')} || coalesce(string_agg(s, '' ORDER BY i), '') AS s FROM page p LEFT JOIN piece USING (page_id) GROUP BY p.page_id),
part AS (SELECT page_id, url, k, CASE WHEN contains(x, chr(2)) THEN split_part(x, chr(2), 1) ELSE '' END AS mark, trim(regexp_replace(CASE WHEN contains(x, chr(2)) THEN split_part(x, chr(2), 2) ELSE x END, '{BLANK}+', ' ', 'g')) AS body
  FROM (SELECT page_id, url, k, string_split(s, chr(1))[k] AS x FROM (SELECT *, unnest(range(1, len(string_split(s, chr(1))) + 1)) AS k FROM whole))),
md AS (SELECT page_id, any_value(url) AS url, coalesce(string_agg(mark || body, chr(10) ORDER BY k) FILTER (WHERE body <> ''), '') AS markdown FROM part GROUP BY page_id)"""


@query(f"WITH RECURSIVE {MARKDOWN_SQL} SELECT page_id, length(markdown) AS chars, sha256(markdown) AS hash FROM md")
def html_to_markdown(read):
    return P.html_to_markdown(read.spread("pages")).select("page_id", F.length("markdown").cast("long").alias("chars"), F.sha2("markdown", 256).alias("hash"))


@query(f"""WITH RECURSIVE {MARKDOWN_SQL}, docs AS (SELECT regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1) AS domain, url, markdown FROM md), {SHARED_SQL}, {CLEAN_SQL}
SELECT s.domain, s.url, length(markdown) AS raw_chars, length(coalesce(clean, '')) AS clean_chars,
  CASE WHEN length(markdown) = 0 THEN 0 ELSE length(coalesce(clean, '')) / length(markdown) END AS kept
FROM split s LEFT JOIN kept k ON k.domain = s.domain AND k.url = s.url""")
def boilerplate_shrink(read):
    """Which pages shrink by how much after the removal of blocks shared within their host."""
    return jobs.boilerplate_shrink(read.spread("pages").select(U.host(F.col("url")).alias("domain"), "url", "html"))


@query("""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN true WHEN doc_id % 3 = 0 THEN coalesce(text <> prev, true) ELSE false END AS changed,
  sha256(text) AS hash FROM (SELECT doc_id, text, lag(text) OVER (ORDER BY doc_id) AS prev FROM documents)""")
def change_detection(read):
    """Stored hashes: every third page had the text of the page before, every seventh page is new."""
    docs = read("documents").select("doc_id", F.lit("d").alias("domain"), F.col("doc_id").cast("string").alias("url"), "text")
    before = docs.select((F.col("doc_id") + 1).alias("doc_id"), F.sha2("text", 256).alias("old"))
    stored = (docs.where(F.col("doc_id") % 7 != 0).join(before, "doc_id", "left")
              .select("domain", "url", F.when(F.col("doc_id") % 3 == 0, F.col("old")).otherwise(F.sha2("text", 256)).alias("hash")))
    return P.with_change(docs, stored, "text").select("doc_id", "changed", "hash")
