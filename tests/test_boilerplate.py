import difflib
import random
import re

from pyspark.sql import functions as F

from shopflow.functions import text as T
from shopflow.operators import boilerplate as B, pages as P
from shopflow.sources import store

WORDS = re.compile(r"(?i)\b(" + "|".join(T.CRITICAL_WORDS) + r")\b")
SIGNS = re.compile(r"[\$€£]\s*\d|\d\s*[\$€£]")


def matches_by_number(la, lb):
    """Longest-first runs without crossing, where a line that repeats meets by its number from the top and from the bottom."""
    def numbers(ls):
        return [(x, ls[:i].count(x)) for i, x in enumerate(ls)], [(x, ls[i + 1:].count(x)) for i, x in enumerate(ls)]

    met = {(i, j) for na, nb in zip(numbers(la), numbers(lb)) for i, x in enumerate(na) for j, y in enumerate(nb) if x == y}

    def best(alo, ahi, blo, bhi):
        found = []
        for i, j in met:
            if alo <= i < ahi and blo <= j < bhi and not ((i - 1, j - 1) in met and i > alo and j > blo):
                n = 1
                while (i + n, j + n) in met and i + n < ahi and j + n < bhi:
                    n += 1
                found.append((-n, i, j))
        if not found:
            return []
        n, i, j = min(found)
        return best(alo, i, blo, j) + [(i, -n)] + best(i - n, ahi, j - n, bhi)

    return best(0, len(la), 0, len(lb))


def matches_by_library(la, lb):
    return [(m.a, m.size) for m in difflib.SequenceMatcher(None, la, lb, autojunk=False).get_matching_blocks()]


def blocks_by_hand(a, b, matches):
    la, lb = [x.strip() for x in a.splitlines()], [x.strip() for x in b.splitlines()]
    out = []
    for i, n in matches(la, lb):
        safe = [x for x in la[i:i + n] if not WORDS.search(x) and not SIGNS.search(x) and not x.startswith("#")]
        if sum(len(x.split()) for x in safe) > 3 and safe not in out:
            out.append(safe)
    return out


def found_blocks(spark, texts):
    df = spark.createDataFrame([(f"d{i}", 0, a, b) for i, (a, b) in enumerate(texts)], "domain string, pair_no int, text_a string, text_b string")
    return {r.domain: r.blocks for r in B.common_blocks(df).collect()}


POOL = ["Open from nine to five", "Price: $100", "We ship to all of Europe", "one", "", "# Head", "  Call our team any time  ", "two words"]


def test_common_blocks(spark):
    rng = random.Random(6)
    texts = [("\n".join(rng.choices(POOL, k=rng.randint(1, 12))), "\n".join(rng.choices(POOL, k=rng.randint(1, 12)))) for _ in range(150)]
    assert found_blocks(spark, texts) == {f"d{i}": blocks_by_hand(a, b, matches_by_number) for i, (a, b) in enumerate(texts)}


def test_common_blocks_of_lines_that_do_not_repeat(spark):
    rng = random.Random(8)
    lines = POOL + [f"line {i} has some words" for i in range(12)]
    texts = [("\n".join(rng.sample(lines, rng.randint(1, 20))), "\n".join(rng.sample(lines, rng.randint(1, 20)))) for _ in range(80)]
    texts += [("\n".join(lines[i:i + 9] + lines[:2]), "\n".join(lines[i + 2:i + 11])) for i in range(8)]
    assert found_blocks(spark, texts) == {f"d{i}": blocks_by_hand(a, b, matches_by_library) for i, (a, b) in enumerate(texts)}


def test_header_and_footer_around_repeated_lines(spark):
    header, footer = "Fine clocks since 1890\n\nHome and all departments\n", "\nWrite to our office\n\nAll rights are reserved here"
    pages = [header + "\n".join(f"text {p} {i}\n" for i in range(p)) + footer for p in (3, 5)]
    assert found_blocks(spark, [pages]) == {"d0": [header.split("\n")[:3], footer.split("\n")]}


def test_repeated_lines_meet_in_proportion(spark):
    for n in (50, 400):
        df = spark.createDataFrame([("d", 0, "\n".join(["---"] * n), "\n".join(["---"] * (n + 7)))], "domain string, pair_no int, text_a string, text_b string")
        assert B.met_lines(df).count() <= 2 * n
    assert found_blocks(spark, [("", ""), ("a b c d", "a b c d")]) == {"d0": [], "d1": [["a b c d"]]}


def docs_frame(spark, rows):
    return spark.createDataFrame(rows, "domain string, url string, markdown string, success boolean")


def test_sampling(spark):
    rows = [("t", "a", "short", True), ("t", "b", "walnut chest " * 60, True), ("t", "c", "about our team " * 60, True),
            ("t", "d", "walnut chest " * 60, True), ("t", "e", "x" * 600, False)]
    docs = docs_frame(spark, rows)
    got = B.sample_docs(docs.select("domain", "url"), docs, n=2, accept=F.col("markdown").contains("chest")).collect()
    assert [(r.doc_no, r.url) for r in got] == [(1, "b")]
    many = docs_frame(spark, [("t", f"{i:03}", str(i) * 600, True) for i in range(30)])
    got = B.sample_docs(many.select("domain", "url"), many).collect()
    assert sorted(r.url for r in got) == ["000", "001", "002"]
    late = B.sample_docs(many.select("domain", "url"), many, accept=F.col("url") > "013").collect()
    assert [r.url for r in late] == ["014", "015", "016"]
    far = docs_frame(spark, [("t", f"{i:03}", "short" if i < 40 else str(i) * 600, True) for i in range(44)])
    assert [r.url for r in B.sample_docs(far.select("domain", "url"), far).collect()] == ["040", "041", "042"]
    tails = docs_frame(spark, [("t", f"{i}", "y" * 6000 + str(i), True) for i in range(3)])
    assert B.sample_docs(tails.select("domain", "url"), tails).count() == 3


def test_discovery_job(spark, tmp_path):
    header, footer = "Clocks and lamps since 1890", "Open daily from nine to six"

    def page(i):
        return "\n".join([header, f"Piece {i} " * 60, footer])

    rows = [("two.de", f"u{i}", page(i), True) for i in range(2)] + [("one.de", "u", page(9), True)] + [
        ("late.de", "u0", "A " * 300, True), ("late.de", "u1", page(1), True), ("late.de", "u2", page(2), True), ("old.de", "u", page(3), True)]
    pages = docs_frame(spark, rows)
    urls = pages.select("domain", "url", F.lit("product").alias("type"))
    stored = spark.createDataFrame([("old.de",)], "domain string")
    found = B.discover_boilerplate(urls, pages, stored, "2026-01-01T00:00:00Z")
    got = {r.domain: r.blocks for r in found.collect()}
    assert got == {"two.de": [[header], [footer]], "one.de": [], "late.de": [[header], [footer]]}

    path = str(tmp_path / "blocks")
    store.write_blocks(found, path)
    read = {r.domain: r.blocks for r in store.read_blocks(spark, path, spark.createDataFrame([("one.de",), ("new.de",)], "domain string")).collect()}
    assert read == {"one.de": [], "new.de": None}

    cleaned = {(r.domain, r.url): r.clean for r in B.clean_pages(pages, store.read_blocks(spark, path)).collect()}
    assert cleaned[("two.de", "u1")] == ("Piece 1 " * 60)
    assert cleaned[("old.de", "u")] == page(3)
    summary = {r.domain: (r.blocks_found, r.total_lines) for r in B.discovery_summary(found).collect()}
    assert summary["two.de"] == (2, 2) and summary["one.de"] == (0, 0)
    assert B.preview_blocks(found).where("domain = 'two.de'").orderBy("block_no").first().preview == header + "..."


HTML = """<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href="/x">X</a></li></ul></nav>
<header><div><header>in</header>still</div></header><h1>Old <b>chair</b></h1><p>Price &amp; more<br>next</p><script>var a="</p>";</script>
<ul><li>one</li><li>two</ul><img src="https://a.b/c.jpg" alt="C"><form><input>no</form><!-- no --><p>end"""


def test_html_to_lines(spark):
    df = spark.createDataFrame([(HTML,), (None,), ("",)], "html string")
    got = [r.markdown for r in P.html_to_markdown(df).collect()]
    assert got == ["# Old chair\nPrice & more\nnext\n* one\n* two\n![C](https://a.b/c.jpg)\nend", None, ""]


def test_page_lines_of_odd_pages(spark):
    """Nested and open excluded tags, references, stray tags, blanks, comments that never end."""
    pages = {
        "<p>a</p><nav><nav>x</nav>y</nav>b<aside>c": "a\nb",
        "a &lt;b&gt; &#233; &#xE9; &eacute; &amp;amp; &notit; &copy 1 &unknown; & &#0; &#1114112; &#55296;": "a <b> é é é &amp; ¬it; © 1 &unknown; & \ufffd \ufffd \ufffd",
        "x<!-- never <p>closed": "x",
        "<script>if (a < b) { '</p>' }</script>t<style>p{}": "t",
        "</nav>a<nav/>b<input>c<form>d</form >e": "abc\ne",
        "<h2 class='x>y'>  T  i </h2><li><h3>n</h3></li>": "## T i\n### n",
        '<img alt="A" src="a&amp;b"><img alt="no"><IMG SRC=q>': "![A](a&b)![](q)",
        "<div>one<br>two<span>three</span> four\t\u00a0five</div>": "one\ntwothree four five",
        "<header>h</header><main>m<footer>f": "m",
        "   ": "", "a\x01b\x02c": "abc",
    }
    df = spark.createDataFrame([(k,) for k in pages], "html string")
    assert {r.html: r.markdown for r in P.html_to_markdown(df).collect()} == pages
    plan = P.html_to_markdown(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_links(spark):
    html = '<a href="/a">x</a><A class=c HREF=\'https://o.com/b#t\'>y</A><a href="mailto:x@y.z">m</a><a href="?p=1&amp;q=2">z</a>'
    df = spark.createDataFrame([("https://www.e.com/d/", html)], "url string, html string")
    got = [tuple(r) for r in P.extract_links(df).orderBy("ord").collect()]
    assert got == [("https://www.e.com/d", "https://www.e.com/a", "internal", 0), ("https://www.e.com/d", "https://o.com/b", "external", 1),
                   ("https://www.e.com/d", "https://www.e.com/d?p=1&q=2", "internal", 3)]


def test_change_detection(spark):
    pages = spark.createDataFrame([("d", "same", "x"), ("d", "other", "y"), ("d", "new", "z"), ("d", "empty", "w")], "domain string, url string, markdown string")
    stored = spark.createDataFrame([("d", "same", "x"), ("d", "other", "x"), ("d", "empty", None)], "domain string, url string, t string").select(
        "domain", "url", F.sha2("t", 256).alias("hash"))
    changed, unchanged = P.detect_changes(pages, stored)
    assert {r.url for r in changed.collect()} == {"other", "new", "empty"} and [r.url for r in unchanged.collect()] == ["same"]
