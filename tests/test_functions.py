import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shopflow.functions import states as S, text as T, urls as U

NEL, NBSP, LS, EM = chr(0x85), chr(0xA0), chr(0x2028), chr(0x2003)


def column(spark, values, expr, schema="v string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_keys_and_states(spark):
    assert column(spark, ["US", "COUNTRY#US", None], S.country_key) == ["COUNTRY#US", "COUNTRY#US", None]
    assert column(spark, ["SHOP#a.de", "a.de", "SHOP#SHOP#a"], S.domain_from_key) == ["a.de", "a.de", "SHOP#a"]
    parsed = column(spark, ["NEVER#", "PROGRESS#t", "DONE#t", None], S.parse_state)
    assert [p and (p.state, p.ts) for p in parsed] == [("NEVER#", None), ("PROGRESS#", "t"), ("DONE#", "t"), None]
    assert column(spark, ["NEVER#", "NEVER#x", "DONE#", "DONE#x", "x", None], S.is_valid_state) == [
        True, False, False, True, False, True]
    for fn in (S.parse_state, S.validate_state):
        with pytest.raises(PySparkException):
            column(spark, ["INVALID#"], fn)


def test_cutoff_and_operation():
    from datetime import datetime, timezone

    assert S.cutoff(datetime(2026, 1, 3, tzinfo=timezone.utc)) == "2026-01-01T00:00:00+00:00"
    with pytest.raises(ValueError):
        S.operation_column("fly")


def test_lines_like_python(spark):
    rng = random.Random(1)
    alphabet = ["a", "b ", "\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1e", NEL, LS, NBSP, EM, "\t", "#"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(300)]
    assert column(spark, texts, T.lines) == [t.splitlines() for t in texts]
    assert column(spark, texts, T.stripped_lines) == [[x.strip() for x in t.splitlines()] for t in texts]


SAFE = ["Open daily from ten", "Write to the owner"]
UNSAFE = ["price on request", "sku 77-b", "Verfügbarkeit unklar", "VERFÜGBARKEIT", "now only € 12", "5 £", "# Oak tables", "### More"]


def test_safe_lines(spark):
    assert column(spark, SAFE + UNSAFE, T.is_safe_line) == [True] * len(SAFE) + [False] * len(UNSAFE)
    assert column(spark, ["pricey", "lots", "allotment"], T.is_safe_line) == [True] * 3


def test_valid_blocks(spark):
    blocks = [[], ["one"], ["one two"], ["one two three"], ["one two three four"], ["one two", "three four"], [" ", ""]]
    assert column(spark, blocks, T.is_valid_block, "v array<string>") == [False] * 4 + [True, True, False]


def noise_by_hand(text):
    out, level = [], None
    for line in text.splitlines():
        bare = line.strip()
        if bare.startswith("#"):
            depth = min(6, len(bare) - len(bare.lstrip("#")))
            if any(t in bare[depth:].lower() for t in T.NOISE_TITLES):
                level = depth
                continue
            if level is not None and depth <= level:
                level = None
        if level is None:
            out.append(line)
    return "\n".join(out)


def test_noise_sections(spark):
    rng = random.Random(2)
    parts = ["text", " text ", "# Search", "## Research", "### About", "## About", "#Kontakt", "####### x", "  ## Links ", "", "# Ähnliche Produkte"]
    texts = ["\n".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(300)]
    assert column(spark, texts, T.remove_noise) == [noise_by_hand(t) for t in texts]
    nested = "## Main\nInfo\n### Related Products\nNested junk\n### Social\nMore junk\n## Next Section\nSafe info"
    higher = "### Section 1\nKeep 1\n## Related Products\nRemove\n### Still part of it\nRemove too\n## Section 2\nKeep 2"
    assert column(spark, [nested, higher], T.remove_noise) == [
        "## Main\nInfo\n## Next Section\nSafe info", "### Section 1\nKeep 1\n## Section 2\nKeep 2"]


def blocks_by_hand(text, blocks, overlap):
    if not blocks or not text:
        return text
    lines = text.splitlines()
    bare = [x.strip() for x in lines]
    spans = [(i, len(b)) for b in blocks if b for i in range(len(bare) - len(b) + 1) if bare[i:i + len(b)] == b]
    if overlap == "union":
        gone = {i + k for i, n in spans for k in range(n)}
        return "\n".join(x for i, x in enumerate(lines) if i not in gone)
    for i, n in sorted(spans, reverse=True):
        del lines[i:i + n]
    return "\n".join(lines)


@pytest.mark.parametrize("overlap", ["union", "sequential"])
def test_block_removal(spark, overlap):
    rng = random.Random(3)
    cases = []
    for _ in range(300):
        text = "\n".join(rng.choices(["a", " a", "b", "c ", ""], k=rng.randint(0, 10)))
        blocks = [rng.choices(["a", "b", "c", ""], k=rng.randint(0, 3)) for _ in range(rng.randint(0, 3))]
        cases.append((len(cases), text, blocks))
    df = spark.createDataFrame(cases, "i int, t string, b array<array<string>>")
    got = [r.o for r in df.select("i", T.remove_blocks(F.col("t"), F.col("b"), overlap).alias("o")).orderBy("i").collect()]
    assert got == [blocks_by_hand(t, b, overlap) for _, t, b in cases]
    with pytest.raises(ValueError):
        T.remove_blocks(F.col("t"), F.col("b"), "other")


def test_null_blocks_leave_text(spark):
    df = spark.createDataFrame([("x\n", None)], "t string, b array<array<string>>")
    assert df.select(T.remove_blocks(F.col("t"), F.col("b"))).first()[0] == "x\n"


REPLIES = {
    '{"key": "value"}': '{"key": "value"}', 'Pre-text {"key": "value"} Post-text': '{"key": "value"}',
    '```json\n{"nested": {"id": 1}}\n```': '{"nested": {"id": 1}}', '{"title": "Möbel"}': '{"title": "Möbel"}', "Invalid text": "{}", "": "{}",
    '{"a": 1} {"b": 2}': '{"a": 1}', '{"a": 1': "{}", '} {"a": 2}': '{"a": 2}', '{"a": "x\ny"}': '{"a": "x y"}', "1, 2": "{}", "1],[2": "{}",
    '{"a": "}"}': '{"a": "}"}'}


def test_salvage(spark):
    assert column(spark, list(REPLIES), T.salvage_json) == list(REPLIES.values())


def test_urls(spark):
    df = spark.createDataFrame([
        ("/The", "http://Ex.com/fr/825?page=2", "http://ex.com/The"), ("#top", "http://Ex.com/a/?q=1#b", "http://ex.com/a?q=1"),
        ("https://M.a.com/X/?utm_source=f&b=1&utm_x=2#t", "http://x.y", "https://m.a.com/X?b=1"), ("../q/./z.html", "http://e.com/a/b/c", "http://e.com/a/q/z.html"),
        ("//h.com/", "https://e.com", "https://h.com"), ("?z=1", "http://e.com/a", "http://e.com/a?z=1"), ("a?utm_a=1", "http://e.com", "http://e.com/a")],
        "h string, b string, want string")
    assert df.where(U.normalize_url(F.col("h"), F.col("b")) != F.col("want")).count() == 0
    assert column(spark, ["shop.example.co.uk", "example.de", "https://www.a.b.com/x", "localhost", "10.0.0.1"], U.core_domain) == [
        "example", "example", "b", "localhost", "10.0.0.1"]
    assert column(spark, ["https://a.de/", "http://a.de", "a.de/", "a.de"], U.clean_domain) == ["a.de"] * 4


def test_exclusions(spark):
    assert column(spark, ["http://a/x.JPG?y", "http://a.b/x", "http://a/x.tar.gz", "http://a/p.html#x.jpg"], U.has_extension) == [True, False, True, False]
    from urllib.parse import urlparse

    shapes = ["http://a.jpg", "http://a.jpg/", "http://a/x.jpg;v=1", "//h.jpg", "//h/x.jpg", "/x.jpg", "x.jpg", "http://a/b.jpg/c", "http://a/http://b.jpg", "http://a/x.tar.GZ#f.txt", "http://a/.js", "", "http://a?x.jpg"]
    for shape, got in zip(shapes, column(spark, shapes, U.has_extension)):
        path = urlparse(shape).path
        assert got == ("." in path and path.rsplit(".", 1)[-1].lower() in U.EXCLUDED_EXTENSIONS), shape
    assert column(spark, ["http://x/Cart/1", "http://x/a", "http://x/WishList"], U.matches_wildcard) == [True, False, True]
    import fnmatch

    rng = random.Random(4)
    urls = ["".join(rng.choices("ab.?[]*+", k=rng.randint(0, 5))) for _ in range(150)]
    for pattern in ["a*", "?b", "[ab]*", "[!a]*b", "*.", "*+*", "*a*", "[", "a[", "*[.]*"]:
        assert column(spark, urls, lambda c: U.matches_wildcard(c, [pattern])) == [fnmatch.fnmatch(u, pattern) for u in urls], pattern
    assert column(spark, ["tel:1", "mailto:a", "", "/x", "HTTP://x", "https://x", None], U.scheme_allowed) == [
        False, False, False, True, True, True, False]


def test_slug_language(spark):
    assert column(spark, ["Müller & Söhne!"], U.shop_slug) == ["müller-söhne"]
    assert column(spark, ["de-AT", "EN", "it", None], U.language_of) == ["de", "en", None, None]
