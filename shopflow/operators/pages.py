"""Page content: link extraction, HTML to text lines, change detection against stored hashes."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from shopflow.functions import text, urls
from shopflow.functions.columns import let, once

# Tags whose content is no page text.
EXCLUDED_TAGS = [
    "nav", "footer", "header", "navbar", "navigation", "site-header", "site-footer", "aside", "form", "button", "input",
    "noscript", "script", "style", "canvas", "video", "audio", "advertisement", "ads", "cookie-banner", "popup",
    "subscribe-modal", "rcb-banner", "rcb-overlay",
]
_VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
_INLINE = ["a", "abbr", "b", "bdi", "bdo", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
           "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr"]
_TOKEN = (r"(?si)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
          r"|</?[a-z][\w:-]*(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<[!?][^>]*>")
_ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_LINE, _MARK = "\x01", "\x02"  # a new line; the end of its mark

_HREF = r"""(?is)<a\s[^>]*?\bhref\s*=\s*["']([^"']*)["']"""


def unescape(c: Column) -> Column:
    """Character references as characters: numeric ones, names, and the old names that need no semicolon, also as prefixes."""
    names = F.map_from_arrays(*[F.split(F.lit("\x01".join(part)), "\x01") for part in zip(*html5.items())])  # folded into one constant
    old = "^(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)) + ")"

    def numbered(part: Column) -> Column:
        digits = F.regexp_extract(part, "^&#[xX]?([0-9a-fA-F]+)", 1)
        number = F.when(part.rlike("^&#[xX]"), F.conv(digits, 16, 10).try_cast("long")).otherwise(digits.try_cast("long"))
        valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise("\ufffd")

    def named(part: Column) -> Column:
        name = F.substring(part, F.lit(2), F.length(part))
        start = F.regexp_extract(name, old, 0)
        return F.coalesce(F.try_element_at(names, name), F.concat(F.try_element_at(names, start), F.substring(name, F.length(start) + 1, F.length(name))), part)

    def one(part: Column) -> Column:
        return F.when(~part.startswith("&") | (part == "&"), part).when(part.rlike("^&#[xX]?[0-9a-fA-F]"), numbered(part)).otherwise(named(part))

    pieces = F.regexp_extract_all(c, F.lit(f"(?s){_ENTITY}|[^&]+|&"), F.lit(0))
    return F.when(c.contains("&"), F.array_join(F.transform(pieces, one), "")).otherwise(c)


def _attribute(tag: Column, name: str) -> Column:
    """The last value of an attribute; empty without one."""
    found = F.regexp_extract_all(tag, F.lit(rf"""(?is)(?<![\w-]){name}\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)"""), F.lit(0))
    last = F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))
    return F.regexp_replace(F.regexp_replace(last, r"(?is)^[\w-]+\s*=\s*", ""), r"""(?s)^(["'])(.*)\1$""", "$2")


def _hidden(tags: Column, excluded: list[str]) -> Column:
    """Spans (from, to) of token numbers between an excluded tag and its end; the fold runs over tags of excluded names only."""
    kind = "array<struct<from:int,to:int>>"
    marked = F.filter(F.transform(tags, lambda t, i: F.struct(i.alias("i"), t["name"].alias("name"), t["closing"].alias("closing"), t["alone"].alias("alone"))),
                      lambda t: t["name"].isin(excluded))
    zero = F.struct(F.array().cast(kind).alias("spans"), F.lit("").alias("name"), F.lit(0).alias("depth"), F.lit(-1).alias("since"))

    def state(spans, name, depth, since):
        return F.struct(spans.alias("spans"), name.alias("name"), depth.alias("depth"), since.alias("since"))

    def step(acc: Column, t: Column) -> Column:
        opened = state(acc["spans"], t["name"], F.lit(1), t["i"])
        depth = acc["depth"] + F.when(t["closing"], -1).otherwise(1)
        ended = state(F.concat(acc["spans"], F.array(F.struct(acc["since"].alias("from"), t["i"].alias("to")))), F.lit(""), F.lit(0), F.lit(-1))
        return (F.when(acc["depth"] == 0, F.when(t["closing"] | t["alone"], acc).otherwise(opened))
                .when(t["name"] != acc["name"], acc).when(depth == 0, ended).otherwise(state(acc["spans"], acc["name"], depth, acc["since"])))

    def finish(acc: Column) -> Column:
        rest = F.array(F.struct(acc["since"].alias("from"), (F.size(tags) + 1).alias("to")))
        return F.when(acc["depth"] > 0, F.concat(acc["spans"], rest)).otherwise(acc["spans"])

    return F.aggregate(marked, zero, step, finish)


def page_lines(html: Column, excluded_tags: list[str] = EXCLUDED_TAGS) -> Column:
    """Text of one page: one line per block, headers as ``#`` lines, images as ``![alt](src)``.

    A page is cut into tags and the texts between them. Tags that end a line give a mark, inline ones nothing; what lies in an
    excluded tag gives nothing. The joined pieces are cut at the marks.
    """
    excluded = sorted({t.lower() for t in excluded_tags} | {"head"})

    def described(tag: Column) -> Column:
        whole = tag.rlike(r"(?i)^<(script|style)\b")
        name = F.when(whole, "").otherwise(F.lower(F.regexp_extract(tag, r"(?i)^</?([a-z][\w:-]*)", 1)))
        alone = tag.endswith("/>") | name.isin(_VOID)
        return F.struct(name.alias("name"), tag.startswith("</").alias("closing"), alone.alias("alone"), tag.alias("tag"))

    def piece(t: Column) -> Column:
        name, closing = t["name"], t["closing"]
        source = _attribute(t["tag"], "src")
        image = F.when(source != "", F.concat(F.lit("!["), _attribute(t["tag"], "alt"), F.lit("]("), unescape(source), F.lit(")"))).otherwise("")
        mark = F.when(~closing & name.rlike("^h[1-6]$"), F.concat(F.repeat(F.lit("#"), F.substring(name, 2, 1).cast("int")), F.lit(" "))).when(
            ~closing & (name == "li"), "* ").otherwise("")
        line = F.concat(F.lit(_LINE), mark, F.lit(_MARK))
        return (F.when(name == "", "").when(name.isin(excluded), F.when(closing | t["alone"], "").otherwise(_LINE + _MARK))
                .when(name == "img", image).when(name.isin(_INLINE), "").otherwise(line))

    def line(part: Column) -> Column:
        """Mark and text of a line; a line without text goes."""
        at = F.instr(part, _MARK)
        body = text.strip(F.regexp_replace(F.substring(part, at + 1, F.length(part)), text.BLANK_RUN, " "))
        return F.when(body != "", F.concat(F.substring(part, F.lit(1), F.greatest(at - 1, F.lit(0))), body))

    def joined(page: Column) -> Column:
        tags, texts = page["tags"], page["texts"]

        def with_spans(spans: Column) -> Column:
            def within(i: Column, low: int, high: int) -> Column:
                return F.exists(spans, lambda s: (i >= s["from"] + low) & (i < s["to"] + high))

            # neither the tag nor the text behind it may lie in an excluded tag; the tag that opens one still ends a line
            pieces = F.transform(tags, lambda t, i: F.concat(F.when(within(i, 1, 1), "").otherwise(piece(t)), F.when(within(i, 0, 0), "").otherwise(F.get(texts, i + 1))))
            return F.array_join(F.concat(F.array(F.get(texts, F.lit(0))), pieces), "")

        return let(_hidden(tags, excluded), with_spans)

    plain = F.translate(html, _LINE + _MARK, "")
    cut = F.struct(F.transform(F.regexp_extract_all(plain, F.lit(_TOKEN), F.lit(0)), described).alias("tags"),
                   F.transform(F.split(plain, _TOKEN, -1), unescape).alias("texts"))
    return let(let(cut, joined), lambda whole: F.array_join(F.array_compact(F.transform(F.split(whole, _LINE, -1), line)), "\n"))


def html_to_markdown(pages: DataFrame, excluded_tags: list[str] = EXCLUDED_TAGS) -> DataFrame:
    """Adds ``markdown`` from ``html``, whole pages; null stays null."""
    return once(pages, markdown=page_lines(F.col("html"), excluded_tags))


def extract_links(pages: DataFrame) -> DataFrame:
    """Link edges of pages: normalised target, internal or external by host, order on the page."""
    hrefs = F.regexp_extract_all("html", F.lit(_HREF), 1)
    raw = pages.select(F.col("url").alias("_page"), F.posexplode(hrefs).alias("ord", "href"))
    href = F.replace(F.trim("href"), F.lit("&amp;"), F.lit("&"))
    linked = raw.where(urls.scheme_allowed(href)).select(
        "_page", "ord", urls.normalize_url(F.col("_page")).alias("src_url"),
        urls.normalize_url(href, F.col("_page")).alias("dst_url"))
    same = (F.regexp_replace(urls.host(F.col("src_url")), r"^www\.", "")
            == F.regexp_replace(urls.host(F.col("dst_url")), r"^www\.", ""))
    return linked.select("src_url", "dst_url", F.when(same, "internal").otherwise("external").alias("kind"), "ord")


def http_only(df: DataFrame, href: str = "href") -> DataFrame:
    return df.where(urls.scheme_allowed(F.col(href)))


def with_change(pages: DataFrame, stored: DataFrame, content: str = "markdown") -> DataFrame:
    """Adds ``hash`` and ``changed``: no stored hash, or another one. The stored side is (domain, url, hash)."""
    hashed = pages.withColumn("hash", text.content_hash(F.col(content)))
    old = stored.select("domain", "url", F.col("hash").alias("_old"))
    return (hashed.join(old, ["domain", "url"], "left")
            .withColumn("changed", ~F.coalesce((F.col("hash") == F.col("_old")), F.lit(False))).drop("_old"))


def detect_changes(pages: DataFrame, stored: DataFrame, content: str = "markdown") -> tuple[DataFrame, DataFrame]:
    """(changed pages, unchanged pages)."""
    both = with_change(pages, stored, content)
    return both.where("changed"), both.where(~F.col("changed"))
