"""Domain and URL expressions: cleanup, normalisation, core names, exclusion rules."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

from shopflow.functions.columns import let

# File types and URL patterns that a crawl leaves out.
EXCLUDED_EXTENSIONS = [
    "jpg", "jpeg", "png", "gif", "webp", "svg", "mp4", "avi", "mov", "wmv", "flv", "pdf", "doc", "docx", "xls", "xlsx",
    "zip", "rar", "tar", "gz", "css", "js", "ico", "woff", "woff2", "ttf",
]
EXCLUDED_PATTERNS = ["*wishlist*", "*cart*", "*login*", "*signup*"]

# Labels that form a public suffix together with a two-letter country label, as in ``co.uk``.
SECOND_LEVEL = ["ac", "co", "com", "edu", "go", "gob", "gov", "gv", "ltd", "me", "ne", "net", "nom", "or", "org",
                "plc", "sch"]

# Parts of a URI: scheme, authority, path, query.
_URI = r"^(?:([^:/?#]+):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?"


def clean_domain(c: Column) -> Column:
    """Domain of a work message: no scheme, no slashes at the ends."""
    bare = F.replace(F.replace(c, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return F.trim(bare, F.lit("/"))


def start_url(domain: Column) -> Column:
    return F.concat(F.lit("https://"), domain)


def host(url: Column) -> Column:
    """Lower-case host without user and port; empty for text without one."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def normalize_domain(c: Column) -> Column:
    """Lower case; no scheme, user, port, ``www.``, path, query or fragment."""
    bare = F.regexp_replace(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.-]*://", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"[/?#].*$", ""), r"^[^@]*@|:[0-9]*$", ""),
                            r"^www\.", "")


def core_domain(c: Column) -> Column:
    """Registrable label of a domain: ``shop.example.co.uk`` gives ``example``.

    Suffixes follow a rule: the last label, and the one before it when that is a generic label below a country.
    For a full suffix table see :func:`shopflow.operators.register.core_domain_by_table`.
    """
    def pick(labels: Column) -> Column:
        n = F.size(labels)
        last = F.element_at(labels, -1)
        two = (n >= 3) & (F.length(last) == 2) & F.element_at(labels, F.greatest(-n, F.lit(-2))).isin(SECOND_LEVEL)
        return (F.when(F.array_join(labels, ".").rlike(r"^[0-9]+(\.[0-9]+){3}$"), F.array_join(labels, "."))
                .when(n == 1, labels[0])
                .when(two, F.element_at(labels, F.greatest(-n, F.lit(-3))))
                .otherwise(F.element_at(labels, F.greatest(-n, F.lit(-2)))))

    return let(F.split(normalize_domain(c), r"\."), pick)


def _without_dots(path: Column) -> Column:
    """Path with ``.`` and ``..`` segments resolved."""
    def fold(segments: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            return (F.when(s == ".", acc)
                    .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
                    .otherwise(F.array_append(acc, s)))

        return F.array_join(F.aggregate(segments, F.array().cast("array<string>"), step), "/")

    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), fold(F.split(path, "/", -1))).otherwise(path)


def normalize_url(href: Column, base: Column | None = None) -> Column:
    """One form per page: resolved against ``base``, lower-case scheme and host, no fragment, no ``utm_*``
    parameters, no slash at the end."""
    link = F.trim(href)
    if base is None:
        base = link

    def part(c: Column, i: int) -> Column:
        return F.regexp_extract(c, _URI, i)

    scheme, authority, path = part(link, 1), part(link, 2), part(link, 3)
    own = scheme != ""
    has_authority = own | (authority != "")
    base_folder = F.regexp_extract(part(base, 3), r"^(.*/)", 1)
    full_path = (F.when(has_authority, path)
                 .when(path == "", part(base, 3))
                 .when(path.startswith("/"), path)
                 .otherwise(F.concat(F.when(base_folder == "", "/").otherwise(base_folder), path)))
    query = F.when(has_authority | (path != "") | (part(link, 4) != ""), part(link, 4)).otherwise(part(base, 4))
    kept = F.regexp_replace(F.regexp_replace(query, r"(?i)([?&])utm_[^&]*", "$1"), r"&{2,}", "&")
    kept = F.regexp_replace(F.regexp_replace(kept, r"^\?&", "?"), r"[?&]$", "")
    return F.concat(
        F.lower(F.when(own, scheme).otherwise(part(base, 1))), F.lit(":"),
        F.lower(F.when(has_authority, authority).otherwise(part(base, 2))),
        F.regexp_replace(_without_dots(full_path), r"/+$", ""), kept)


def scheme_allowed(href: Column) -> Column:
    """True for links without a scheme or with http or https; false for empty ones."""
    scheme = F.lower(F.regexp_extract(href, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return href.isNotNull() & (href != "") & scheme.isin("", "http", "https")


def has_extension(url: Column, extensions: list[str] = EXCLUDED_EXTENSIONS) -> Column:
    """True when the text after the last dot of the path is one of ``extensions``."""
    wanted = [re.escape(e.lower().lstrip(".")) for e in extensions]
    if not wanted:
        return F.lit(False)
    scheme = "[a-z][a-z0-9+.-]*:"
    before = rf"(?:(?:{scheme})?//[^/?#]*/|(?!{scheme}|//))[^?#]*"
    return F.coalesce(url.rlike(rf"(?i)^{before}\.(?:{'|'.join(wanted)})(?:;[^/?#]*)?(?:[?#].*)?$"), F.lit(False))


def wildcard_pattern(pattern: str) -> str:
    """Regular expression of a shell wildcard with ``*``, ``?``, ``[abc]`` and ``[!abc]``, in lower case."""
    def one(token: str) -> str:
        if token == "*":
            return ".*"
        if token == "?":
            return "."
        if len(token) > 2 and token[0] == "[":
            inner = token[1:-1].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            return "[" + ("^" + inner[1:] if inner[0] == "!" else inner.replace("^", "\\^")) + "]"
        return re.sub(r"([^\w/ -])", r"\\\1", token, flags=re.ASCII)

    tokens = re.findall(r"\[!?\]?[^\]]*\]|[*?]|[^*?\[]+|\[", pattern.lower())
    return "".join(one(t) for t in tokens)


def matches_wildcard(url: Column, patterns: list[str] = EXCLUDED_PATTERNS) -> Column:
    """True when the whole URL, in lower case, matches a wildcard pattern.

    Patterns of the kind ``*text*`` become plain searches; the others share one regular expression.
    """
    if not patterns:
        return F.lit(False)
    low = F.lower(url)
    plain = [m.group(1) for p in patterns if (m := re.fullmatch(r"\*([^*?\[]+)\*", p.lower()))]
    rest = [p for p in patterns if not re.fullmatch(r"\*([^*?\[]+)\*", p.lower())]
    tests = [low.contains(t) for t in plain]
    if rest:
        tests.append(low.rlike("(?s)^(?:" + "|".join(map(wildcard_pattern, rest)) + ")$"))
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False))


def crawlable(url: Column, extensions: list[str] = EXCLUDED_EXTENSIONS,
              patterns: list[str] = EXCLUDED_PATTERNS) -> Column:
    return ~has_extension(url, extensions) & ~matches_wildcard(url, patterns)


def shop_slug(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", "-"), F.lit("-"))


def product_slug(title: Column, product_id: Column) -> Column:
    return F.concat(shop_slug(title), F.lit("-"), F.substring(F.sha2(product_id, 256), 1, 6))


def language_of(tag: Column) -> Column:
    from shopflow.schemas import LANGUAGES

    code = F.lower(F.regexp_extract(tag, "^([A-Za-z]+)", 1))
    return F.when(code.isin(LANGUAGES), code)
