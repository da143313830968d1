"""Line splitting, boilerplate predicates, noise and block removal, hashes, JSON salvage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from shopflow.functions.columns import let, ratio

# Line ends and blanks of Unicode text.
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\x{2028}\x{2029}]"
RARE_BREAKS = [chr(i) for i in (11, 12, 13, 28, 29, 30, 0x85, 0x2028, 0x2029)]
BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
                           0x2029, 0x202F, 0x205F, 0x3000]))
BLANK_RUN = r"(?U)[\s\x1C-\x1F]+"

# Words that mark shop data, and section titles that mark noise.
CRITICAL_WORDS = ["price", "inventory", "sku", "item", "lot", "verfügbarkeit", "vorrätig", "availability", "stock",
                  "zustand"]
NOISE_TITLES = [
    "related products", "ähnliche produkte", "lieferung", "unsere bundesweiten lieferkosten", "other items", "search",
    "similar products", "recommended products", "empfohlene produkte", "angebote",
    "weitere ausgewählte angebote des anbieters", "similar items", "agb", "lieferkosten",
    "das könnte dir auch gefallen", "unsere arbeit", "versand", "liebe kunden", "facebook", "instagram", "twitter",
    "youtube", "pinterest", "kontakt", "newsletter", "impressum", "datenschutz", "terms of service",
    "privacy policy", "terms and conditions", "follow us", "social", "social media", "links",
]
UNSAFE = r"(?iuU)^#|\b(?:" + "|".join(CRITICAL_WORDS) + r")\b|[$€£]\s*\d|\d\s*[$€£]"

# Text gates.
MIN_CHARS = 500
WARN_CHARS = 20000
PREVIEW_CHARS = 100


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def lines(c: Column) -> Column:
    """All lines without their ends; no empty line after a final line end."""
    rare = reduce(Column.__or__, [c.contains(ch) for ch in RARE_BREAKS])
    split = F.when(rare, F.split(c, LINE_BREAK, -1)).otherwise(F.split(c, "\n", -1))
    return let(split,
               lambda ls: F.when(F.element_at(ls, -1) == "", F.slice(ls, F.lit(1), F.size(ls) - 1)).otherwise(ls))


def stripped_lines(c: Column) -> Column:
    return F.transform(lines(c), strip)


def is_safe_line(c: Column) -> Column:
    """False for lines with shop data words, amounts or a header mark."""
    return ~c.rlike(UNSAFE)


def word_count(block: Column) -> Column:
    joined = strip(F.array_join(block, " "))
    return F.when(F.size(block) == 0, 0).when(joined == "", 0).otherwise(F.size(F.split(joined, BLANK_RUN, -1)))


def is_valid_block(block: Column) -> Column:
    return word_count(block) > 3


def remove_noise(c: Column) -> Column:
    """Drop sections whose header names a noise topic.

    A noise header opens a skip at its level, a later noise header resets that level, any other header at the same
    or a higher level ends the skip. The fold runs over the headers only; lines are then copied in slices.
    """
    title = "(?U)^#{1,6}[\\s\\x1C-\\x1F]*(.*)$"

    def header(line: Column, i: Column) -> Column:
        bare = strip(line)
        return F.when(bare.startswith("#"), F.struct(
            i.alias("i"),
            F.length(F.regexp_extract(bare, "^(#{1,6})", 1)).alias("level"),
            strip(F.lower(F.regexp_extract(bare, title, 1))).rlike("|".join(NOISE_TITLES)).alias("noise")))

    def copied(ls: Column) -> Column:
        headers = F.filter(F.transform(ls, header), lambda h: h.isNotNull())
        zero = F.struct(F.array().cast("array<struct<a:int,n:int>>").alias("keep"), F.lit(0).alias("since"),
                        F.lit(0).alias("level"))

        def emit(acc: Column, upto: Column) -> Column:
            return F.concat(acc["keep"], F.array(F.struct(
                acc["since"].alias("a"), (upto - acc["since"]).alias("n"))))

        def step(acc: Column, h: Column) -> Column:
            keeping = acc["since"] >= 0
            opened = F.struct(F.when(keeping, emit(acc, h["i"])).otherwise(acc["keep"]).alias("keep"),
                              F.lit(-1).alias("since"), h["level"].alias("level"))
            closed = F.struct(acc["keep"].alias("keep"), h["i"].alias("since"), acc["level"].alias("level"))
            return F.when(h["noise"], opened).when(~keeping & (h["level"] <= acc["level"]), closed).otherwise(acc)

        kept = F.aggregate(headers, zero, step, lambda acc: F.when(
            acc["since"] >= 0, emit(acc, F.size(ls))).otherwise(acc["keep"]))
        return F.array_join(F.flatten(F.transform(kept, lambda r: F.slice(ls, r["a"] + 1, r["n"]))), "\n")

    return let(lines(c), copied)


def _matches(stripped: Column, block: Column) -> Column:
    """Start positions (from 0) of ``block`` in ``stripped``."""
    starts = F.filter(F.transform(stripped, lambda l, i: F.when(l == block[0], i)), lambda i: i.isNotNull())
    return F.filter(starts, lambda i: F.slice(stripped, i + 1, F.size(block)) == block)


def remove_blocks(c: Column, blocks: Column, overlap: str = "union") -> Column:
    """Delete every run of stripped lines that equals a block; other lines stay unchanged.

    ``overlap`` decides what happens when matches overlap: ``union`` deletes the lines covered by any match,
    ``sequential`` deletes match after match from the end, each by position and length, so that a later deletion
    can reach lines behind the match. Without overlaps both give the same text. Null or empty blocks change nothing.
    """
    if overlap not in ("union", "sequential"):
        raise ValueError(f"overlap must be 'union' or 'sequential', got: {overlap}")

    def cleaned(ls: Column) -> Column:
        def with_stripped(stripped: Column) -> Column:
            spans = F.flatten(F.transform(
                F.filter(blocks, lambda b: F.size(b) > 0),
                lambda b: F.transform(_matches(stripped, b), lambda i: F.struct(i.alias("a"), F.size(b).alias("n")))))
            if overlap == "union":
                kept = let(spans, lambda sp: F.when(F.size(sp) == 0, ls).otherwise(F.filter(
                    ls, lambda l, i: ~F.exists(sp, lambda s: (i >= s["a"]) & (i < s["a"] + s["n"])))))
            else:
                kept = F.aggregate(
                    F.sort_array(spans, asc=False), ls,
                    lambda acc, s: F.concat(F.slice(acc, F.lit(1), s["a"]),
                                            F.slice(acc, s["a"] + s["n"] + 1, F.size(acc))))
            return F.array_join(kept, "\n")

        return let(F.transform(ls, strip), with_stripped)

    return F.when(F.coalesce(F.size(blocks), F.lit(0)) <= 0, c).when(c == "", c).otherwise(let(lines(c), cleaned))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def long_enough(c: Column) -> Column:
    return F.length(c) >= MIN_CHARS


def dedupe_key(c: Column) -> Column:
    """Key under which two sample documents count as repeats: the hash of the whole text."""
    return F.sha2(c, 256)


def extractor_input(c: Column, limit: int | None = None) -> Column:
    """What an extractor that takes at most ``limit`` characters gets; the whole text without a limit."""
    return c if limit is None else F.substring(c, 1, limit)


def too_long(c: Column) -> Column:
    return F.length(c) > WARN_CHARS


def block_preview(block: Column) -> Column:
    return F.concat(F.substring(F.array_join(block, "\n"), 1, PREVIEW_CHARS), F.lit("..."))


def deletion_rate(raw: Column, clean: Column) -> Column:
    """Length of the cleaned text over the length of the raw text."""
    return ratio(F.length(clean), F.length(raw))


def words(c: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def word_text(c: Column) -> Column:
    """The words of :func:`words` in one string, one blank between them."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def words_in(norm: Column) -> Column:
    """Number of words of a :func:`word_text`."""
    return F.when(norm == "", 0).otherwise(F.octet_length(norm) - F.octet_length(F.replace(norm, F.lit(" "), F.lit(""))) + 1)


def spaced_words(norm: Column) -> Column:
    """A :func:`word_text` with blanks of its own around every word."""
    return F.concat(F.lit(" "), F.replace(norm, F.lit(" "), F.lit("  ")), F.lit(" "))


def times_spaced(spaced: Column, word: str) -> Column:
    """How often a word occurs in :func:`spaced_words`; byte searches only."""
    gone = F.replace(spaced, F.lit(f" {word} "), F.lit(""))
    return ((F.octet_length(spaced) - F.octet_length(gone)) / (len(word.encode()) + 2)).cast("int")


def _first_object(c: Column) -> Column:
    """First substring with balanced braces, or null. The fold visits closing braces, not characters."""
    def scan(tail: Column) -> Column:
        def pieces(ps: Column) -> Column:
            zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("len"), F.lit(False).alias("done"))

            def step(acc: Column, p: Column) -> Column:
                depth = acc["depth"] + F.length(p) - F.length(F.replace(p, F.lit("{"), F.lit(""))) - 1
                return F.when(acc["done"], acc).otherwise(F.struct(
                    depth.alias("depth"), (acc["len"] + F.length(p) + 1).alias("len"), (depth == 0).alias("done")))

            end = F.aggregate(F.slice(ps, F.lit(1), F.size(ps) - 1), zero, step)
            return let(end, lambda e: F.when(e["done"], F.substring(tail, F.lit(1), e["len"])))

        return let(F.split(tail, "}", -1), pieces)

    at = F.instr(c, "{")
    return F.when(at > 0, let(F.substring(c, at, F.length(c)), scan))


def is_json(c: Column) -> Column:
    """True for exactly one JSON value. The parser ignores text behind the value, hence the two brackets around."""
    return (F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))).isNotNull()
            & F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}"))).isNotNull())


def salvage_json(c: Column) -> Column:
    """Valid JSON as it is, else the first balanced object, else that object on one line, else ``{}``."""
    empty = F.lit("{}")

    def candidate(obj: Column) -> Column:
        flat = strip(F.replace(obj, F.lit("\n"), F.lit(" ")))
        return F.when(is_json(obj), obj).when(is_json(flat), flat).otherwise(empty)

    return (F.when(c.isNull() | (c == ""), empty).when(is_json(c), c)
            .otherwise(F.coalesce(let(_first_object(c), candidate), empty)))
