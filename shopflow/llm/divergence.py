"""Divergence of sources: how far the word use of each (language, source) group lies from other sources and its language.

Texts are cut by one translate table: ``bytes.translate`` lowers A-Z and blanks every other byte that is not a letter,
``bytes.split`` gives the terms, a ``Counter`` per document their frequencies. A task adds them up per group and hands out
sparse rows (language, source, term, occurrences, documents), which Spark sums. A term stays if its language has it in
enough documents. Relative frequencies are whole numbers, one plus the floor of a smoothed share of a thousand million, so
all results are exact.

Sources of a language are compared over its terms in buckets of bounded size, a table of term by source at a time; only one
sum for each two sources leaves a bucket.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopflow.llm.base import scoped, stored

LEAST_DOCS = 3
TERMS = 200  # reported for a group
UNIT = 1_000_000_000
HELD = 100_000  # entries a task holds before it hands them out
ROWS = 10_000  # of a batch
BUCKET = 16_384  # terms compared in a group
CELLS = 1 << 18  # of a table of terms by sources

#: Letters of ASCII in lower case and all bytes of other characters; blanks for the rest.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def counted(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, count, docs) of (lang, source, text as bytes); a row without a term counts a group's documents."""
    names = ["lang", "source", "term", "count", "docs"]

    def rows(groups: dict) -> pa.RecordBatch:
        sizes = [len(docs) for _, docs in groups.values()]
        where = pa.array(np.repeat(np.arange(len(groups)), sizes))
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in groups], pa.string()).take(where), pa.array([k[1] for k in groups], pa.string()).take(where),
             pa.array([t for _, docs in groups.values() for t in docs], pa.binary()),
             pa.array([total[t] for total, docs in groups.values() for t in docs], pa.int64()), pa.array([n for _, docs in groups.values() for n in docs.values()], pa.int64())],
            names=names)

    def parts(groups: dict) -> Iterator[pa.RecordBatch]:
        whole = rows(groups)
        for at in range(0, whole.num_rows, ROWS):
            yield whole.slice(at, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                total, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                size -= len(docs)
                frequencies = Counter(terms(text))
                total.update(frequencies)
                docs.update(frequencies.keys())
                total[None], docs[None] = 0, docs[None] + 1
                size += len(docs)
                if size >= held:
                    yield from parts(groups)
                    groups, size = {}, 0
        if groups:
            yield from parts(groups)

    return docs.mapInArrow(run, "lang string, source string, term binary, count long, docs long")


def share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + kinds)), exact for any counts."""
    return F.lit(1).cast("long") + F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (total + kinds).cast("decimal(20,0)"))


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The same over whole arrays: long division by three digits at a time, exact for totals below 9 * 10^15."""
    quotient, rest = np.divmod(counts + 1, totals)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, totals)
        quotient = quotient * 1000 + more
    return quotient + 1


def pairs(uses: DataFrame, groups: DataFrame, bucket: int) -> DataFrame:
    """(lang, source, item, value): for each two sources of a language the sum over its terms of how far the first one's share lies from the other's.

    ``uses`` holds (lang, source, term, count, kinds); ``groups`` (lang, source, total, kinds).
    """
    def compare(key: tuple, known: pa.Table, rows: pa.Table) -> pa.Table:
        sources = known.column("source").combine_chunks()
        totals = known.column("total").to_numpy() + known.column("kinds").to_numpy()
        n = len(totals)
        sums = np.zeros((n, n), np.int64)
        if rows.num_rows:
            line = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
            order = np.argsort(line, kind="stable")
            line, number = line[order], pc.index_in(rows.column("source"), value_set=sources).to_numpy()[order]
            counts = rows.column("count").to_numpy()[order]
            step = max(1, CELLS // max(n, 1))
            for at in range(0, int(line[-1]) + 1, step):
                inside = slice(*np.searchsorted(line, [at, at + step]))
                table = np.zeros((min(step, int(line[-1]) + 1 - at), n), np.int64)
                table[line[inside] - at, number[inside]] = counts[inside]
                p = shares(table, totals)
                for b in range(n):
                    q = p[:, b:b + 1]
                    sums[:, b] += ((p - q) ** 2 // q).sum(0)
        a, b = np.divmod(np.flatnonzero(~np.eye(n, dtype=bool)), max(n, 1))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "source": sources.take(pa.array(a)), "item": sources.take(pa.array(b)), "value": pa.array(sums[a, b])})

    buckets = F.greatest(F.ceil(F.col("kinds") / bucket), F.lit(1)).cast("int")
    dealt = uses.select("lang", F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), "source", "term", "count")
    known = groups.select("lang", F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket"), "source", "total", "kinds")
    parts = known.groupBy("lang", "bucket").cogroup(dealt.groupBy("lang", "bucket")).applyInArrow(compare, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


@scoped
def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCS, most: int = TERMS,
          bucket: int = BUCKET) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair`` ranks, for each group, the other sources of its language by divergence; part ``term`` its at most ``most``
    terms that the group uses more than the language, by how much more. Null texts, languages and sources count as ''. A
    group without terms is compared by the smoothing alone; where no term of a language is in ``least`` documents, all its
    pairs have value 0. Repeated rows are documents each; ties go by item in UTF-8 order; an empty table gives no row.
    """
    def filled(c: str) -> Column:
        return F.coalesce(docs[c].cast("string"), F.lit(""))

    texts = docs.select(filled(lang).alias("lang"), filled(source).alias("source"), filled(text).cast("binary").alias("text"))
    rows = stored(counted(texts).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), "divergence-counts")
    kept = rows.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("in_lang"))
    kept = stored(kept.where(F.col("docs") >= least).select("lang", "term", "in_lang"), "divergence-terms")
    uses = stored(rows.select("lang", "source", "term", "count").join(kept, ["lang", "term"]), "divergence-uses")
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("in_lang").alias("lang_total"))
    totals = uses.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = rows.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(by_lang, "lang", "left")
    groups = stored(groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kinds", "lang_total")]), "divergence-groups")

    p, q = F.col("p"), F.col("q")
    known = uses.join(groups, ["lang", "source"])
    over = known.select("lang", "source", F.col("term").cast("string").alias("item"), share(F.col("count"), F.col("total"), F.col("kinds")).alias("p"),
                        share(F.col("in_lang"), F.col("lang_total"), F.col("kinds")).alias("q")).where(p > q)
    over = over.select("lang", "source", "item", F.call_function("div", (p - q) * (p - q), q).alias("value"))
    sums = pairs(known.select("lang", "source", "term", "count", "kinds"), groups, bucket)
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(best)
    term = over.withColumn("rank", rank).where(F.col("rank") <= most)
    both = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, rows in (("pair", sums.withColumn("rank", rank)), ("term", term))]
    return stored(both[0].union(both[1]), "divergence-audit", keep=True)
