"""Quality rules with thresholds that adapt to the language and source of a document.

The values of each rule are gathered in quantile sketches per language and source: counts by logarithmic bin, so sketches
merge by adding counts, the result does not depend on the order of merging, and a quantile is right to one per cent of its
value. A group with too few documents takes the merged sketch of its language, and a language with too few that of
everything. Thresholds follow from the quartiles and are joined back to the documents.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopflow.llm.base import by_batch, scoped, stored

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]
GROWTH = 1.02
#: Rule: least distance of a threshold from the quartile, so that groups without spread keep their documents.
RULES = {"symbols": 0.25, "dup_lines": 0.5, "repeats": 0.4, "capitals": 0.25, "long_words": 3.0}


def count_words(text: str) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one text."""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        end = 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
            len(lines), sum(map(bytes.isupper, words)))


def measure(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns but those named like a count) and the counts of the whole text (null: none)."""
    keep = [c for c in docs.columns if c not in COUNTS] if keep is None else keep
    marked = docs.select(*[docs[c].alias(c) for c in keep], docs[text].cast("string").alias("_text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [count_words(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
        counts = zip(*rows) if rows else [()] * len(COUNTS)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(c, pa.int64()) for c in counts]], names=[*keep, *COUNTS])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields[:-1]] + [f"{c} long" for c in COUNTS])
    return by_batch(marked, run, schema)


def rule_values() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbols": F.col("n_symbols") / words, "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "repeats": F.col("n_repeat_words") / words, "capitals": F.col("n_capitals") / words, "long_words": F.col("word_chars") / words}


def sketch(measured: DataFrame, group: list[str]) -> DataFrame:
    """Rows (group, rule, bin, n): the sketch of each rule's values; bin null holds the zeros."""
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("value")) for k, v in rule_values().items()]))
    bin_ = F.when(F.col("v.value") > 0, F.ceil(F.log("v.value") / math.log(GROWTH))).cast("int")
    return measured.select(*group, values.alias("v")).groupBy(*group, F.col("v.rule").alias("rule"), bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, group: list[str]) -> DataFrame:
    """Sketches of a coarser grouping."""
    return sketches.groupBy(*group, "rule", "bin").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, group: list[str], wanted: dict[str, float]) -> DataFrame:
    """Rows (group, rule, n, wanted...): the least value below or at which the share lies."""
    order = Window.partitionBy(*group, "rule").orderBy(F.col("bin").asc_nulls_first())
    value = F.coalesce(2 * F.pow(F.lit(GROWTH), F.col("bin")) / (GROWTH + 1), F.lit(0.0))
    at = sketches.select("*", F.sum("n").over(order).alias("_upto"), F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"), value.alias("_value"))
    return at.groupBy(*group, "rule").agg(F.first("_all").alias("n"), *[F.min(F.when(F.col("_upto") >= q * F.col("_all"), F.col("_value"))).alias(name) for name, q in wanted.items()])


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source", least: int = 200, reach: float = 6.0) -> DataFrame:
    """One row per (_lang, _source) with the upper threshold of each rule.

    Threshold: third quartile + the larger of ``reach`` times its distance from the median and the rule's least distance.
    """
    fine = stored(sketch(measured.select(group_key(lang).alias("_lang"), group_key(source).alias("_source"), *COUNTS), ["_lang", "_source"]), "quality-sketch")
    wanted = {"median": 0.5, "upper": 0.75}

    def limits(df: DataFrame, group: list[str], name: str) -> DataFrame:
        gap = F.coalesce(*[F.when(F.col("rule") == k, v) for k, v in RULES.items()])
        limit = F.when(F.col("n") >= least, F.col("upper") + F.greatest(reach * (F.col("upper") - F.col("median")), gap))
        return quantiles(df, group, wanted).select(*group, "rule", limit.alias(name))

    by_lang = merge(fine, ["_lang"])
    every = merge(by_lang, []).transform(lambda d: quantiles(d, [], wanted)).select(
        "rule", (F.col("upper") + F.greatest(reach * (F.col("upper") - F.col("median")), F.coalesce(*[F.when(F.col("rule") == k, v) for k, v in RULES.items()]))).alias("l0"))
    joined = (limits(fine, ["_lang", "_source"], "l2").join(limits(by_lang, ["_lang"], "l1"), ["_lang", "rule"]).join(every, "rule"))
    return joined.groupBy("_lang", "_source").agg(*[F.max(F.when(F.col("rule") == k, F.coalesce("l2", "l1", "l0"))).alias(f"max_{k}") for k in RULES])


def group_key(column: str) -> Column:
    """A key that is never null: null is a group of its own."""
    return F.when(F.col(column).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(column).cast("string")))


@scoped
def assess(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 200, reach: float = 6.0,
           keep: list[str] | None = None) -> DataFrame:
    """The kept columns, counts, base_failed, failed_rules and kept for every document.

    A document fails the base with fewer than 50 words or with more than half its words in repeated 3-word windows;
    these do not enter the sketches. Others are kept unless a rule's value exceeds the threshold of its language and source. Null
    and empty texts have no words and fail the base. Null languages and sources are groups of their own. Repeated rows
    are judged each; values that equal a threshold pass; an empty table gives no row. Columns named like a result are
    replaced. Documents are read once: they are stored with their counts, and verdicts follow from that table.
    """
    out = [*COUNTS, "base_failed", "failed_rules", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in out]
    wanted = [*keep, *[c for c in (lang, source) if c not in keep]]
    rows = stored(measure(docs, text, wanted), "quality-counts", keep=True).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    limits = stored(thresholds(rows.where(~F.col("base_failed")), lang, source, least, reach), "quality-limits", keep=True)
    judged = (rows.withColumn("_lang", group_key(lang)).withColumn("_source", group_key(source)).join(limits, ["_lang", "_source"], "left"))
    over = F.filter(F.array(*[F.when(v > F.col(f"max_{k}"), F.lit(k)) for k, v in rule_values().items()]), lambda x: x.isNotNull())
    return (judged.withColumn("failed_rules", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(over))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).select(*keep, *out))
