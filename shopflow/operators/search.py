"""Text relevance, stored searches against products, similar products."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopflow.functions import text
from shopflow.functions.columns import once
from shopflow.operators.catalogue import product_text, product_words, query_words
from shopflow.operators.skew import top_per_key
from shopflow.runtime import cut, written
from shopflow.schemas import PRODUCT_KEY

K1, B = 1.2, 0.75
LAST_BIN, ANY_BIN, ANY_STATE = 255, -1, "*"
TILE = 4096  # stored searches and products of a cell that meet in one piece
LISTED = ("shop_name", "shop_type", "state", "authenticity", "condition", "provenance", "restoration")


def score(df: DataFrame, query: str, content: Column | None = None) -> DataFrame:
    """Adds ``score``: BM25 of the query words over all rows of ``df``; 0 without a hit.

    One aggregate over the table gives row count, mean length and document frequencies; nothing is shuffled by word.
    Words are counted by byte searches in the normalised text, without building word lists.
    """
    terms = query_words(query)
    content = product_text() if content is None else content
    spaced = once(once(df, _norm=text.word_text(content)), _words=text.spaced_words(F.col("_norm")))
    counted = once(spaced, _len=text.words_in(F.col("_norm")), **{
        f"_tf{i}": text.times_spaced(F.col("_words"), t) for i, t in enumerate(terms)}).drop("_norm", "_words")
    stats = counted.select(F.struct(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("_len").alias("mean"),
        *[F.count_if(F.col(f"_tf{i}") > 0).cast("double").alias(f"df{i}") for i in range(len(terms))])).scalar()
    scored = counted.withColumn("_s", stats)
    s, total = F.col("_s"), F.lit(0.0)
    for i in range(len(terms)):
        idf = F.log1p((s["n"] - s[f"df{i}"] + 0.5) / (s[f"df{i}"] + 0.5))
        tf = F.col(f"_tf{i}")
        total = total + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("_len") / s["mean"]))).otherwise(0.0)
    return scored.withColumn("score", total).drop("_s", "_len", *[f"_tf{i}" for i in range(len(terms))])


def _allows(name: str) -> Column:
    wanted = F.col(f"f.product_search.{name}")
    return wanted.isNull() | (F.size(wanted) == 0) | F.coalesce(F.array_contains(wanted, F.col(name)), F.lit(False))


def _in_range(name: str, low: Column, high: Column) -> Column:
    bounds = F.col(f"f.product_search.{name}")
    return bounds.isNull() | F.coalesce(
        (bounds["min"].isNull() | (high >= bounds["min"])) & (bounds["max"].isNull() | (low <= bounds["max"]))
        & low.isNotNull(), F.lit(False))


def price_bin(amount: Column) -> Column:
    """Bins of prices, four to a doubling; a larger price is never in a lower bin. Null stays null."""
    return F.when(amount < 1, 0).when(amount.isNotNull(), F.least(F.floor(F.log2(amount.cast("double")) * 4) + 1, F.lit(LAST_BIN))).cast("int")


def _with_copies(df: DataFrame, key: list[str]) -> DataFrame:
    """The rows with a whole key, each as often as its key occurs: copies of a search meet copies of a product in every combination, twice over."""
    keyed = df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in key]))
    counted = keyed.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    return counted.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int")))).drop("_n")


def match_filters(filters: DataFrame, products: DataFrame, tile: int = TILE) -> DataFrame:
    """(user_id, filter_id, shop_id, shops_product_id) for every stored search and product that match.

    Every search has a text, so candidates come from an equal join on the two words of a search that the fewest products
    have, together with what the search asks of price and state: the bins of its price range that products lie in, each of its states. A search
    that asks for no price or state meets products under a value that all of them have. Both sides carry what the other words and all other
    predicates need, so these are checked where the two meet and no pair is moved. Searches and products of one cell meet in tiles of
    ``tile`` rows of each, dealt to the tasks: a cell that many share is neither held nor worked off by one task.
    """
    stored = _with_copies(filters, ["user_id", "filter_id"]).withColumn("_words", F.array_distinct(text.words(F.col("product_search.product_query"))))
    checked = ["price", "origin_year", "origin_year_min", "origin_year_max", "created", "updated", "auction_start", "auction_end", *LISTED]
    having = products.select(*PRODUCT_KEY, *[F.col(c) for c in checked], F.array_distinct(product_words()).alias("_words"))
    asked = stored.select(F.explode("_words").alias("word")).distinct()
    having = written(_with_copies(having, PRODUCT_KEY), "offered-products")
    frequency = having.select(F.explode("_words").alias("word")).join(asked, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    texts = stored.select("_words").distinct().withColumn("word", F.explode("_words")).join(frequency, "word")
    rarest = F.sort_array(F.collect_list(F.struct("n", "word")))
    anchors = texts.groupBy("_words").agg(rarest.alias("r")).where(F.size("r") == F.size("_words")).select(
        "_words", F.get("r", F.lit(0))["word"].alias("word"), F.coalesce(F.get("r", F.lit(1)), F.get("r", F.lit(0)))["word"].alias("second"))
    anchors = written(anchors, "search-anchors")

    wanted = F.col("product_search.price")
    low, high = (F.when(wanted.isNull(), ANY_BIN).otherwise(F.coalesce(price_bin(wanted[end]), F.lit(default))) for end, default in (("min", 0), ("max", LAST_BIN)))
    states = F.when(F.size("product_search.state") > 0, F.array_distinct("product_search.state")).otherwise(F.array(F.lit(ANY_STATE)))
    placed = stored.join(anchors, "_words").select(
        "user_id", "filter_id", "word", "second", low.alias("low"), high.alias("high"), F.struct("product_search", "_words").alias("f"), F.explode(states).alias("_state"))

    own_bins = F.explode(F.array_compact(F.array(F.lit(ANY_BIN), price_bin(F.col("price.amount")))))
    own_states = F.explode(F.array_compact(F.array(F.lit(ANY_STATE), "state")))
    offered = (having.withColumn("word", F.explode("_words")).join(anchors.select("word").distinct(), "word", "left_semi")
               .withColumn("second", F.explode("_words")).join(anchors.select("word", "second").distinct(), ["word", "second"], "left_semi")
               .withColumn("bin", own_bins).withColumn("_state", own_states))
    cell, place = ["word", "second", "_state"], ["word", "second", "_state", "bin", "x", "y"]
    tiles = F.ceil(F.count(F.lit(1)) / tile).cast("int")
    cells = written(offered.groupBy(*cell, "bin").agg(tiles.alias("ys")).join(placed.groupBy(*cell).agg(tiles.alias("xs")), cell), "search-cells")
    numbered = lambda key, n: F.pmod(F.xxhash64(*key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    searches = (placed.join(cells, cell).where(F.col("bin").between(F.col("low"), F.col("high")))
                .withColumn("x", numbered(["user_id", "filter_id"], "xs")).withColumn("y", every("ys")).select("user_id", "filter_id", "f", *place))
    offers = (offered.join(cells, [*cell, "bin"]).withColumn("y", numbered(PRODUCT_KEY, "ys")).withColumn("x", every("xs"))
              .select(*PRODUCT_KEY, *checked, "_words", *place))
    parts = int(having.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = offers.repartition(parts, *place).join(searches.repartition(parts, *place).hint("merge"), place)

    price, search = F.col("price.amount"), "f.product_search"
    first = F.coalesce("origin_year_min", "origin_year", "origin_year_max")
    last = F.coalesce("origin_year_max", "origin_year", "origin_year_min")
    excluded = F.col(f"{search}.exclude_shop_name")
    keep = _in_range("price", price, price) & (F.col(f"{search}.price").isNull() | F.coalesce(
        F.col("price.currency") == F.col(f"{search}.currency"), F.lit(False)))
    for name in LISTED:
        keep = keep & _allows(name)
    keep = keep & (excluded.isNull() | ~F.coalesce(F.array_contains(excluded, F.col("shop_name")), F.lit(False)))
    keep = keep & _in_range("origin_year", first, last)
    for name in ("created", "updated", "auction_start", "auction_end"):
        keep = keep & _in_range(name, F.col(name), F.col(name))
    keep = keep & ((F.size("f._words") < 3) | (F.size(F.array_except("f._words", "_words")) == 0))
    return rows.where(keep).select("user_id", "filter_id", *PRODUCT_KEY)


# --- similar products -------------------------------------------------------------------------------------------

QUERY_BLOCK = 512
POINT_BLOCK = 4096


POINT_PARTS = 8  # parts of the points: a query leaves its k best of each


def _matrix(vectors: pd.Series) -> np.ndarray:
    m = np.array(vectors.tolist(), dtype=np.float64)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)


def _packed(vectors: DataFrame, size: int, parts: int, prefix: str) -> DataFrame:
    """Blocks of at most ``size`` vectors in ``parts`` partitions: ids and unit vectors."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), size):
                part = pdf.iloc[at:at + size].sort_values("id", kind="stable")
                yield pd.DataFrame({"ids": [part["id"].tolist()], "places": [_matrix(part["vector"]).astype("<f8").tobytes()]})

    kind = vectors.schema["id"].dataType.simpleString()
    spread = vectors.select("id", "vector").repartition(parts, F.xxhash64("id", "vector"))
    return cut(spread.mapInPandas(pack, f"ids array<{kind}>, places binary")).toDF(f"{prefix}_ids", f"{prefix}_places")


class _Nearest:
    """The k nearest so far of each query of a block, nearest first, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, places: np.ndarray, k: int) -> None:
        self.ids, self.places, self.k = ids, places, k
        self.least = np.full(len(ids), -np.inf)  # rounded similarity of the k-th
        self.at, self.near, self.sims = np.empty(0, np.int64), ids[:0], np.empty(0)

    def meet(self, ids: np.ndarray, places: np.ndarray) -> None:
        sims = np.clip(self.places @ places.T, -1.0, 1.0)
        sims[(self.ids[:, None] == ids[None, :]) | np.isnan(sims)] = -2.0
        rounded = np.round(sims, 12)
        least = self.least
        if rounded.shape[1] > self.k and np.isinf(least).any():
            least = np.maximum(least, np.partition(rounded, -self.k, axis=1)[:, -self.k])
        at, column = np.nonzero((rounded >= least[:, None]) & (rounded >= -1.0))
        at, near, sims = np.concatenate([self.at, at]), np.concatenate([self.near, ids[column]]), np.concatenate([self.sims, sims[at, column]])
        order = np.argsort(near, kind="stable")
        order = order[np.argsort(-np.round(sims[order], 12), kind="stable")]
        order = order[np.argsort(at[order], kind="stable")]
        begins = np.searchsorted(at[order], np.arange(len(self.ids)))
        place = np.arange(len(order)) - begins[at[order]]
        order, place = order[place < self.k], place[place < self.k]
        self.at, self.near, self.sims = at[order], near[order], sims[order]
        last = place == self.k - 1
        self.least[self.at[last]] = np.round(self.sims[last], 12)

    def found(self) -> pd.DataFrame:
        return pd.DataFrame({"id": self.ids[self.at], "other_id": self.near, "similarity": self.sims})


def similar(vectors: DataFrame, k: int, queries: DataFrame | None = None, query_block: int = QUERY_BLOCK,
            point_block: int = POINT_BLOCK) -> DataFrame:
    """The ``k`` nearest vectors by cosine for each query, exact: (id, rank, other_id, similarity).

    ``vectors`` and ``queries`` are (id, vector); all vectors are queries by default and none matches itself. Ties go
    to the smaller id. Points and queries are packed into blocks in the shared folder; a task reads a part of the queries and one of
    the points there, lets their blocks meet and holds one query block's best at a time. So neither side is shuffled to the other,
    and only the k best of a query leave a part of the points. Work is linear in the points for a set of queries.
    """
    asked = vectors if queries is None else queries
    kind = vectors.schema["id"].dataType.simpleString()
    points = _packed(vectors, point_block, POINT_PARTS, "p")
    blocks = _packed(asked, query_block, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), "q").withColumn("q", F.monotonically_increasing_id())
    met = blocks.crossJoin(points.hint("shuffle_replicate_nl")).select("q", "q_ids", "q_places", "p_ids", "p_places")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, best = None, None
        for pdf in batches:
            for q, own, own_places, ids, places in zip(*(pdf[c] for c in pdf.columns)):
                if q != held:
                    if best is not None:
                        yield best.found()
                    held = q
                    best = _Nearest(np.array(own), np.frombuffer(own_places, "<f8").reshape(len(own), -1), k)
                best.meet(np.array(ids), np.frombuffer(places, "<f8").reshape(len(ids), -1))
        if best is not None:
            yield best.found()

    best = met.mapInPandas(meet, f"id {kind}, other_id {kind}, similarity double")
    order = Window.partitionBy("id").orderBy(F.round("similarity", 12).desc(), "other_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("id", "rank", "other_id", "similarity")


def pending(products: DataFrame, vectors: DataFrame, key: str = "id") -> DataFrame:
    """Products without an embedding: their similar products are not known yet."""
    return products.join(vectors.select(key), key, "left_anti")
