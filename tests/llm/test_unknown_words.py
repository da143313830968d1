"""Unknown words in the class-bigram scores of op8."""

import numpy as np

from pyspark.sql import functions as F

from shopflow.llm import brown as B, queries, toxicity
from tests.conftest import SF


def test_unknown_words_share_the_mass_of_their_class(edge, none):
    model, _ = B.train(edge.select("text"), words=30, endings=20, classes=6, divide=True)
    of = np.arange(6)
    unknown = model.emission(np.zeros(6), of)
    assert (unknown <= model.emission(np.ones(6), of) + 1e-12)[model.size > 0].all() and (unknown < 0).all()
    used = model.size > 0
    assert np.allclose((10 ** unknown * model.unseen)[used], (B.DISCOUNT * model.distinct / model.size)[used])
    empty, counts = B.train(none.select("text"), divide=True)
    assert {r.n_known for r in B.score(edge, empty, counts, ["doc_id"]).collect()} == {0}


def test_query_scores_random_words_below_seen_ones(spark, tmp_path):
    """Of equal endings, so that both are of one class."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    held_out = toxicity.remainder(F.col("doc_id"), 7) == 2
    words = [r.word for r in docs.where(~held_out).select(F.explode(F.split(F.lower("text"), "[ \n]+")).alias("word"))
             .groupBy("word").count().where("count = 3 and word rlike '^[a-z]{5,}$'").orderBy("word").limit(100).collect()]
    key = spark.range(10_000_000, 10_000_100).where(toxicity.remainder(F.col("id"), 7) == 2).orderBy("id").limit(2).collect()
    rows = [(key[0].id, " ".join(words)), (key[1].id, " ".join(f"q{i}x{w}" for i, w in enumerate(words)))]
    docs.union(spark.createDataFrame(rows, "doc_id long, text string")).write.parquet(str(tmp_path / "documents.parquet"))
    scores = {r.doc_id: r.score for r in queries.op8_brown_bigrams(spark, str(tmp_path)).where(F.col("doc_id") >= 10_000_000).collect()}
    assert words and scores[key[1].id] < scores[key[0].id]
