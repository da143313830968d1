"""URL classification: features, training, scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

FEATURES = 1 << 14


def url_features(n_features: int = FEATURES) -> list:
    """Stages from ``url`` to a fixed-size vector: words, digit runs as ``#``, single and paired."""
    clean = SQLTransformer(statement=(
        "SELECT *, concat('^ ', regexp_replace(regexp_replace(lower(coalesce(url, '')), '^https?://[^/?#]*', ''), "
        "'[0-9]+', ' # '), ' $') AS _path FROM __THIS__"))
    tokens = RegexTokenizer(inputCol="_path", outputCol="_tokens", pattern=r"[^\p{L}#^$/]+|(?=/)|(?<=/)", minTokenLength=1)
    pairs = NGram(n=2, inputCol="_tokens", outputCol="_pairs")
    both = SQLTransformer(statement="SELECT *, concat(_tokens, _pairs) AS _terms FROM __THIS__")
    return [clean, tokens, pairs, both, HashingTF(inputCol="_terms", outputCol="_features", numFeatures=n_features)]


def train_url_model(labelled: DataFrame, n_features: int = FEATURES) -> PipelineModel:
    """Fit on (url, is_product)."""
    data = labelled.select("url", F.col("is_product").cast("double").alias("label"))
    model = LogisticRegression(featuresCol="_features", labelCol="label", regParam=0.01, maxIter=50)
    return Pipeline(stages=[*url_features(n_features), model]).fit(data)


def evaluate_url_model(model: PipelineModel, labelled: DataFrame) -> float:
    """Area under the curve on labelled URLs."""
    scored = model.transform(labelled.select("url", F.col("is_product").cast("double").alias("label")))
    return BinaryClassificationEvaluator(labelCol="label").evaluate(scored)


def classify_urls(df: DataFrame, model: PipelineModel | None = None,
                  make_predictor: Callable[[], Callable] | None = None, batch_size: int = 8) -> DataFrame:
    """Adds ``is_product``, ``confidence`` (probability of the chosen class) and ``type``.

    A null URL gives (false, 0). ``make_predictor`` plugs in a foreign model: called once per worker, it returns a
    function from an array of URLs to an array of product probabilities.
    """
    if make_predictor is not None:
        from pyspark.ml.functions import predict_batch_udf

        score = predict_batch_udf(make_predictor, return_type=T.DoubleType(), batch_size=batch_size)
        scored = df.withColumn("_p", score("url"))
    else:
        scored = model.transform(df).withColumn("_p", F.get(vector_to_array("probability"), 1))
    failed = F.col("url").isNull() | F.col("_p").isNull() | F.isnan("_p")
    product = ~failed & (F.col("_p") > 0.5)
    return (scored.withColumn("is_product", product)
            .withColumn("confidence", F.when(failed, 0.0).otherwise(F.greatest(F.col("_p"), 1 - F.col("_p"))))
            .withColumn("type", F.when(F.col("is_product"), F.lit("product")))
            .select(*df.columns, "is_product", "confidence", "type"))
