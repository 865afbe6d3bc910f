"""Linear heads, projection and decision regions on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import PCA, StringIndexer, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelscope.functions import text as tx
from labelscope.functions.scores import argmax_label
from labelscope.operators.metrics import run_metrics
from labelscope.operators.neighbours import knn_classify
from labelscope.operators.split import balanced_weights
from labelscope.runtime import stored


class Head:
    """A fitted head: ``predict`` gives (row_id, y_pred, scores, classes, score_type)."""

    def __init__(self, model: PipelineModel, classes: list[str], score_type: str):
        self.model, self.classes, self.score_type = model, classes, score_type

    def predict(self, features: DataFrame) -> DataFrame:
        column = "probability" if self.score_type == "proba" else "rawPrediction"
        classes = F.lit(self.classes)
        scored = self.model.transform(features).withColumn("scores", vector_to_array(column))
        return scored.select(
            *[c for c in features.columns if c != "features"],
            argmax_label(F.col("scores"), classes).alias("y_pred"),
            "scores", classes.alias("classes"), F.lit(self.score_type).alias("score_type"),
        )

    def save(self, path: str) -> None:
        """The fitted model, its classes and the kind of its scores, below ``path``."""
        self.model.save(f"{path}/model")
        rows = [(k, c, self.score_type) for k, c in enumerate(self.classes)]
        SparkSession.active().createDataFrame(rows, "i int, label string, score_type string").write.parquet(f"{path}/classes")

    @staticmethod
    def load(path: str) -> "Head":
        rows = SparkSession.active().read.parquet(f"{path}/classes").orderBy("i").collect()  # one row per class
        return Head(PipelineModel.load(f"{path}/model"), [r["label"] for r in rows], rows[0]["score_type"])


def _fit(features: DataFrame, estimator, score_type: str, class_weight: str | None) -> Head:
    """Index labels in ascending order, attach weights, fit."""
    indexer = StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc").fit(features)
    data = indexer.transform(features)
    if class_weight == "balanced":
        weights = stored(balanced_weights(features).select("label", F.col("weight").alias("w")), "weights")
        data = data.join(weights, "label")
    else:
        data = data.withColumn("w", F.lit(1.0))
    model = PipelineModel([estimator.fit(data.select("features", "y", "w"))])
    return Head(model, list(indexer.labels), score_type)


def logistic_head(
    features: DataFrame, C: float = 1.0, class_weight: str | None = None, max_iter: int = 1000
) -> Head:
    """Multinomial logistic regression with an L2 term; ``C`` scales the data term.

    The library minimises w'w / 2 + C * sum(loss); Spark divides by the weight sum, so
    regParam = 1 / (C * n). Balanced weights add up to n as well.
    """
    n = features.count()
    estimator = LogisticRegression(
        featuresCol="features", labelCol="y", weightCol="w", family="multinomial",
        regParam=1.0 / (C * n), elasticNetParam=0.0, standardization=False, maxIter=max_iter,
    )
    return _fit(features, estimator, "proba", class_weight)


def sgd_head(
    features: DataFrame, alpha: float = 1e-4, loss: str = "hinge", class_weight: str | None = None,
    max_iter: int = 1000,
) -> Head:
    """Linear model alpha/2 * w'w + mean(loss), one-vs-rest, with hinge or logistic loss."""
    common = dict(featuresCol="features", labelCol="y", weightCol="w", regParam=alpha,
                  standardization=False, maxIter=max_iter)
    if loss not in ("hinge", "log_loss"):
        raise ValueError(f"unknown loss {loss!r}")
    one = LinearSVC(**common) if loss == "hinge" else LogisticRegression(family="binomial", **common)
    many = OneVsRest(classifier=one, featuresCol="features", labelCol="y", weightCol="w", parallelism=4)
    return _fit(features, many, "decision_function", class_weight)


def forest_head(features: DataFrame, trees: int = 20, depth: int = 8, seed: int = 42) -> Head:
    """Random forest on dense features."""
    estimator = RandomForestClassifier(
        featuresCol="features", labelCol="y", weightCol="w", numTrees=trees, maxDepth=depth, seed=seed
    )
    return _fit(features, estimator, "proba", None)


def head_comparison(
    train: DataFrame, val: DataFrame, heads: Mapping[str, Callable[[DataFrame], Head]], knn_k: int | None = 15
) -> DataFrame:
    """Validation accuracy and macro-F1 per head, best first; one fit per head.

    ``train`` and ``val`` have (vec_id, v, label) and should be stored tables.
    """
    features = lambda df: df.select(
        F.col("vec_id").alias("row_id"), "label", array_to_vector("v").alias("features")
    )
    train_f, val_f = features(train), features(val)
    parts = [
        make(train_f).predict(val_f).select(
            F.lit(name).alias("model_key"), "row_id", F.col("label").alias("y_true"), "y_pred"
        )
        for name, make in heads.items()
    ]
    if knn_k is not None:
        found = knn_classify(train, val, knn_k)
        parts.append(
            found.join(val.select("vec_id", "label"), "vec_id").select(
                F.lit(f"knn_{knn_k}").alias("model_key"), F.col("vec_id").alias("row_id"),
                F.col("label").alias("y_true"), "y_pred",
            )
        )
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return run_metrics(table).orderBy(F.desc("macro_f1"), "model_key")


def project_vectors(vectors: DataFrame, k: int = 3) -> DataFrame:
    """Add ``coords``: the first k principal components. Only a dim x dim matrix is gathered."""
    data = vectors.withColumn("features", array_to_vector("v"))
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(data)
    return model.transform(data).withColumn("coords", vector_to_array("pc")).drop("features", "pc")


def decision_regions(coords: DataFrame, steps: int = 300, pad: float = 3.0) -> DataFrame:
    """Label of every point of a steps x steps grid around 2-D coordinates.

    A linear head is fitted on the coordinates (x, y, label); the grid is made by Spark
    and labelled in place.
    """
    features = F.array("x", "y")
    head = logistic_head(coords.select("label", array_to_vector(features).alias("features")))
    low_x, high_x, low_y, high_y = coords.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()

    def axis(step: Column, low: float, high: float) -> Column:
        return F.lit(low - pad) + step * F.lit((high - low + 2 * pad) / (steps - 1))

    grid = coords.sparkSession.range(steps * steps).select(
        axis(F.pmod("id", F.lit(steps)), low_x, high_x).alias("x"),
        axis(F.floor(F.col("id") / steps), low_y, high_y).alias("y"),
    )
    return head.predict(grid.withColumn("features", array_to_vector(features))).select(
        "x", "y", F.col("y_pred").alias("label")
    )


def word_vectors(corpus: DataFrame, dim: int = 32, min_count: int = 5, seed: int = 42, partitions: int = 8, passes: int = 4):
    """Fitted word embedding model; offers ``findSynonyms`` and ``getVectors``.

    The texts train in ``partitions`` parts side by side, whose vectors are averaged after each of
    ``passes`` passes. More parts need more passes.
    """
    tokens = corpus.select(tx.tokenise_alpha(F.col("text")).alias("tokens"))
    return Word2Vec(
        vectorSize=dim, minCount=min_count, seed=seed, inputCol="tokens", outputCol="v", numPartitions=partitions, maxIter=passes
    ).fit(tokens)
