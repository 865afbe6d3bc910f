"""Hard metrics over predictions (model_key, row_id, y_true, y_pred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelscope.functions.answers import UNKNOWN
from labelscope.functions.scores import rounded
from labelscope.runtime import stored


def pair_counts(predictions: DataFrame) -> DataFrame:
    """Rows per (model, true, predicted): the only pass over the predictions.

    Partial aggregation leaves at most labels^2 rows per model and task, so nothing that
    grows with the data is shuffled.
    """
    return predictions.groupBy("model_key", "y_true", "y_pred").agg(F.count("*").alias("n"))


def label_stats(predictions: DataFrame) -> DataFrame:
    """support, predicted and true positives per (model, label), labels from both columns."""
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(none)
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"),
                 none.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("y_pred").alias("label"), none.alias("support"),
                 F.col("n").alias("predicted"), none.alias("tp")),
    )
    return (
        pair_counts(predictions)
        .select("model_key", F.inline(sides))
        .groupBy("model_key", "label")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
        .withColumn("f1", 2 * F.col("tp") / (F.col("support") + F.col("predicted")))
    )


def run_metrics(predictions: DataFrame, digits: int = 6) -> DataFrame:
    """Accuracy, macro-F1 over all true and predicted labels, weighted F1, per model."""
    return label_stats(predictions).groupBy("model_key").agg(
        F.sum("support").alias("n"),
        rounded(F.sum("tp") / F.sum("support"), digits).alias("accuracy"),
        rounded(F.avg("f1"), digits).alias("macro_f1"),
        rounded(F.sum(F.col("f1") * F.col("support")) / F.sum("support"), digits).alias("weighted_f1"),
    )


def score_once(predictions: DataFrame) -> tuple[float, float]:
    """(accuracy, macro-F1) of one run as numbers, from one aggregate job."""
    row = run_metrics(predictions, 12).select("accuracy", "macro_f1").first()
    return (row["accuracy"], row["macro_f1"]) if row else (0.0, 0.0)


def class_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label, 0 where undefined, weakest first."""
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return label_stats(predictions).select(
        "model_key", "label",
        F.round(ratio("tp", "predicted"), 6).alias("precision"),
        F.round(ratio("tp", "support"), 6).alias("recall"),
        F.round("f1", 6).alias("f1"),
        "support",
    ).orderBy("model_key", "f1", "label")


def weakest_classes(predictions: DataFrame, worst: int = 15) -> DataFrame:
    """The labels with the lowest F1 of each model."""
    order = Window.partitionBy("model_key").orderBy("f1", "label")
    return (
        class_report(predictions)
        .withColumn("place", F.row_number().over(order).cast("bigint"))
        .where(F.col("place") <= worst)
        .select("model_key", "place", "label", "f1", "recall", "support")
    )


def confusion_matrix(predictions: DataFrame, normalise: bool = False) -> DataFrame:
    """Counts for all (true, predicted) pairs of each model's labels, zeros included.

    ``share`` is the count over the row sum, at least 1. The zero cells come from the
    model's own label list, which is as long as its number of classes.
    """
    pairs = stored(pair_counts(predictions), "pairs")
    names = pairs.select("model_key", F.explode(F.array("y_true", "y_pred")).alias("label"))
    lists = names.groupBy("model_key").agg(F.collect_set("label").alias("labels"))
    zeros = (
        lists.select("model_key", F.explode("labels").alias("y_true"), "labels")
        .select("model_key", "y_true", F.explode("labels").alias("y_pred"))
        .withColumn("n", F.lit(0).cast("bigint"))
    )
    cells = pairs.unionByName(zeros).groupBy("model_key", "y_true", "y_pred").agg(F.sum("n").alias("n"))
    if not normalise:
        return cells
    total = F.sum("n").over(Window.partitionBy("model_key", "y_true"))
    return cells.withColumn("share", F.round(F.col("n") / F.greatest(total, F.lit(1)), 6))


def top_confusions(predictions: DataFrame, top: int = 15) -> DataFrame:
    """The most frequent wrong (true, predicted) pairs of each model."""
    order = Window.partitionBy("model_key").orderBy(F.desc("n"), "y_true", "y_pred")
    return (
        pair_counts(predictions.where("y_true <> y_pred"))
        .withColumn("place", F.row_number().over(order).cast("bigint"))
        .where(F.col("place") <= top)
    )


def error_examples(predictions: DataFrame, corpus: DataFrame) -> DataFrame:
    """Every misclassified row with its text, sorted by (true, predicted)."""
    wrong = predictions.where("y_true <> y_pred").select("model_key", "row_id", "y_true", "y_pred")
    return wrong.join(corpus.select("row_id", "text"), "row_id").orderBy(
        "model_key", "y_true", "y_pred", "row_id"
    )


def unknown_rate(predictions: DataFrame) -> DataFrame:
    """Answers without a usable label: count and share."""
    unknown = F.count_if(F.col("y_pred") == UNKNOWN)
    return predictions.groupBy("model_key").agg(
        F.count("*").alias("n"), unknown.alias("n_unknown"),
        F.round(unknown / F.count("*"), 6).alias("unknown_share"),
    )


def prompt_variant_report(predictions: DataFrame) -> DataFrame:
    """Accuracy, macro-F1 and unknown answers per prompt variant (the model_key)."""
    unknown = F.when(F.col("label") == UNKNOWN, F.col("predicted")).otherwise(0)
    return label_stats(predictions).groupBy("model_key").agg(
        F.sum("support").alias("n"),
        F.round(F.sum("tp") / F.sum("support"), 6).alias("accuracy"),
        F.round(F.avg("f1"), 6).alias("macro_f1"),
        F.sum(unknown).alias("n_unknown"),
    )


def evaluate_runs(predictions: DataFrame, details: DataFrame) -> DataFrame:
    """Registry rows: metrics rounded to 4 digits with model name and extra fields attached.

    ``details`` has (model_key, model, extra map<string,string>).
    """
    return run_metrics(predictions, 4).drop("n").join(details, "model_key", "left")


def cohens_kappa(pairs: DataFrame) -> DataFrame:
    """Chance-corrected agreement of two annotators over (item, a, b)."""
    counts = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    long = counts.select("n", (F.col("a") == F.col("b")).alias("same"),
                         F.inline(F.array(
                             F.struct(F.col("a").alias("label"), F.lit(1).alias("is_a")),
                             F.struct(F.col("b").alias("label"), F.lit(0).alias("is_a")))))
    margins = long.groupBy("label").agg(
        F.sum(F.when(F.col("is_a") == 1, F.col("n")).otherwise(0)).alias("n_a"),
        F.sum(F.when(F.col("is_a") == 0, F.col("n")).otherwise(0)).alias("n_b"),
        F.sum(F.when((F.col("is_a") == 1) & F.col("same"), F.col("n")).otherwise(0)).alias("agreed"),
    )
    n = F.sum("n_a")
    observed = F.sum("agreed") / n
    chance = F.sum(F.col("n_a").cast("double") * F.col("n_b")) / (n.cast("double") * n)
    return margins.agg(
        n.alias("n"), F.round(observed, 6).alias("observed"), F.round(chance, 6).alias("chance"),
        F.round(F.when(chance == 1, 1.0).otherwise((observed - chance) / (1 - chance)), 6).alias("kappa"),
    )


def latency_summary(
    log: DataFrame, order: list[str], warmup: int = 5, measured: int = 30, params: str | None = None,
    digits: int = 2,
) -> DataFrame:
    """Median latency per family over up to ``measured`` calls after ``warmup`` ones.

    Each task keeps warmup + measured rows per family before the shuffle. With a
    parameter count (millions), the size is 4 bytes each.
    """
    place = F.row_number().over(Window.partitionBy("family").orderBy(*order))
    used = log.withColumn("_p", place).where(F.col("_p") <= warmup + measured).where(F.col("_p") > warmup)
    extra = [] if params is None else [
        F.max(params).alias("params_mio"), F.round(F.max(params) * 4, 0).alias("size_mb")]
    return used.groupBy("family").agg(
        F.count("*").alias("n_measured"),
        F.round(F.percentile("latency_ms", F.lit(0.5)), digits).alias("latency_ms"), *extra,
    )
