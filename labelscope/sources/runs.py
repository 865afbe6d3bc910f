"""Run registry, prediction store, experiment log and chat export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelscope.functions.answers import message
from labelscope.functions.scores import generation, rounded
from labelscope.operators.metrics import evaluate_runs
from labelscope.runtime import stored


def upsert_results(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Registry with the runs of ``new`` replaced or added, best accuracy first.

    Columns: model_key, accuracy, macro_f1, weighted_f1, model, extra map<string,string>.
    The result is a new table; write it to a new version folder.
    """
    fresh = new.withColumn("accuracy", rounded(F.col("accuracy"), 4))
    kept = registry.join(fresh, "model_key", "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True).orderBy(
        F.desc("accuracy"), "model_key"
    )


def save_predictions(predictions: DataFrame, path: str) -> None:
    """Store predictions by run; a run that is saved again replaces its own folder only."""
    (
        predictions.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_key")
        .parquet(path)
    )


def load_predictions(
    spark: SparkSession, path: str, model_keys: Sequence[str] | None = None
) -> DataFrame:
    """Read stored predictions; naming runs prunes the other folders."""
    table = spark.read.parquet(path).withColumn("model_key", F.col("model_key").cast("string"))
    return table if model_keys is None else table.where(F.col("model_key").isin(list(model_keys)))


def read_registry(spark: SparkSession, root: str) -> tuple[int, DataFrame | None]:
    """Newest version number of the registry below ``root`` and its rows (0, None if new)."""
    try:
        versions = spark.read.parquet(root)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return 0, None
    newest = versions.agg(F.max("version")).first()[0]
    return newest, versions.where(F.col("version") == newest).drop("version")


def evaluate_and_save(
    predictions: DataFrame, details: DataFrame, registry_root: str, predictions_path: str
) -> DataFrame:
    """Measure runs, store their predictions (with scores, if any), and upsert the registry.

    The registry is written as a new ``version=N`` folder, so readers of an older version
    are not disturbed. Returns the new version.
    """
    spark = predictions.sparkSession
    save_predictions(predictions, predictions_path)
    keys = [r["model_key"] for r in details.select("model_key").collect()]  # one per run
    fresh = stored(evaluate_runs(load_predictions(spark, predictions_path, keys), details), "fresh-results")  # read twice
    version, registry = read_registry(spark, registry_root)
    merged = upsert_results(fresh.limit(0) if registry is None else registry, fresh)
    merged.write.parquet(f"{registry_root}/version={version + 1}")
    return read_registry(spark, registry_root)[1]


def list_models(predictions: DataFrame, scores_col: str = "scores") -> DataFrame:
    """Every run with predictions, and whether it has scores."""
    return (
        predictions.groupBy("model_key")
        .agg(F.max(F.col(scores_col).isNotNull()).alias("has_scores"))
        .orderBy("model_key")
    )


def scoreboard(registry: DataFrame) -> DataFrame:
    """Model, generation, accuracy % and macro-F1 % (0 if missing), best first."""
    return registry.select(
        F.coalesce("model", "model_key").alias("model"),
        generation(F.col("model_key")).alias("generation"),
        F.round(F.col("accuracy") * 100, 2).alias("accuracy_pct"),
        F.round(F.coalesce("macro_f1", F.lit(0.0)) * 100, 2).alias("macro_f1_pct"),
        "model_key",
    ).orderBy(F.desc("accuracy_pct"), "model_key")


def tuning_deltas(registry: DataFrame, pairs: DataFrame) -> DataFrame:
    """Gain in percentage points per (strategy, plain_key, tuned_key); half pairs are skipped."""
    plain = registry.select(F.col("model_key").alias("plain_key"), F.col("accuracy").alias("_p"))
    tuned = registry.select(F.col("model_key").alias("tuned_key"), F.col("accuracy").alias("_t"))
    return (
        pairs.join(plain, "plain_key")
        .join(tuned, "tuned_key")
        .select(
            "strategy",
            generation(F.col("strategy")).alias("generation"),
            F.round(F.col("_p") * 100, 2).alias("plain_pct"),
            F.round(F.col("_t") * 100, 2).alias("tuned_pct"),
            F.round((F.col("_t") - F.col("_p")) * 100, 2).alias("delta_points"),
        )
        .orderBy(F.desc("delta_points"), "strategy")
    )


def measurements_with_accuracy(measurements: DataFrame, registry: DataFrame) -> DataFrame:
    """Size and latency per model family with its accuracy, null where no run is known."""
    accuracy = registry.select(F.col("model_key").alias("result_key"), "accuracy")
    return measurements.join(accuracy, "result_key", "left").select(
        F.coalesce("family", "result_key", F.lit("?")).alias("family"),
        "params_mio",
        "latency_ms",
        "size_mb",
        F.round(F.col("accuracy") * 100, 2).alias("accuracy_pct"),
    )


def efficiency_frontier(table: DataFrame) -> DataFrame:
    """Accuracy against size, with a flag for families no smaller one matches or beats."""
    smaller = (
        Window.orderBy("params_mio", F.desc("accuracy_pct"), "family")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        table.dropna(subset=["params_mio", "accuracy_pct"])
        .withColumn("_best", F.max("accuracy_pct").over(smaller))
        .select(
            "family", "params_mio", "accuracy_pct",
            (F.col("_best").isNull() | (F.col("accuracy_pct") > F.col("_best"))).alias("on_frontier"),
        )
    )


def rank_shift(registry: DataFrame) -> DataFrame:
    """Rank by accuracy and by macro-F1, and how far each run moves."""
    by_accuracy = F.rank().over(Window.orderBy(F.desc("accuracy")))
    by_f1 = F.rank().over(Window.orderBy(F.desc("macro_f1")))
    return registry.select(
        "model_key",
        by_accuracy.cast("bigint").alias("rank_accuracy"),
        by_f1.cast("bigint").alias("rank_macro_f1"),
        (by_accuracy - by_f1).cast("bigint").alias("places_gained"),
    )


def append_log(log: DataFrame, path: str) -> None:
    """Append runs (key, seq, config, metric, note) to the experiment log."""
    log.write.mode("append").parquet(path)


def latest_runs(log: DataFrame) -> DataFrame:
    """Newest entry per run key; partial aggregation keeps one row per key and task."""
    rest = [c for c in log.columns if c not in ("key", "seq")]
    newest = F.max_by(F.struct("seq", *rest), F.col("seq"))
    return log.groupBy("key").agg(newest.alias("_row")).select("key", "_row.*")


def chat_lines(corpus: DataFrame, system: str) -> DataFrame:
    """One JSON line ``{"messages": [system, user, assistant]}`` per example."""
    turns = F.array(
        message("system", F.lit(system)),
        message("user", F.col("text")),
        message("assistant", F.col("label")),
    )
    return corpus.select("row_id", F.to_json(F.struct(turns.alias("messages"))).alias("value"))


def export_chat_jsonl(corpus: DataFrame, system: str, path: str) -> None:
    chat_lines(corpus, system).select("value").write.text(path)
