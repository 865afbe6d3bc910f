"""Is a difference between runs real? Bootstrap intervals and McNemar tests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelscope.functions.text import hash_number
from labelscope.runtime import stored


def hits_per_model(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model_key").agg(
        F.count("*").alias("n"), F.count_if(F.col("y_true") == F.col("y_pred")).alias("hits")
    )


def resample_distribution(counts: DataFrame) -> DataFrame:
    """(model_key, hits_k, cdf): how many hits a resample of n rows with replacement has.

    n draws from n rows of which ``hits`` are right give a Binomial(n, hits / n) number of
    hits, whatever the rows are. The cells within 12 standard deviations (all mass a double
    can hold) are weighted relative to the lowest one by the ratio of neighbours,
    (n - k + 1) / k * p / (1 - p); their number grows with sqrt(n).
    """
    p = F.col("hits") / F.col("n")
    width = F.ceil(12 * F.sqrt(F.col("n") * p * (1 - p)) + 12).cast("bigint")
    certain = (F.col("hits") == 0) | (F.col("hits") == F.col("n"))
    low = F.when(certain, F.col("hits")).otherwise(F.greatest(F.col("hits") - width, F.lit(0)))
    high = F.when(certain, F.col("hits")).otherwise(F.least(F.col("hits") + width, F.col("n")))
    cells = counts.select(
        "model_key", "n", "hits", low.alias("low"), F.explode(F.sequence(low, high)).alias("k")
    )
    step = F.log((F.col("n") - F.col("k") + 1) / F.col("k") * (F.col("hits") / (F.col("n") - F.col("hits"))))
    upward = (
        Window.partitionBy("model_key").orderBy("k")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    model = Window.partitionBy("model_key")
    height = cells.withColumn("step", F.when(F.col("k") > F.col("low"), step).otherwise(0.0)).withColumn(
        "log_w", F.sum("step").over(upward)
    )
    weight = height.withColumn("w", F.exp(F.col("log_w") - F.max("log_w").over(model)))
    return weight.select(
        "model_key", "n", F.col("k").alias("hits_k"),
        (F.sum("w").over(upward) / F.sum("w").over(model)).alias("cdf"),
    )


def bootstrap_ci(predictions: DataFrame, n_boot: int = 2000, seed: int = 0) -> DataFrame:
    """Accuracy with the 2.5 and 97.5 percentile of ``n_boot`` resamples, best first.

    A resample's accuracy only depends on its number of hits, so each replicate draws that
    number (hash-based, by inverting its distribution) instead of n rows. The predictions
    are read once; the rest works on n_boot + O(sqrt(n)) rows per model.
    """
    counts = stored(hits_per_model(predictions), "hits")  # one row per model, read three times
    ladder = resample_distribution(counts).select(
        "model_key", F.col("cdf").alias("at"), "hits_k", F.lit(0).alias("is_draw")
    )
    replicate = counts.select(
        "model_key", F.explode(F.sequence(F.lit(1), F.lit(n_boot))).alias("b")
    )
    uniform = (hash_number(F.col("model_key"), f":{seed}:", F.col("b")) + 0.5) / float(1 << 32)
    draws = replicate.select(
        "model_key", uniform.alias("at"), F.lit(None).cast("bigint").alias("hits_k"), F.lit(1).alias("is_draw")
    )
    # from the top down, so that the frame only grows: the last cell passed is the lowest one not below the draw
    downward = (
        Window.partitionBy("model_key").orderBy(F.desc("at"), "is_draw", F.desc("hits_k"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    drawn = (
        ladder.unionByName(draws)
        .withColumn("drawn", F.last("hits_k", ignorenulls=True).over(downward))
        .where("is_draw = 1")
        .groupBy("model_key")
        .agg(F.percentile("drawn", F.array(F.lit(0.025), F.lit(0.975))).alias("q"))
    )
    percent = lambda c: F.round(c / F.col("n") * 100, 6)
    return counts.join(drawn, "model_key").select(
        "model_key",
        percent(F.col("hits")).alias("accuracy_pct"),
        percent(F.col("q")[0]).alias("low_pct"),
        percent(F.col("q")[1]).alias("high_pct"),
    ).orderBy(F.desc("accuracy_pct"), "model_key")


def log_factorial(n: Column) -> Column:
    """ln(n!): exact up to 20, then Stirling's series (error below 1e-12)."""
    x = n.cast("double")
    small = F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))
    series = (
        x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x)
        + 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5)) - 1 / (1680 * F.pow(x, 7))
    )
    return F.when(n <= 20, small).otherwise(series)


def binomial_two_sided(low: Column, n: Column) -> Column:
    """min(1, 2 P(X <= low)) for X ~ Binomial(n, 1/2) and low <= n / 2; 1 if n = 0.

    Starts at the largest term and walks down by the ratio of neighbours. 20 sqrt(n)
    terms reach 40 standard deviations, past which nothing changes a double.
    """
    top = log_factorial(n) - log_factorial(low) - log_factorial(n - low) - n * math.log(2)
    steps = F.least(low, F.ceil(20 * F.sqrt(n.cast("double")) + 50).cast("bigint"))
    walk = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), steps),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total")),
        lambda acc, j: F.struct(
            (acc["term"] * (low - j) / (n - low + j + 1)).alias("term"),
            (acc["total"] + acc["term"]).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    return F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * F.exp(top) * walk))


def mcnemar_pairs(predictions: DataFrame, alpha: float = 0.05) -> DataFrame:
    """All pairs of models: rows only one of them got right, exact p, significant or not.

    Each row's verdicts are folded into one pattern (as long as the number of models) and
    patterns are counted, so pairs are formed per distinct pattern and not per row.
    """
    right = F.col("y_true") == F.col("y_pred")
    verdicts = F.array_sort(F.collect_list(F.struct("model_key", right.alias("ok"))))
    patterns = (
        predictions.groupBy("row_id").agg(verdicts.alias("v")).groupBy("v").agg(F.count("*").alias("n"))
    )
    pairs = (
        patterns.select("n", F.posexplode("v").alias("i", "a"), "v")
        .select("n", "a", F.explode(F.slice("v", F.col("i") + 2, F.size("v"))).alias("b"))
        .groupBy(F.col("a.model_key").alias("model_a"), F.col("b.model_key").alias("model_b"))
        .agg(
            F.sum(F.when(~F.col("a.ok") & F.col("b.ok"), F.col("n")).otherwise(0)).alias("only_b"),
            F.sum(F.when(F.col("a.ok") & ~F.col("b.ok"), F.col("n")).otherwise(0)).alias("only_a"),
        )
    )
    p = binomial_two_sided(F.least("only_a", "only_b"), F.col("only_a") + F.col("only_b"))
    return pairs.withColumn("_p", p).select(
        "model_a", "model_b", "only_b", "only_a",
        F.round("_p", 6).alias("p_value"), (F.col("_p") < alpha).alias("significant"),
    )
