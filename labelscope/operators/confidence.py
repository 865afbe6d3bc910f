"""Score-based metrics over (model_key, row_id, y_true, scores, classes, score_type)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelscope.functions import scores as sc
from labelscope.operators.selection import first_rows
from labelscope.runtime import stored


def scored_rows(predictions: DataFrame) -> DataFrame:
    """(model_key, row_id, score_type, conf, correct) from the score vectors."""
    s, c = F.col("scores"), F.col("classes")
    return predictions.select(
        "model_key", "row_id", "score_type", sc.confidence(s).alias("conf"),
        (sc.argmax_label(s, c) == F.col("y_true")).cast("bigint").alias("correct"),
    )


def reliability_bins(predictions: DataFrame, bins: int = 10) -> DataFrame:
    """Mean confidence and accuracy per confidence bin; probabilities only."""
    rows = scored_rows(predictions.where(sc.calibration_allowed(F.col("score_type"))))
    bin_no = F.least(F.floor(F.col("conf") * bins), F.lit(bins - 1)).cast("bigint")
    return rows.groupBy("model_key", bin_no.alias("bin")).agg(
        F.count("*").alias("n"), F.avg("conf").alias("mean_conf"), F.avg("correct").alias("accuracy")
    )


def expected_calibration_error(bins: DataFrame) -> DataFrame:
    """Bin-share-weighted gap between accuracy and confidence."""
    gap = F.abs(F.col("accuracy") - F.col("mean_conf"))
    return bins.groupBy("model_key").agg((F.sum(F.col("n") * gap) / F.sum("n")).alias("ece"))


def topk_accuracy(predictions: DataFrame, kmax: int = 5) -> DataFrame:
    """Share of rows whose true class is among the k best scores, k = 1..kmax.

    One pass: rows are counted per (model, rank), k is opened on those few counts.
    """
    rank = sc.true_class_rank(F.col("scores"), F.col("classes"), F.col("y_true"))
    counts = predictions.groupBy("model_key", rank.alias("r")).agg(F.count("*").alias("n"))
    return (
        counts.select("model_key", "r", "n", F.explode(F.sequence(F.lit(1), F.lit(kmax))).alias("k"))
        .groupBy("model_key", F.col("k").cast("bigint").alias("k"))
        .agg(F.round(F.sum(F.when(F.col("r") <= F.col("k"), F.col("n")).otherwise(0)) / F.sum("n") * 100, 6)
             .alias("topk_pct"))
    )


def risk_coverage(predictions: DataFrame, steps: int = 19) -> DataFrame:
    """Accuracy on the most confident share of the rows, for 5 % .. 100 % coverage.

    Each of the cut-offs is found by confidence histograms that get finer, so nothing but the cells
    around the cut-offs is ever ordered. Equal confidences (12 digits) are ordered by row_id; rows without a
    confidence come last.
    """
    conf = F.round("conf", 12)
    rows = stored(scored_rows(predictions).select(
        "model_key", conf.isNull().cast("int").alias("missing"), F.coalesce(-conf, F.lit(0.0)).alias("doubt"), "row_id", F.coalesce("correct", F.lit(0)).alias("correct"),
    ), "confidences")
    coverage = lambda i: F.lit(0.05) + i * F.lit(0.95 / (steps - 1))
    answered = F.greatest(F.floor(coverage(F.col("i")) * F.col("rows") + 1e-9), F.lit(1)).cast("bigint")
    cuts = stored(
        rows.groupBy("model_key").agg(F.count("*").alias("rows"))
        .select("model_key", "rows", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("i"))
        .select("model_key", F.col("i").cast("bigint").alias("step"), F.round(coverage(F.col("i")), 6).alias("coverage"), answered.alias("n")),
        "coverage-cuts",
    )
    sums = first_rows(rows, cuts.select("model_key", "n").distinct(), "model_key", ["missing", "doubt", "row_id"], "correct")
    return cuts.join(sums.select("model_key", "n", "hits"), ["model_key", "n"]).select(
        "model_key", "step", "coverage", F.col("n").alias("n_answered"), F.round(F.col("hits") / F.col("n"), 6).alias("accuracy"),
    )


def soft_vote(predictions: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Mean of two models' scores and the label it favours. Class order must be equal.

    A row that one model lacks keeps the other one's scores.
    """
    side = lambda key, name: predictions.where(F.col("model_key") == key).select(
        "row_id", F.struct("y_true", "classes").alias(name + "_row"), F.col("scores").alias(name)
    )
    both = side(model_a, "sa").join(side(model_b, "sb"), "row_id", "full").select(
        "row_id", "sa", "sb", F.coalesce("sa_row", "sb_row").alias("r")
    ).select("row_id", "sa", "sb", "r.*")
    mean = F.coalesce(F.zip_with("sa", "sb", lambda a, b: (a + b) / 2), "sa", "sb")
    return both.select("row_id", "y_true", "classes", mean.alias("scores")).withColumn(
        "y_pred", sc.argmax_label(F.col("scores"), F.col("classes"))
    )


def cascade(predictions: DataFrame, cheap: str, costly: str, threshold: float) -> DataFrame:
    """Confident rows keep the cheap model's label, only the rest takes the costly one's.

    A row without a confidence is unsure; an unsure row that the costly model lacks keeps the
    cheap label.
    """
    s, c = F.col("scores"), F.col("classes")
    first = predictions.where(F.col("model_key") == cheap).select(
        "row_id", "y_true", sc.argmax_label(s, c).alias("y_pred"), sc.confidence(s).alias("_conf")
    )
    certain = F.coalesce(F.col("_conf") >= threshold, F.lit(False))
    sure = first.where(certain).select("row_id", "y_true", "y_pred", F.lit(cheap).alias("answered_by"))
    second = predictions.where(F.col("model_key") == costly).select("row_id", F.struct("y_pred").alias("_second"))
    answered = F.col("_second").isNotNull()
    return sure.unionByName(first.where(~certain).join(second, "row_id", "left").select(
        "row_id", "y_true", F.when(answered, F.col("_second.y_pred")).otherwise(F.col("y_pred")).alias("y_pred"),
        F.when(answered, F.lit(costly)).otherwise(F.lit(cheap)).alias("answered_by"),
    ))


def pooled(lo: np.ndarray, hi: np.ndarray, weight: np.ndarray, hits: np.ndarray) -> list[np.ndarray]:
    """Pool adjacent violators: neighbouring blocks are joined until the shares hits / weight rise strictly."""
    stack: list[list[float]] = []
    for block in zip(lo.tolist(), hi.tolist(), weight.tolist(), hits.tolist()):
        stack.append(list(block))
        while len(stack) > 1 and stack[-2][3] * stack[-1][2] >= stack[-1][3] * stack[-2][2]:
            top = stack.pop()
            stack[-1] = [stack[-1][0], top[1], stack[-1][2] + top[2], stack[-1][3] + top[3]]
    return [np.array(column, float) for column in zip(*stack)] or [np.zeros(0)] * 4


BLOCKS = ("lo", "hi", "weight", "hits")


def isotonic_blocks(rows: DataFrame, digits: int | None = None) -> DataFrame:
    """(model_key, lo, hi, weight, hits): the steps of the isotonic regression of ``correct`` on ``conf`` per run.

    Rows are counted per distinct confidence and dealt by ranges; each range pools its own violators, then the
    blocks of all ranges of a run are pooled again, which gives the same steps as pooling all points at once. The
    shares of the blocks rise strictly and their weights add up to the rows, so a run of n rows
    has at most some n^(2/3) blocks (that many fractions of small enough denominators exist).
    """
    at = F.col("conf") if digits is None else F.round("conf", digits)
    counts = rows.where(F.col("conf").isNotNull()).groupBy("model_key", at.alias("c")).agg(
        F.count("*").cast("double").alias("weight"), F.sum("correct").cast("double").alias("hits")
    )
    dealt = counts.repartitionByRange("model_key", "c").sortWithinPartitions("model_key", "c")

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in batches:
            frame = frame.rename(columns={"c": "lo"}).assign(hi=frame["c"])
            frame = frame if held is None else pd.concat([held, frame])
            parts = [part_of(key, part) for key, part in frame.groupby("model_key", sort=True)]
            if parts:
                yield from parts[:-1]
                held = parts[-1]
        if held is not None:
            yield held

    def part_of(key: str, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model_key": key, **dict(zip(BLOCKS, pooled(*(part[c].to_numpy() for c in BLOCKS))))})

    def joined(part: pd.DataFrame) -> pd.DataFrame:
        return part_of(part["model_key"].iloc[0], part.sort_values("lo"))

    schema = "model_key string, lo double, hi double, weight double, hits double"
    return dealt.mapInPandas(task, schema).groupBy("model_key").applyInPandas(joined, schema)


def with_blocks(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add ``calibrated``: the step that holds a row's confidence; between steps on the line that joins them, below the
    first and above the last one their shares. Null without a confidence or for a run without steps."""
    steps = {}
    for r in blocks.orderBy("model_key", "lo").collect():
        steps.setdefault(r["model_key"], []).append((r["lo"], r["hi"], r["hits"] / r["weight"]))
    tables = {}
    for key, own in steps.items():
        ends = [(x, share) for lo, hi, share in own for x in ((lo, hi) if lo < hi else (lo,))]
        tables[key] = tuple(np.array(column) for column in zip(*ends))
    shared = rows.sparkSession.sparkContext.broadcast(tables)

    @F.pandas_udf("double")
    def calibrated(key: pd.Series, conf: pd.Series) -> pd.Series:
        found = pd.Series(np.nan, index=key.index)
        for name in key.dropna().unique():
            if name in shared.value:
                mine = (key == name) & conf.notna()
                found[mine] = np.interp(conf[mine], *shared.value[name])
        return found

    return rows.withColumn("calibrated", calibrated("model_key", "conf"))


def calibrate(
    rows: DataFrame, method: str = "isotonic", fit_rows: DataFrame | None = None, digits: int | None = None
) -> DataFrame:
    """Add ``calibrated`` to (model_key, row_id, conf, correct): repaired confidence.

    Fitted on ``fit_rows``, a validation part of the same columns (default: ``rows``). Isotonic regression
    treats each run for itself; ``digits`` rounds the confidences it is fitted on. Platt scaling is a one-feature logistic
    regression of one run, from counts per distinct confidence. A null confidence stays null.
    """
    fitted = rows if fit_rows is None else fit_rows
    if method == "isotonic":
        return with_blocks(rows, isotonic_blocks(fitted, digits))
    if method != "platt":
        raise ValueError(f"unknown method {method!r}")
    at = F.col("conf") if digits is None else F.round("conf", digits)
    known = F.col("conf").isNotNull()
    without = rows.where(~known).withColumn("calibrated", F.lit(None).cast("double"))
    counts = fitted.where(known).groupBy(at.alias("c")).agg(F.count("*").cast("double").alias("w"), F.avg("correct").alias("share"))
    verdicts = counts.select(
        array_to_vector(F.array("c")).alias("features"),
        F.inline(F.array(
            F.struct(F.lit(1.0).alias("y"), (F.col("w") * F.col("share")).alias("wy")),
            F.struct(F.lit(0.0).alias("y"), (F.col("w") * (1 - F.col("share"))).alias("wy")),
        )),
    ).where("wy > 0")
    model = LogisticRegression(featuresCol="features", labelCol="y", weightCol="wy").fit(verdicts)
    scored = model.transform(rows.where(known).withColumn("features", array_to_vector(F.array("conf"))))
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias("calibrated")).unionByName(without)


def calibration_effect(rows: DataFrame, bins: int = 10) -> DataFrame:
    """(model_key, n, ece_before, ece_after) of rows with ``conf`` and ``calibrated``."""
    known = stored(rows, "calibrated").where("calibrated is not null")

    def ece(column: str) -> DataFrame:
        # a share such as 3 / 5 must not fall below its own bin by rounding
        bin_no = F.least(F.floor(F.col(column) * bins + 1e-12), F.lit(bins - 1)).cast("bigint")
        counted = known.groupBy("model_key", bin_no.alias("bin")).agg(
            F.count("*").alias("n"), F.avg(column).alias("mean_conf"), F.avg("correct").alias("accuracy"))
        return expected_calibration_error(counted)

    n = known.groupBy("model_key").agg(F.count("*").alias("n"))
    before, after = (ece(c).withColumnRenamed("ece", name) for c, name in (("conf", "ece_before"), ("calibrated", "ece_after")))
    return n.join(before, "model_key").join(after, "model_key")
