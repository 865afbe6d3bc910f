"""Suspicious labels: out-of-fold probabilities without refits, the confident joint, ranked candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelscope.functions.scores import argmax_label, softmax
from labelscope.operators.bayes import row_sums
from labelscope.operators.features import in_parts, meet
from labelscope.runtime import ranked, stored

#: Digits at which probabilities are compared.
DIGITS = 9


def fold_model(sums: DataFrame, classes: list[str], log_totals: DataFrame, alpha: float) -> DataFrame:
    """(term, fold, w): log weights of all classes for each term and each fold it occurs in, learned from the
    other folds. ``sums`` has (term, fold, label, s), ``log_totals`` (fold, logs).

    Class sums are additive, so the sum without a fold is the whole sum less the fold's own. Only cells
    with a weight are rows: (folds of a term) x (labels of a term).
    """
    whole = sums.groupBy("term", "label").agg(F.sum("s").alias("whole"))
    seen = sums.groupBy("term", "fold").agg(F.map_from_entries(F.collect_list(F.struct("label", "s"))).alias("own"))
    entries = F.map_from_entries(F.collect_list(F.struct("label", "whole"))).alias("all")
    per_term = whole.groupBy("term").agg(entries)
    names = F.array(*[F.lit(c) for c in classes])
    share = lambda c: F.coalesce(F.try_element_at("all", c), F.lit(0.0)) - F.coalesce(F.try_element_at("own", c), F.lit(0.0))
    logs = F.transform(names, lambda c: F.log(F.greatest(share(c), F.lit(0.0)) + F.lit(float(alpha))))
    return seen.join(per_term, "term").join(log_totals, "fold").select(
        "term", "fold", F.zip_with(logs, "logs", lambda a, b: a - b).alias("w")
    )


def out_of_fold_scores(rows: DataFrame, weights: DataFrame, alpha: float = 1.0) -> DataFrame:
    """(row_id, label, fold, classes, scores): probabilities of multinomial Naive Bayes learned from the other folds.

    ``rows`` has (row_id, label, fold), ``weights`` (row_id, term, weight) of the same rows, with the ``part`` of
    ``TfidfModel.weigh`` or without. One pass
    counts class sums per fold; no model is fitted twice. A class that only one fold has gets no
    score there (minus infinity, probability 0). The vocabulary is that of all rows. What reaches
    the driver is classes x folds.
    """
    placed = stored(in_parts(weights).join(rows.select("row_id", "label", "fold"), "row_id"), "placed")
    sums = stored(placed.groupBy("term", "fold", "label").agg(F.sum("weight").alias("s")), "fold-sums")
    counts = {(r["fold"], r["label"]): r["n"] for r in rows.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    totals = {(r["fold"], r["label"]): r["t"] for r in sums.groupBy("fold", "label").agg(F.sum("s").alias("t")).collect()}
    folds, classes = sorted({f for f, _ in counts}), sorted({c for _, c in counts})
    size = sums.select("term").distinct().count()
    others = lambda table, fold, c: sum(table.get((f, c), 0) for f in folds if f != fold)
    spark = rows.sparkSession
    log_totals, starts = [], []
    for fold in folds:
        n = sum(others(counts, fold, c) for c in classes)
        log_totals.append((fold, [others(totals, fold, c) + alpha * size for c in classes]))
        starts.append((fold, [others(counts, fold, c) / n if n else 1.0 / len(classes) for c in classes]))
    schema = "fold bigint, logs array<double>"
    logged = lambda table, name: spark.createDataFrame(table, schema).select("fold", F.transform("logs", lambda x: F.log(x)).alias(name))
    model = fold_model(sums, classes, logged(log_totals, "logs"), alpha)
    number, kind = len(classes), T.StructType([placed.schema["row_id"], T.StructField("_s", T.ArrayType(T.DoubleType()))])
    summed = lambda found, answers: row_sums(found, answers, found.column("weight").to_numpy(), number)
    sums_of_rows = meet(placed.select("row_id", "fold", "term", "weight", "part"), model, kind, summed, ("term", "fold"))
    found = rows.join(sums_of_rows, "row_id", "left").join(logged(starts, "start"), "fold")
    # ln(0) is null: the class is not there
    start = F.transform("start", lambda x: F.coalesce(x, F.lit(float("-inf"))))
    joint = F.when(F.col("_s").isNull(), start).otherwise(F.zip_with("_s", start, lambda a, b: a + b))
    return found.select("row_id", "label", "fold", F.lit(classes).alias("classes"), softmax(joint).alias("scores"))


def thresholds(scored: DataFrame) -> DataFrame:
    """(label, threshold): mean probability that the rows of a label give their own label."""
    own = F.round(own_probability(), DIGITS)
    return scored.groupBy("label").agg(F.round(F.avg(own), DIGITS).alias("threshold"))


def own_probability() -> Column:
    return F.get("scores", F.array_position("classes", F.col("label")).cast("int") - 1)


def confident_labels(scored: DataFrame) -> DataFrame:
    """(row_id, label, confident, own, best): ``confident`` is the class of highest probability among those that reach
    their threshold (the first of equal ones), null if none does.

    ``scored`` should be a stored table; thresholds are one row per class.
    """
    limits = {r["label"]: r["threshold"] for r in thresholds(scored).collect()}
    table = F.create_map(*[x for k, v in sorted(limits.items()) for x in (F.lit(k), F.lit(v))]) if limits else F.lit(None).cast("map<string, double>")
    reaching = F.zip_with(
        "scores", "classes", lambda p, c: F.when(F.round(p, DIGITS) >= F.try_element_at(table, c), F.round(p, DIGITS)).otherwise(F.lit(-1.0))
    )
    rows = scored.select("row_id", "label", "classes", F.round(own_probability(), DIGITS).alias("own"), reaching.alias("_r"))
    best = F.array_max("_r")
    return rows.select(
        "row_id", "label", F.when(best >= 0, argmax_label(F.col("_r"), F.col("classes"))).alias("confident"), "own",
        F.when(best >= 0, best).alias("best"),
    )


def confident_joint(confident: DataFrame) -> DataFrame:
    """(label, confident, n, share): rows by given and confident label; ``share`` estimates how much of all rows such
    pairs make up, each given label scaled to its number of rows."""
    counts = confident.groupBy("label").agg(F.count("*").alias("_rows"), F.count("confident").alias("_sure"))
    cells = confident.where("confident is not null").groupBy("label", "confident").agg(F.count("*").alias("n"))
    everything = Window.partitionBy()
    totals = counts.where("_sure > 0").withColumn("_all", F.sum("_rows").over(everything))  # one row per class
    return cells.join(totals, "label").select(
        "label", "confident", "n", (F.col("n") / F.col("_sure") * F.col("_rows") / F.col("_all")).alias("share")
    )


def suspicious_labels(confident: DataFrame) -> DataFrame:
    """(row_id, label, suggested, own, best, margin, place): rows whose confident label is not the given one, the
    largest lead of the suggested label first, then by row_id. The order comes from range partitions."""
    rows = confident.where("confident <> label").select(
        "row_id", "label", F.col("confident").alias("suggested"), "own", "best", F.round(F.col("best") - F.col("own"), DIGITS).alias("margin")
    )
    return ranked(rows, [], [F.desc("margin"), F.col("row_id")], "place")
