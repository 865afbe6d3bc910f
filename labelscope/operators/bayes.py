"""Multinomial and complement Naive Bayes on a long table of term weights."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelscope.functions.scores import argmax_label, softmax
from labelscope.operators.features import TfidfModel, codes_of, meet, row_weights
from labelscope.runtime import stored


@dataclass
class BayesModel:
    """Per term one array of class weights; per class a start value."""

    classes: list[str]
    start: list[float]
    terms: DataFrame  # term, w array<double> in class order

    def scores(self, rows: DataFrame, weights: DataFrame) -> DataFrame:
        """(row_id, scores) for every row of ``rows``; a row without known terms keeps the start.

        Each (row, term) meets one model row that carries all classes, so the join does not
        multiply rows by the number of classes.
        """
        return self.started(rows, weighted_sums(weights.join(self.terms, "term"), len(self.classes)))

    def started(self, rows: DataFrame, per_row: DataFrame) -> DataFrame:
        start = F.lit(self.start)
        total = F.when(
            F.col("_s").isNotNull(), F.zip_with("_s", start, lambda a, b: a + b)
        ).otherwise(start)
        return rows.select("row_id").join(per_row, "row_id", "left").select("row_id", total.alias("scores"))

    def predict(self, rows: DataFrame, weights: DataFrame) -> DataFrame:
        """(row_id, scores, classes, y_pred)."""
        return self.chosen(self.scores(rows, weights))

    def predict_counts(self, rows: DataFrame, counts: DataFrame, tfidf: TfidfModel) -> DataFrame:
        """As ``predict`` from stored term counts: weights and sums of a row are made in the part that holds the row, so
        a part's terms are looked up once for both and only sums leave it."""
        number, options = len(self.classes), tfidf.options
        table = tfidf.vocabulary.select("term", "idf").join(self.terms, "term", "left")
        kind = T.StructType([counts.schema["row_id"], T.StructField("_s", T.ArrayType(T.DoubleType()))])

        def summed(found: pa.Table, answers: pa.Table) -> pa.Table:
            if len(found.column_names) > 5:  # counts by label too: a row_id's own are added up
                found = found.group_by(["row_id", "term", "at"]).aggregate([("tf", "sum")]).rename_columns(["row_id", "term", "at", "tf"])
            return row_sums(found, answers, row_weights(found, answers, options), number)

        return self.chosen(self.started(rows, meet(counts, table, kind, summed)))

    def chosen(self, scored: DataFrame) -> DataFrame:
        classes = F.lit(self.classes)
        return scored.select(
            "row_id", "scores", classes.alias("classes"),
            argmax_label(F.col("scores"), classes).alias("y_pred"),
        )

    def predict_proba(self, rows: DataFrame, weights: DataFrame) -> DataFrame:
        """As ``predict`` with scores as probabilities that sum to 1."""
        return self.predict(rows, weights).withColumn("scores", softmax(F.col("scores")))

    def strongest_terms(self, k: int = 10) -> DataFrame:
        """k terms per class with the largest advantage over the mean of all classes."""
        count = float(len(self.classes))
        mean = F.aggregate("w", F.lit(0.0), lambda acc, x: acc + x) / count
        long = self.terms.select(
            "term", F.posexplode(F.transform("w", lambda x: x - mean)).alias("c", "advantage")
        ).withColumn("label", F.lit(self.classes)[F.col("c")])
        order = Window.partitionBy("label").orderBy(F.desc(F.round("advantage", 9)), "term")
        return (
            long.withColumn("place", F.row_number().over(order).cast("bigint"))
            .where(F.col("place") <= k)
            .select("label", "place", "term", "advantage")
        )

    def save(self, path: str) -> None:
        spark = self.terms.sparkSession
        self.terms.write.parquet(f"{path}/terms")
        rows = [(i, c, s) for i, (c, s) in enumerate(zip(self.classes, self.start))]
        spark.createDataFrame(rows, "i int, label string, start double").write.parquet(f"{path}/classes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BayesModel":
        """Read a saved model; older folders stay valid, so rolling back is loading one of them."""
        rows = spark.read.parquet(f"{path}/classes").orderBy("i").collect()  # one row per class
        return BayesModel([r["label"] for r in rows], [r["start"] for r in rows],
                          spark.read.parquet(f"{path}/terms"))


#: Classes up to which a row's sums are separate columns (generated code); beyond, arrays are added.
COLUMNS = 64


def weighted_sums(hits: DataFrame, classes: int) -> DataFrame:
    """(row_id, _s): per row the sum of weight * w over its hits (row_id, weight, w), class by class."""
    if classes <= COLUMNS:
        sums = [F.sum(F.col("weight") * F.col("w")[i]) for i in range(classes)]
        return hits.groupBy("row_id").agg(F.array(*sums).alias("_s"))
    scaled = lambda hit: F.transform(hit["w"], lambda x: x * hit["weight"])
    rows = hits.groupBy("row_id").agg(F.collect_list(F.struct("weight", "w")).alias("_hits"))
    zero = F.array_repeat(F.lit(0.0), classes)
    return rows.select("row_id", F.aggregate(
        "_hits", zero, lambda total, hit: F.zip_with(total, scaled(hit), lambda a, b: a + b)
    ).alias("_s"))


def row_sums(found: pa.Table, answers: pa.Table, weight: np.ndarray, classes: int) -> pa.Table:
    """``weighted_sums`` inside ``meet``: ``weight`` of each row of ``found`` times the ``w`` of its answer, per row_id."""
    (row, ids), at, w = codes_of(found), found.column("at").to_numpy(), answers.column("w").combine_chunks()
    has = w.is_valid().to_numpy(zero_copy_only=False)
    matrix = np.zeros((len(answers), classes))
    matrix[has] = pc.fill_null(pc.list_flatten(w), 0.0).to_numpy(zero_copy_only=False).reshape(-1, classes)
    sums = np.stack([np.bincount(row, weights=weight * matrix[at, k], minlength=len(ids)) for k in range(classes)], axis=1)
    some = np.bincount(row, weights=has[at], minlength=len(ids)) > 0
    ends = pa.array(np.arange(some.sum() + 1, dtype=np.int32) * classes)
    return pa.table({"row_id": ids.filter(pa.array(some)), "_s": pa.ListArray.from_arrays(ends, pa.array(sums[some].ravel()))})


def class_sums(weights: DataFrame, labels: DataFrame) -> tuple[list[str], list[int], DataFrame, list[float]]:
    """Classes, their row counts, weight sums per term and class, and per class.

    Only class-sized results reach the driver. Sums are rows (term, label), partially aggregated in each
    task, so a class with a third of all rows shuffles one row per term and task, and a term is as long as
    the classes it occurs in, until it becomes an array.
    """
    counts = labels.groupBy("label").agg(F.count("*").alias("n")).orderBy("label").collect()
    sums = weights.groupBy("term", "label").agg(F.sum("weight").alias("s"))
    classes = [r["label"] for r in counts]
    return classes, [r["n"] for r in counts], *sums_by_class(sums, classes)


def sums_by_class(sums: DataFrame, classes: list[str]) -> tuple[DataFrame, list[float]]:
    """(term, s array in class order), and the total per class, of the rows (term, label, s)."""
    long = stored(sums, "term-sums")
    cells = F.map_from_entries(F.collect_list(F.struct("label", "s"))).alias("cells")
    names = F.array(*[F.lit(c) for c in classes])
    at = lambda c: F.coalesce(F.try_element_at("cells", c), F.lit(0.0))
    per_term = stored(long.groupBy("term").agg(cells).select("term", F.transform(names, at).alias("s")), "class-sums")
    totals = {r["label"]: r["t"] for r in long.groupBy("label").agg(F.sum("s").alias("t")).collect()}
    return per_term, [totals.get(c, 0.0) for c in classes]


def fit_soft_nb(weights: DataFrame, soft: DataFrame, alpha: float = 1.0, n_terms: int | None = None) -> BayesModel:
    """Multinomial Naive Bayes on soft labels: a row counts for each class as much as its teacher gives that class.

    ``weights`` has (row_id, term, weight), ``soft`` (row_id, classes, scores) with one class order and scores
    that sum to 1, such as the probabilities of another model or of cached answers. Rows without scores count for nothing.
    """
    classes = list((soft.select("classes").first() or [[]])[0])
    shares = soft.where("scores is not null").select("row_id", F.inline(F.arrays_zip(F.col("classes").alias("label"), F.col("scores").alias("p"))))
    shares = stored(shares.where("p > 0"), "soft-labels")
    counts = {r["label"]: r["n"] for r in shares.groupBy("label").agg(F.sum("p").alias("n")).collect()}
    sums = weights.join(shares, "row_id").groupBy("term", "label").agg(F.sum(F.col("weight") * F.col("p")).alias("s"))
    per_term, totals = sums_by_class(sums, classes)
    return multinomial_from_sums(classes, [counts.get(c, 0.0) for c in classes], per_term, totals, alpha, True, n_terms)


def fit_multinomial_nb(
    weights: DataFrame, labels: DataFrame, alpha: float = 1.0, fit_prior: bool = True, n_terms: int | None = None
) -> BayesModel:
    """Smoothed term shares per class; prior n_c / n, or uniform without ``fit_prior``.

    ``weights`` has (row_id, label, term, weight), ``labels`` one (row_id, label) per row.
    """
    classes, counts, per_term, totals = class_sums(weights, labels)
    return multinomial_from_sums(classes, counts, per_term, totals, alpha, fit_prior, n_terms)


def multinomial_from_sums(
    classes: list[str], counts: list[int], per_term: DataFrame, totals: list[float],
    alpha: float = 1.0, fit_prior: bool = True, n_terms: int | None = None,
) -> BayesModel:
    size = per_term.count() if n_terms is None else n_terms
    n = sum(counts)
    start = [(math.log(c / n) if c else float("-inf")) if fit_prior else -math.log(len(classes)) for c in counts]
    logs = F.lit([math.log(t + alpha * size) for t in totals])
    table = per_term.select(
        "term", F.zip_with("s", logs, lambda s, t: F.log(s + F.lit(float(alpha))) - t).alias("w")
    )
    return BayesModel(classes, start, table)


def fit_complement_nb(
    weights: DataFrame, labels: DataFrame, alpha: float = 1.0, norm: bool = False
) -> BayesModel:
    """Weights from all other classes; no prior unless there is a single class.

    ``norm`` divides each class's weights by their sum.
    """
    return complement_from_sums(*class_sums(weights, labels), alpha, norm)


def complement_from_sums(
    classes: list[str], counts: list[int], per_term: DataFrame, totals: list[float], alpha: float = 1.0, norm: bool = False
) -> BayesModel:
    size, everything = per_term.count(), sum(totals)
    a = float(alpha)
    logs = F.lit([math.log(everything + a * size - t) for t in totals])
    whole = F.aggregate("s", F.lit(0.0), lambda acc, x: acc + x)
    logged = F.zip_with("s", logs, lambda s, t: F.log(whole + a - s) - t)
    table = per_term.select("term", logged.alias("w"))
    if norm:
        table = stored(table, "complement")
        long = table.select(F.posexplode("w").alias("c", "x")).groupBy("c").agg(F.sum("x").alias("t"))
        sums = {r["c"]: r["t"] for r in long.collect()}
        table = table.select("term", F.zip_with("w", F.lit([sums[c] for c in range(len(classes))]), lambda w, t: w / t).alias("w"))
    else:
        table = table.select("term", F.transform("w", lambda w: -w).alias("w"))
    return BayesModel(classes, [0.0] * len(classes), table)
