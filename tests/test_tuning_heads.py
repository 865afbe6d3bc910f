"""Many classes, soft labels, and tuning of heads on vectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelscope.operators import bayes, features, tuning
from labelscope.runtime import stored

SCHEMA = "row_id bigint, text string, label string"


def topics(n, classes, seed=1, noise=0.15):
    r = random.Random(seed)
    return [(k, " ".join(f"{c}x{r.randrange(9)}" if r.random() > noise else f"any{r.randrange(30)}" for _ in range(r.randint(6, 12))), c)
            for k, c in ((k, classes[k % len(classes)]) for k in range(n))]


def test_five_hundred_classes(spark):
    classes = [f"c{k:03d}" for k in range(500)]
    train = stored(spark.createDataFrame(topics(1500, classes), SCHEMA), "many")
    test = stored(spark.createDataFrame([(9000 + k, t, c) for k, t, c in topics(500, classes, 2)], SCHEMA), "many")
    model = features.fit_tfidf(train)
    weights = stored(model.transform(train, ("label",)), "weights")
    fitted = bayes.fit_multinomial_nb(weights, train.select("row_id", "label"), n_terms=model.n_terms)
    found = fitted.predict(test, model.transform(test))
    share = found.join(test.select("row_id", "label"), "row_id").agg(F.avg((F.col("label") == F.col("y_pred")).cast("int"))).first()[0]
    assert share > 0.9 and len(fitted.classes) == 500
    # the arrays of many classes add up to what single columns give
    some = weights.where("row_id < 40").select("row_id", "weight", F.array(F.col("weight"), F.lit(2.0), -F.col("weight")).alias("w"))
    columns = {r["row_id"]: r["_s"] for r in bayes.weighted_sums(some, 3).collect()}
    old, bayes.COLUMNS = bayes.COLUMNS, 2
    try:
        arrays = {r["row_id"]: r["_s"] for r in bayes.weighted_sums(some, 3).collect()}
    finally:
        bayes.COLUMNS = old
    assert columns.keys() == arrays.keys() and all(arrays[k] == pytest.approx(columns[k]) for k in columns)


def test_soft_labels_that_are_sure_are_labels(spark):
    rows = topics(90, list("abc"))
    df = stored(spark.createDataFrame(rows, SCHEMA), "rows")
    model = features.fit_tfidf(df)
    weights = stored(model.transform(df, ("label",)), "weights")
    names = F.array(*[F.lit(c) for c in "abc"])
    soft = df.select("row_id", names.alias("classes"), F.transform(names, lambda c: (c == F.col("label")).cast("double")).alias("scores"))
    hard = bayes.fit_multinomial_nb(weights, df.select("row_id", "label"), n_terms=model.n_terms)
    gentle = bayes.fit_soft_nb(weights.drop("label"), soft, n_terms=model.n_terms)
    assert gentle.start == pytest.approx(hard.start)
    a, b = ({r["term"]: r["w"] for r in m.terms.collect()} for m in (hard, gentle))
    assert a.keys() == b.keys() and all(b[t] == pytest.approx(a[t]) for t in a)
    halves = soft.withColumn("scores", F.array(F.lit(0.5), F.lit(0.5), F.lit(0.0)))
    even = bayes.fit_soft_nb(weights.drop("label"), halves, n_terms=model.n_terms)
    assert even.start[:2] == pytest.approx([math.log(0.5)] * 2) and even.start[2] == float("-inf")
    assert {r["y_pred"] for r in even.predict(df, model.transform(df)).collect()} <= {"a", "b"}


def test_student_learns_from_the_teacher_alone(spark):
    rows = topics(600, list("abcd"))
    labelled = stored(spark.createDataFrame(rows[:200], SCHEMA), "rows")
    pool = stored(spark.createDataFrame([(k, t, "unknown") for k, t, _ in rows[200:500]], SCHEMA), "pool")
    test = stored(spark.createDataFrame(rows[500:], SCHEMA), "test")
    teacher, student = tuning.distil(labelled, pool)
    found = tuning.agreement(teacher(test), student(test)).first()
    assert found["n"] == 100 and found["agreement"] > 0.95 and found["student_acc"] > 0.9


def test_rounds_reuse_the_vectors(spark, monkeypatch):
    rows = topics(240, list("abc"), noise=0.5)
    train, val = (stored(spark.createDataFrame(part, SCHEMA), "part") for part in (rows[:180], [*rows[180:], (999, "", "a")]))
    made, real = [], tuning.text_features
    monkeypatch.setattr(tuning, "text_features", lambda *a: made.append(a[2]) or real(*a))
    vec, clf, protocol = tuning.tune_linear(train, val, [("C=10", None, {"C": 10.0}), ("min_df=2", {"min_df": 2}, None), ("balanced", None, {"class_weight": "balanced"})], "linear_svc")
    assert [r["step"] for r in protocol.orderBy("round").collect()] == ["defaults", "C=10", "min_df=2", "balanced"]
    assert len(made) == 2 and set(vec) <= {"min_df"} and set(clf) <= {"C", "class_weight"}
    measured = tuning.refit_linear(train, val, {**vec, **clf}, head="linear_svc").first()
    assert measured["score_type"] == "decision_function" and measured["accuracy"] > 0.6
    assert real(train, val, tuning.TfidfOptions())[1].count() == val.count()  # a text without a known term counts too


def test_the_winner_is_fitted_again(spark):
    r = np.random.default_rng(4)
    rows = [(k, "abc"[k % 3], [float(x) for x in r.normal(size=3) + 3 * np.eye(3)[k % 3]]) for k in range(240)]
    df = features.dense_features(spark.createDataFrame(rows, "row_id bigint, label string, v array<double>"), "v", ("row_id", "label"))
    train, val, test = (df.where(f"row_id % 4 {x}") for x in ("< 2", "= 2", "= 3"))
    table, found = tuning.best_head(train, val, test, {"logreg": ("logreg", {"C": 3.0}), "weak": ("linear_svc", {"C": 1e-9})})
    assert [x["model_key"] for x in table.collect()][0] == "logreg" and table.count() == 2
    assert found.count() == 60 and {x["score_type"] for x in found.collect()} == {"proba"}
    assert found.where("y_true = y_pred").count() > 54
    best, protocol = tuning.tune_dense(train, val, [("C=9", {"C": 9.0})])
    assert protocol.count() == 2 and set(best) <= {"C"}


@pytest.mark.parametrize("extra", [[], [(5, "ax1 ax2 zz", "b"), (None, "bx1", "a"), (None, "cx2", "a"), (5, "ax1", None)]])
def test_vectors_are_made_where_the_counts_lie(spark, monkeypatch, extra):
    rows = [*topics(60, list("abc")), (900, "", "a"), (901, None, "b"), *extra]
    train, other = (stored(spark.createDataFrame(part, SCHEMA), "part") for part in (rows, [(1, "ax1 ax1 new", "a"), (2, "new", "b")]))
    for options in (features.TfidfOptions(min_df=2), features.TfidfOptions(sublinear_tf=True, ngram_range=(1, 2))):
        model = features.fit_tfidf(train, min_df=options.min_df, sublinear_tf=options.sublinear_tf, ngram_range=options.ngram_range)
        wanted = [features.sparse_features(model.transform(part, ("label",)), model, ("label",)) for part in (train, other)]
        cut, calls, real = {}, [], features.term_counts
        monkeypatch.setattr(features, "term_counts", lambda *a: calls.append(a) or real(*a))
        for _ in range(2):  # texts are cut once
            found = features.text_vectors(train, [other], options, ("label",), cut)[1]
        assert len(calls) == 2
        monkeypatch.setattr(features, "term_counts", real)
        for mine, theirs in zip(found, wanted):
            a, b = (sorted(((r["row_id"], r["label"], r["features"]) for r in x.collect()), key=lambda r: repr(r[:2])) for x in (mine, theirs))
            assert [r[:2] for r in a] == [r[:2] for r in b]
            assert all(x.size == y.size and x.indices.tolist() == y.indices.tolist() and np.allclose(x.values, y.values) for (_, _, x), (_, _, y) in zip(a, b))
