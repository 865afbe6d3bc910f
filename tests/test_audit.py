"""Suspicious labels: out-of-fold scores against refits, planted errors, edge rows."""

import math
import random

import pytest

from labelscope.operators import audit, bayes
from labelscope.operators.features import fit_tfidf
from labelscope.operators.split import stratified_folds
from labelscope.runtime import stored

WORDS = {c: [f"{c}{k}" for k in range(30)] for c in "abc"}


def corpus(n, seed=1):
    """Texts of one topic's words and some of the others'; (row_id, text, true label)."""
    r = random.Random(seed)
    rows = []
    for k in range(n):
        c = "abc"[k % 3]
        words = [r.choice(WORDS[c] if r.random() < 0.95 else WORDS[r.choice("abc")]) for _ in range(r.randint(12, 16))]
        rows.append((k, " ".join(words), c))
    return rows


def scored(spark, rows, k=5):
    df = stored(spark.createDataFrame(rows, "row_id bigint, text string, label string"), "rows")
    weights = stored(fit_tfidf(df).transform(df), "weights")
    folds = stored(stratified_folds(df, k), "folds")
    return stored(audit.out_of_fold_scores(folds, weights), "scored"), folds, weights


def test_scores_are_those_of_models_fitted_without_the_fold(spark):
    found, folds, weights = scored(spark, corpus(90), 3)
    got = {r["row_id"]: r["scores"] for r in found.collect()}
    size = weights.select("term").distinct().count()
    for fold in range(3):
        train, rows = folds.where(f"fold <> {fold}"), folds.where(f"fold = {fold}")
        model = bayes.fit_multinomial_nb(
            weights.join(train.select("row_id", "label"), "row_id"), train.select("row_id", "label"), n_terms=size)
        terms = {r["term"]: r["w"] for r in model.terms.collect()}
        nothing = [math.log(1.0) - x for x in log_totals(weights, train, model.classes, size)]
        for row in rows.collect():
            own = [(r["term"], r["weight"]) for r in weights.where(f"row_id = {row['row_id']}").collect()] if row["row_id"] < 9 else None
            if own is None:
                continue
            joint = [s + sum(w * terms.get(t, nothing)[j] for t, w in own) for j, s in enumerate(model.start)]
            top = max(joint)
            total = sum(math.exp(x - top) for x in joint)
            assert got[row["row_id"]] == pytest.approx([math.exp(x - top) / total for x in joint], abs=1e-9)


def log_totals(weights, train, classes, size):
    sums = {r["label"]: r["t"] for r in weights.join(train, "row_id").groupBy("label").agg({"weight": "sum"}).toDF("label", "t").collect()}
    return [math.log(sums[c] + size) for c in classes]


def test_planted_errors_come_first(spark):
    rows = corpus(300, 2)
    wrong = {k: "abc"[("abc".index(rows[k][2]) + 1) % 3] for k in range(0, 300, 25)}
    given = [(k, text, wrong.get(k, c)) for k, text, c in rows]
    confident = stored(audit.confident_labels(scored(spark, given)[0]), "confident")
    found = {r["row_id"]: r for r in audit.suspicious_labels(confident).collect()}
    assert set(wrong) <= set(found) and all(found[k]["suggested"] == rows[k][2] for k in wrong)
    assert sorted(r["place"] for r in found.values()) == list(range(1, len(found) + 1))
    assert sum(found[k]["place"] <= len(wrong) + 3 for k in wrong) >= len(wrong) - 1
    joint = {(r["label"], r["confident"]): (r["n"], r["share"]) for r in audit.confident_joint(confident).collect()}
    assert sum(share for _, share in joint.values()) == pytest.approx(1.0)
    assert sum(n for (a, b), (n, _) in joint.items() if a != b) == len(found)


def test_rows_without_words_lone_classes_and_no_rows(spark):
    rows = [(1, "", "a"), (2, None, "b"), *corpus(30)[3:], (99, "lonely words", "z")]
    found = {r["row_id"]: r for r in scored(spark, rows, 3)[0].collect()}
    assert len(found) == len(rows) and all(sum(r["scores"]) == pytest.approx(1.0) for r in found.values())
    assert found[99]["scores"][found[99]["classes"].index("z")] == 0.0  # no other fold has the class
    assert found[1]["scores"][0] > 0
    empty = spark.createDataFrame([], "row_id bigint, label string, classes array<string>, scores array<double>")
    assert audit.suspicious_labels(empty.selectExpr("row_id", "label", "label AS confident", "0d AS own", "0d AS best")).count() == 0
