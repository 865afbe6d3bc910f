"""Squared hinge SVM: the optimum by an independent Newton method, sparse and dense rows, saved heads."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from labelscope.operators import heads, hinge
from labelscope.runtime import new_path, stored


def objective(w, x, sign, cost):
    gap = np.maximum(0, 1 - sign * (x @ w))
    return 0.5 * w @ w + (cost * gap**2).sum()


def newton(x, sign, cost):
    """Minimum of w'w/2 + sum cost max(0, 1 - sign x'w)^2 by damped Newton steps on dense matrices."""
    w = np.zeros(x.shape[1])
    for _ in range(200):
        gap = np.maximum(0, 1 - sign * (x @ w))
        slope = w - 2 * (cost * sign * gap) @ x
        if np.linalg.norm(slope) < 1e-10:
            break
        active = gap > 0
        step = np.linalg.solve(np.eye(len(w)) + 2 * (x[active].T * cost[active]) @ x[active], -slope)
        length = 1.0
        while objective(w + length * step, x, sign, cost) > objective(w, x, sign, cost) + 1e-4 * length * slope @ step and length > 1e-10:
            length /= 2
        w = w + length * step
    return w


def rows(n, dims, classes, seed, sparse=True):
    r = random.Random(seed)
    found = []
    for k in range(n):
        c = r.choice(classes)
        v = [r.gauss(1.0 if j % len(classes) == classes.index(c) else 0.0, 0.7) if r.random() < 0.5 else 0.0 for j in range(dims)]
        made = Vectors.sparse(dims, [j for j, x in enumerate(v) if x], [x for x in v if x]) if sparse and k % 2 else Vectors.dense(v)
        found.append((k, c, made))
    found.append((n, classes[0], Vectors.sparse(dims, [], [])))
    return found


def brute(data, classes, c, balanced):
    x = np.array([np.append(v.toArray(), 1.0) for _, _, v in data])
    y = np.array([classes.index(label) for _, label, _ in data])
    weight = np.array([len(y) / (len(classes) * (y == k).sum()) if balanced else 1.0 for k in range(len(classes))])
    found = []
    for k in range(len(classes)):
        own = y == k
        cost = c * np.where(own, weight[k], weight[y] if len(classes) == 2 else 1.0)
        found.append((newton(x, np.where(own, 1.0, -1.0), cost), x, np.where(own, 1.0, -1.0), cost))
    return found


@pytest.mark.parametrize("classes, c, balanced", [("abc", 1.0, False), ("abcd", 10.0, True), ("ab", 3.0, True), ("ab", 0.1, False)])
def test_objective_reaches_the_optimum(spark, monkeypatch, classes, c, balanced):
    monkeypatch.setattr(hinge, "PIECE", 7)
    classes = list(classes)
    data = rows(140, 9, classes, len(classes))
    features = stored_features(spark, data)
    head = hinge.squared_hinge_head(features, C=c, class_weight="balanced" if balanced else None, tolerance=1e-6)
    for k, (best, x, sign, cost) in enumerate(brute(data, classes, c, balanced)):
        assert objective(head.weights[:, k], x, sign, cost) <= objective(best, x, sign, cost) * (1 + 1e-6)
        assert np.allclose(head.weights[:, k], best, atol=1e-4)
    scores = {r["row_id"]: r["scores"] for r in head.predict(features).collect()}
    wanted = np.array([np.append(v.toArray(), 1.0) for _, _, v in data]) @ head.weights
    assert np.allclose([scores[k] for k in range(len(data))], wanted)


def stored_features(spark, data):
    return spark.createDataFrame(data, ["row_id", "label", "features"]).repartition(3)


def test_many_rows_at_once_or_few(spark, monkeypatch):
    data = rows(120, 6, list("abc"), 5)
    features = stored_features(spark, data)
    whole = hinge.squared_hinge_head(features, tolerance=1e-6).weights
    monkeypatch.setattr(hinge, "NONZEROS", 5)
    assert np.allclose(hinge.squared_hinge_head(features, tolerance=1e-6).weights, whole, atol=1e-5)


def test_separable_rows_and_a_saved_head(spark):
    data = [(k, "abc"["abc".index(c)], Vectors.dense([3.0 * (c == x) + 0.01 * (k % 7) for x in "abc"])) for k, c in enumerate("abc" * 30)]
    features = stored_features(spark, data)
    head = hinge.squared_hinge_head(features)
    found = head.predict(features)
    assert found.where("label <> y_pred").count() == 0
    assert [f for f in found.columns] == ["row_id", "label", "y_pred", "scores", "classes", "score_type"]
    path = new_path(spark, "svm")
    head.save(spark, path)
    again = hinge.SvmHead.load(spark, path).predict(features)
    assert again.exceptAll(found).count() == 0 and again.first()["score_type"] == "decision_function"


def test_one_class_and_no_rows(spark):
    one = stored_features(spark, [(1, "a", Vectors.dense([1.0, 2.0])), (2, "a", Vectors.dense([0.0, 1.0]))])
    assert {r["y_pred"] for r in hinge.squared_hinge_head(one).predict(one).collect()} == {"a"}
    none = one.where(F.lit(False))
    assert hinge.squared_hinge_head(one).predict(none).count() == 0
    assert hinge.squared_hinge_head(none).classes == []


def test_the_driver_holds_no_weights(spark, monkeypatch):
    monkeypatch.setattr(hinge, "LINEAGE", 3, raising=False)
    size, r = 400_000, random.Random(8)
    data = [(k, "abcde"[k % 5], Vectors.sparse(size, sorted(r.sample(range(size), 4)) + [size - 1], [0.1, 0.2, 0.3, 0.4, 0.1 * (k % 5)]))
            for k in range(40)]
    features = stored(stored_features(spark, data), "wide")
    tracemalloc.start()
    try:
        head = hinge.squared_hinge_head(features, tolerance=1e-2)
        scored = {x["row_id"]: x["scores"] for x in head.predict(features).collect()}
        assert tracemalloc.get_traced_memory()[1] < size * 5 * 8 / 2  # half of one columns x classes matrix
    finally:
        tracemalloc.stop()
    weights = head.weights
    assert weights.shape == (size + 1, 5)
    for k, _, v in data:
        assert np.allclose(scored[k], v.values @ weights[v.indices] + weights[-1])


def test_spark_heads_are_saved_too(spark):
    data = stored_features(spark, rows(60, 4, list("ab"), 3, sparse=False))
    path = new_path(spark, "head")
    head = heads.logistic_head(data)
    head.save(path)
    assert heads.Head.load(path).predict(data).exceptAll(head.predict(data)).count() == 0
    assert stored(head.predict(data).drop("features"), "p").count() == 61


def test_matrices_of_a_group_stay_where_they_are(spark):
    data = rows(60, 9, list("abc"), 4)
    features = stored_features(spark, data).selectExpr("row_id", "int(ascii(label) - 97) as y", "features")
    packs, parts = hinge.groups_of(features, 9, 600, ["row_id", "y"], 5)
    up, down, vectors = hinge.begin(packs, parts, 5, 3)
    said = spark.sparkContext.accumulator({}, hinge.Said())
    order = hinge.Order(np.zeros(3, bool), np.full(3, -1), np.zeros((21, 3)), np.zeros(3), np.ones(3, bool))
    after = dict(hinge.one_pass(up, down, vectors, order, said, parts, 5, np.ones(3), np.ones(3)).collect())
    assert said.value.keys() == after.keys()
    # what a pass hands on has a number per row and class, and none per nonzero
    assert all(x.size == 2 * len(v.y) * 3 for v in after.values() for x in (v.point, v.slope, v.step, v.trial_slope))
    pull, product = (np.concatenate([after[g].trial_slope[k] for g in sorted(after)]) for k in (0, 1))
    matrix = []
    for g, part in sorted(down.collect()):
        mine = np.zeros((len(part.shared.at) - 1, 10))
        for columns, some in ((dict(up.collect())[g].shared.columns, part.shared), (part.own.columns, part.own_rows)):
            row = np.repeat(np.arange(len(mine)), np.diff(some.at))
            mine[row, columns[some.index]] = some.value
        matrix.append(mine)
    matrix = np.concatenate(matrix)
    assert matrix.sum() == pytest.approx(sum(v.toArray().sum() + 1 for _, _, v in data))
    assert np.allclose(product, matrix @ (matrix.T @ pull))


def test_products_of_rows_without_numbers():
    at, index, value = np.array([0, 0, 2, 2, 3, 3]), np.array([0, 1, 1]), np.array([2.0, 3.0, 5.0])
    found = hinge.margins(at, index, value, np.array([[1.0, 10.0], [100.0, 1000.0]]))
    assert found.tolist() == [[0, 0], [302, 3020], [0, 0], [500, 5000], [0, 0]]
