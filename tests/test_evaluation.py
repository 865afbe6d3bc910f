import math
import random

import numpy as np
from pyspark.sql import functions as F

from labelscope.operators import confidence as cf
from labelscope.operators import metrics as mt
from labelscope.operators import significance as sg

ROWS = [("m", k, t, p) for k, (t, p) in enumerate(
    [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "unknown"), ("a", "a"), ("c", "a"), ("b", "c")])]
SCHEMA = "model_key string, row_id bigint, y_true string, y_pred string"


def python_metrics(pairs):
    labels = sorted({x for p in pairs for x in p})
    f1, support = {}, {}
    for c in labels:
        tp = sum(t == p == c for t, p in pairs)
        support[c] = sum(t == c for t, _ in pairs)
        f1[c] = 2 * tp / (support[c] + sum(p == c for _, p in pairs))
    n = len(pairs)
    return (sum(t == p for t, p in pairs) / n, sum(f1.values()) / len(f1), sum(f1[c] * support[c] for c in labels) / n)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    wanted = python_metrics([r[2:] for r in ROWS])
    row = mt.run_metrics(df, 12).first()
    assert np.allclose((row["accuracy"], row["macro_f1"], row["weighted_f1"]), wanted)
    report = {r["label"]: r for r in mt.class_report(df).collect()}
    assert report["unknown"]["f1"] == 0 and report["unknown"]["support"] == 0
    assert report["b"]["precision"] == round(2 / 3, 6) and report["b"]["recall"] == round(2 / 3, 6)
    cells = mt.confusion_matrix(df, normalise=True).collect()
    assert len(cells) == 16 and sum(r["n"] for r in cells) == len(ROWS)
    assert sum(r["share"] for r in cells if r["y_true"] == "unknown") == 0
    assert {(r["y_true"], r["y_pred"]) for r in mt.top_confusions(df, 2).collect()} == {("a", "b"), ("b", "c")}
    assert mt.unknown_rate(df).first()["n_unknown"] == 1


def test_kappa(spark):
    pairs = [("x", "x")] * 20 + [("x", "y")] * 5 + [("y", "x")] * 10 + [("y", "y")] * 15
    df = spark.createDataFrame(pairs, "a string, b string")
    assert mt.cohens_kappa(df).first()["kappa"] == 0.4
    assert mt.cohens_kappa(spark.createDataFrame([("x", "x")] * 3, "a string, b string")).first()["kappa"] == 1.0


def test_latency_drops_warmups(spark):
    log = [("f", k, 1000.0 if k < 5 else float(k)) for k in range(60)]
    df = spark.createDataFrame(log, "family string, seq int, latency_ms double")
    row = mt.latency_summary(df, ["seq"]).first()
    assert (row["n_measured"], row["latency_ms"]) == (30, 19.5)


def exact_p(low, n):
    if n == 0:
        return 1.0
    tail = sum(math.comb(n, k) for k in range(low + 1))
    return min(1.0, float(2 * tail / 2**n) if n < 1000 else 2 * math.exp(math.log(tail) - n * math.log(2)))


def test_binomial_p_values(spark):
    cases = [(0, 0), (0, 1), (1, 2), (3, 10), (5, 10), (20, 60), (450, 1000), (4800, 10000), (0, 50)]
    df = spark.createDataFrame(cases, "low bigint, n bigint")
    for r in df.select("low", "n", sg.binomial_two_sided(F.col("low"), F.col("n")).alias("p")).collect():
        assert math.isclose(r["p"], exact_p(r["low"], r["n"]), rel_tol=1e-9)


def test_mcnemar_counts_and_symmetry(spark):
    rng = random.Random(1)
    rows = [(m, k, "a", "a" if rng.random() < q else "b") for k in range(300) for m, q in (("A", 0.9), ("B", 0.6), ("C", 0.6))]
    df = spark.createDataFrame(rows, SCHEMA)
    ok = {(m, k): t == p for m, k, t, p in rows}
    got = {(r["model_a"], r["model_b"]): r for r in sg.mcnemar_pairs(df).collect()}
    assert set(got) == {("A", "B"), ("A", "C"), ("B", "C")}
    for (a, b), r in got.items():
        only_a = sum(ok[a, k] and not ok[b, k] for k in range(300))
        only_b = sum(ok[b, k] and not ok[a, k] for k in range(300))
        assert (r["only_a"], r["only_b"]) == (only_a, only_b)
        assert r["significant"] == (exact_p(min(only_a, only_b), only_a + only_b) < 0.05)
    same = spark.createDataFrame([(m, k, "a", "a") for m in "XY" for k in range(3)], SCHEMA)
    assert sg.mcnemar_pairs(same).first()["p_value"] == 1.0


def test_bootstrap_agrees_with_row_resampling(spark):
    rng = np.random.default_rng(0)
    rows, wanted = [], {}
    for model, n, hits in (("mid", 400, 300), ("all", 50, 50), ("none", 40, 0), ("one", 1, 1)):
        rows += [(model, k, "a", "a" if k < hits else "b") for k in range(n)]
        right = np.arange(n) < hits
        boot = np.array([right[rng.integers(0, n, n)].mean() for _ in range(4000)]) * 100
        wanted[model] = (hits / n * 100, np.percentile(boot, 2.5), np.percentile(boot, 97.5))
    for r in sg.bootstrap_ci(spark.createDataFrame(rows, SCHEMA), n_boot=2000).collect():
        acc, low, high = wanted[r["model_key"]]
        assert abs(r["accuracy_pct"] - acc) < 1e-5
        assert abs(r["low_pct"] - low) <= 0.6 and abs(r["high_pct"] - high) <= 0.6


def scored(spark, n=400, hot=False):
    rng = random.Random(3)
    rows = []
    for k in range(n):
        s = [1.0, 0.0, 0.0] if hot and k % 3 else [rng.random() for _ in range(3)]
        total = sum(s)
        rows.append(("m", k, rng.choice("abc"), [x / total for x in s], ["a", "b", "c"], "proba"))
    schema = "model_key string, row_id bigint, y_true string, scores array<double>, classes array<string>, score_type string"
    return spark.createDataFrame(rows, schema), rows


def test_topk_and_risk_coverage(spark):
    for hot in (False, True):
        df, rows = scored(spark, hot=hot)
        order = sorted(rows, key=lambda r: (-round(max(r[3]), 12), r[1]))
        right = [r[4][r[3].index(max(r[3]))] == r[2] for r in order]
        got = cf.risk_coverage(df).orderBy("step").collect()
        assert len(got) == 19
        for i, r in enumerate(got):
            m = max(1, math.floor((0.05 + i * 0.95 / 18) * len(rows) + 1e-9))
            assert (r["n_answered"], r["accuracy"]) == (m, round(sum(right[:m]) / m, 6))
        top = [r["topk_pct"] for r in cf.topk_accuracy(df, 3).orderBy("k").collect()]
        assert top == sorted(top) and top[-1] == 100.0
        assert abs(top[0] / 100 - got[-1]["accuracy"]) < 1e-6


def test_reliability_edges(spark):
    rows = [("m", k, "a", [c, 1 - c], ["a", "b"], "proba") for k, c in enumerate([1.0, 0.9, 0.5, 0.55, 0.95])]
    schema = "model_key string, row_id bigint, y_true string, scores array<double>, classes array<string>, score_type string"
    df = spark.createDataFrame(rows, schema)
    assert {r["bin"]: r["n"] for r in cf.reliability_bins(df).collect()} == {9: 3, 5: 2}
    assert cf.reliability_bins(df.withColumn("score_type", F.lit("logits"))).count() == 0


def test_calibration_repairs(spark):
    rng = random.Random(5)
    rows = [("m", k, c, int(rng.random() < c / 2)) for k, c in enumerate(rng.random() for _ in range(3000))]
    df = spark.createDataFrame(rows, "model_key string, row_id bigint, conf double, correct bigint")
    for method in ("isotonic", "platt"):
        got = cf.calibrate(df, method).orderBy("conf").collect()
        assert len(got) == len(rows)
        values = [r["calibrated"] for r in got]
        assert all(b >= a - 1e-9 for a, b in zip(values, values[1:]))
        assert abs(sum(values) / len(values) - sum(r[3] for r in rows) / len(rows)) < 0.02


def test_self_consistency_ties(spark):
    from labelscope.operators.labelling import self_consistency
    votes = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "c"), (2, "b")], "row_id bigint, y_pred string")
    assert {r["row_id"]: r["y_pred"] for r in self_consistency(votes).collect()} == {1: "b", 2: "b"}


def test_cascade_and_vote_keep_every_row(spark):
    rows = [("a", 1, "x", "x", ["x", "y"], [0.9, 0.1]), ("a", 2, "x", "x", ["x", "y"], [0.6, 0.4]), ("a", 3, "y", "x", ["x", "y"], None),
            ("a", 4, "y", "x", ["x", "y"], [0.55, 0.45]), ("b", 4, "y", "y", ["x", "y"], [0.1, 0.9]), ("b", 5, "y", "y", ["x", "y"], [0.2, 0.8])]
    df = spark.createDataFrame(rows, "model_key string, row_id bigint, y_true string, y_pred string, classes array<string>, scores array<double>")
    got = {r["row_id"]: (r["y_pred"], r["answered_by"]) for r in cf.cascade(df, "a", "b", 0.8).collect()}
    assert {k: v[1] for k, v in got.items()} == {1: "a", 2: "a", 3: "a", 4: "b"} and got[4][0] == "y" and got[2][0] == "x"
    voted = {r["row_id"]: r["y_pred"] for r in cf.soft_vote(df, "a", "b").collect()}
    assert set(voted) == {1, 2, 3, 4, 5} and voted[4] == "y" and voted[5] == "y"


def test_calibration_fits_on_one_part_and_keeps_all_digits_and_nulls(spark):
    ddl = "model_key string, row_id bigint, conf double, correct bigint"
    fit = spark.createDataFrame([("m", k, 0.5 + k / 1000, int(k > 250 or k % 3 == 0)) for k in range(500)], ddl)
    use = spark.createDataFrame([("m", 1, 0.99991, 1), ("m", 2, 0.99994, 0), ("m", 3, None, 1), ("m", 4, 0.1, 1)], ddl)
    got = {r["row_id"]: r["calibrated"] for r in cf.calibrate(use, "platt", fit).collect()}
    assert got[3] is None and got[4] < got[1] < got[2] < 1.0
    got = {r["row_id"]: r["calibrated"] for r in cf.calibrate(use, "isotonic", fit).collect()}
    assert got[3] is None and got[1] == got[2] == 1.0 and 0 < got[4] < 0.5


def max_min(points):
    """Isotonic regression by its formula: at i the largest over a <= i of the least mean of a..b over b >= i."""
    n = len(points)
    mean = lambda a, b: sum(h for _, _, h in points[a:b + 1]) / sum(w for _, w, _ in points[a:b + 1])
    return {points[i][0]: max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)}


def test_isotonic_steps_are_those_of_the_formula(spark):
    rng = random.Random(8)
    rows = [(m, k, round(c, 2), int(rng.random() < (c if m == "good" else 1 - c))) for m in ("good", "inverse")
            for k, c in enumerate(rng.random() for _ in range(400))] + [("one", 1, 0.5, 1), ("none", 1, None, 0)]
    df = spark.createDataFrame(rows, "model_key string, row_id bigint, conf double, correct bigint").repartition(7)
    got = {(r["model_key"], r["conf"]): r["calibrated"] for r in cf.calibrate(df).collect()}
    assert got[("none", None)] is None and got[("one", 0.5)] == 1.0
    for m in ("good", "inverse"):
        counts = {}
        for key, _, c, hit in rows:
            if key == m:
                w, h = counts.get(c, (0, 0))
                counts[c] = (w + 1, h + hit)
        for c, value in max_min([(c, *counts[c]) for c in sorted(counts)]).items():
            assert abs(got[(m, c)] - value) < 1e-12
    assert cf.isotonic_blocks(df).where("model_key = 'inverse'").count() < 8


def test_calibration_effect_on_other_rows(spark):
    rng = random.Random(9)
    rows = [("m", k, c, int(rng.random() < c * c)) for k, c in enumerate(rng.random() for _ in range(4000))]
    df = spark.createDataFrame(rows, "model_key string, row_id bigint, conf double, correct bigint")
    for method in ("isotonic", "platt"):
        found = cf.calibration_effect(cf.calibrate(df.where("row_id >= 1000"), method, df.where("row_id < 1000"))).first()
        assert found["n"] == 3000 and found["ece_after"] < 0.6 * found["ece_before"]
