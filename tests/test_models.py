import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelscope.operators import features as ft
from labelscope.operators.bayes import fit_multinomial_nb
from labelscope.operators import heads as hd
from labelscope.operators import hinge as hg
from labelscope.operators import metrics as mt
from labelscope.operators import neighbours as nn
from labelscope.operators import tuning as tn
from labelscope.runtime import new_path, stored

DOCS = [
    (0, "the card has not arrived yet", "arrival"), (1, "when will my card arrive", "arrival"),
    (2, "card delivery is late late late", "arrival"), (3, "the exchange rate is wrong", "rate"),
    (4, "which exchange rate applies", "rate"), (5, "cash machine kept my card", "atm"),
    (6, "the machine gave no cash", "atm"), (7, "rate rate rate", "rate"), (8, "no cash no card", "atm"),
]
TEST = [(100, "my card is late", "arrival"), (101, "wrong rate", "rate"), (102, "???", "atm"), (103, "cash machine", "atm")]
SCHEMA = "row_id bigint, text string, label string"


def tokens(text, low=1, high=1):
    words = re.findall(r"\b\w\w+\b", text.lower())
    return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def python_tfidf(train, rows, low=1, high=1, min_df=1, sub=False):
    df = {}
    for _, text, _ in train:
        for t in set(tokens(text, low, high)):
            df[t] = df.get(t, 0) + 1
    vocabulary = sorted(t for t, n in df.items() if n >= min_df)
    matrix = np.zeros((len(rows), len(vocabulary)))
    for i, (_, text, _) in enumerate(rows):
        for j, t in enumerate(vocabulary):
            tf = tokens(text, low, high).count(t)
            if tf:
                matrix[i, j] = (1 + math.log(tf) if sub else tf) * (math.log((1 + len(train)) / (1 + df[t])) + 1)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return vocabulary, np.divide(matrix, norms, out=matrix, where=norms > 0)


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame(DOCS, SCHEMA), spark.createDataFrame(TEST, SCHEMA)


@pytest.mark.parametrize("options", [{}, {"ngram_range": (1, 2)}, {"min_df": 2}, {"sublinear_tf": True}])
def test_tfidf(frames, options):
    train, test = frames
    model = ft.fit_tfidf(train, **options)
    low, high = options.get("ngram_range", (1, 1))
    vocabulary, matrix = python_tfidf(DOCS, TEST, low, high, options.get("min_df", 1), options.get("sublinear_tf", False))
    assert model.n_terms == len(vocabulary)
    got = {(r["row_id"], r["term"]): r["weight"] for r in model.transform(test).collect()}
    wanted = {(TEST[i][0], vocabulary[j]): matrix[i, j] for i, j in zip(*np.nonzero(matrix))}
    assert got.keys() == wanted.keys() and all(math.isclose(got[k], wanted[k]) for k in got)
    norms = {}
    for (row, _), w in got.items():
        norms[row] = norms.get(row, 0) + w * w
    assert all(math.isclose(x, 1.0) for x in norms.values())


@pytest.mark.parametrize("head,config", [
    ("multinomial", {}), ("multinomial", {"alpha": 0.1, "fit_prior": False}),
    ("complement", {}), ("complement", {"norm": True, "alpha": 0.5})])
def test_naive_bayes(frames, head, config):
    classes = sorted({d[2] for d in DOCS})
    _, x = python_tfidf(DOCS, DOCS)
    _, q = python_tfidf(DOCS, TEST)
    y = np.array([classes.index(d[2]) for d in DOCS])
    counts = np.array([x[y == c].sum(0) for c in range(len(classes))])
    alpha = config.get("alpha", 1.0)
    if head == "multinomial":
        smooth = counts + alpha
        weights = np.log(smooth) - np.log(smooth.sum(1, keepdims=True))
        prior = np.log(np.bincount(y) / len(y)) if config.get("fit_prior", True) else -np.log(len(classes))
        scores = q @ weights.T + prior
    else:
        comp = counts.sum(0) + alpha - counts
        logged = np.log(comp / comp.sum(1, keepdims=True))
        scores = q @ (logged / logged.sum(1, keepdims=True) if config.get("norm") else -logged).T
    got = {r["row_id"]: r for r in tn.bayes_predictions(*frames, config, head).collect()}
    for i, (row_id, _, _) in enumerate(TEST):
        assert np.allclose(got[row_id]["scores"], scores[i])
        assert got[row_id]["y_pred"] == classes[scores[i].argmax()]


def test_greedy_keeps_only_strict_gains(spark):
    table = {(): 0.5, ("a",): 0.5, ("b",): 0.6, ("b", "c"): 0.55, ("b", "d"): 0.7}
    calls = []

    def evaluate(config):
        calls.append(dict(config))
        return 0.9, table[tuple(sorted(config))]

    best, protocol = tn.greedy_search(spark, evaluate, [(k, {k: 1}) for k in "abcd"])
    assert best == {"b": 1, "d": 1} and len(calls) == 5
    rows = protocol.orderBy("round").collect()
    assert [r["kept"] for r in rows] == [True, False, True, False, True]
    assert tn.round_protocol(protocol).where("is_best").first()["step"] == "d"


def test_evaluator_equals_direct_predictions(frames):
    train, test = frames
    evaluate = tn.bayes_evaluator(train, test)
    for config in ({}, {"min_df": 2, "alpha": 0.1}, {"ngram_range": (1, 2), "sublinear_tf": True}):
        direct = mt.run_metrics(tn.bayes_predictions(train, test, config), 12).first()
        assert evaluate(config) == (direct["accuracy"], direct["macro_f1"])


def test_trial_logs(spark):
    log = [("x", 1, 0.5), ("x", 2, 0.7), ("x", 3, 0.6), ("x", 4, 0.65), ("x", 5, 0.9), ("y", 1, 0.7), ("y", 2, 0.8)]
    df = spark.createDataFrame(log, "run string, epoch bigint, val_f1 double")
    got = {r["run"]: (r["stop_epoch"], r["stopped_early"]) for r in tn.early_stop_epoch(df).collect()}
    assert got == {"x": (4, True), "y": (2, False)}
    best = tn.best_config(df).first()
    assert (best["run"], best["best_epoch"], best["refit_epochs"]) == ("x", 5, 5)


def brute_force(queries, base, k, exclude_self):
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=m.copy(), where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
    sims = np.round(unit(queries[1]) @ unit(base[1]).T, 9) + 0.0
    out = {}
    for i, q in enumerate(queries[0]):
        order = sorted((-s, b) for s, b in zip(sims[i], base[0]) if not (exclude_self and b == q))
        out[int(q)] = [int(b) for _, b in order[:k]]
    return out


@pytest.mark.parametrize("shape", ["clusters", "copies", "random", "tiny", "zeros", "nothing"])
@pytest.mark.parametrize("exclude_self", [True, False])
def test_nearest_is_exact(spark, shape, exclude_self):
    rng = np.random.default_rng(7)
    n = 4 if shape == "tiny" else 300
    v = rng.normal(size=(n, 6))
    if shape == "clusters":
        v = np.eye(6)[rng.integers(0, 6, n)] * 5 + v * 0.05
    if shape == "copies":
        v[: n // 3] = v[0]  # a third of all rows is one vector
        v[-3:] = 0.0
    if shape in ("zeros", "nothing"):  # a third of all rows, or all of them, are zero vectors
        v[rng.permutation(n)[: n // 3 if shape == "zeros" else n]] = 0.0
    ids = np.arange(n)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": ids, "v": list(v), "label": [f"c{i % 3}" for i in ids]}),
                               "vec_id bigint, v array<double>, label string")
    found = nn.nearest(df.select("vec_id", "v"), df, 5, exclude_self, block_rows=40).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["place"])):
        got.setdefault(r["query_id"], []).append(r["neighbour_id"])
    wanted = brute_force((ids, v), (ids, v), 5, exclude_self)
    assert got == wanted


def test_misfits(spark):
    rows = [(k, [1.0, k / 100], "a") for k in range(12)] + [(50, [1.0, 0.055], "b")] + [(60 + k, [k / 100, 1.0], "b") for k in range(12)]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<double>, label string")
    assert [(r["vec_id"], r["majority"]) for r in nn.misfits(df, "e", 5).collect()] == [(50, "a")]


def blobs(spark, n=240):
    rng = random.Random(2)
    centre = {"a": (2, 0), "b": (-2, 1), "c": (0, -2)}
    rows = [(k, c, [centre[c][0] + rng.gauss(0, 0.6), centre[c][1] + rng.gauss(0, 0.6)]) for k, c in ((k, "abc"[k % 3]) for k in range(n))]
    return spark.createDataFrame(rows, "vec_id bigint, label string, v array<double>")


def test_heads_beat_the_majority(spark):
    df = blobs(spark)
    features = stored(ft.dense_features(df, "v", ("vec_id", "label")).coalesce(1), "blobs")
    heads = [hd.logistic_head(features, C=10, class_weight="balanced"), hg.squared_hinge_head(features),
             hd.sgd_head(features, loss="log_loss"), hd.forest_head(features)]
    for head in heads:
        got = head.predict(features)
        share = got.agg(F.avg((F.col("label") == F.col("y_pred")).cast("int"))).first()[0]
        assert share > 0.9 and head.classes == ["a", "b", "c"]
        assert got.where(F.size("scores") != 3).count() == 0
    assert heads[0].score_type == "proba" and heads[1].score_type == "decision_function"
    table = hd.head_comparison(df, df, {"logreg": hd.logistic_head}, knn_k=5).collect()
    assert {r["model_key"] for r in table} == {"logreg", "knn_5"} and min(r["macro_f1"] for r in table) > 0.9
    with pytest.raises(ValueError):
        hd.sgd_head(features, loss="other")


def test_logistic_head_minimises_the_stated_objective(spark):
    """Gradient of w'w / 2 + C * sum(loss) vanishes at the fitted weights."""
    df = blobs(spark, 90)
    c = 0.7
    head = hd.logistic_head(ft.dense_features(df, "v", ("label",)), C=c, max_iter=500)
    model = head.model.stages[0]
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = df.collect()
    x = np.array([r["v"] for r in rows])
    y = np.eye(3)[[head.classes.index(r["label"]) for r in rows]]
    z = x @ w.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    assert np.abs(w + c * (p - y).T @ x).max() < 0.05


def test_sparse_features_match_weights(frames):
    train, _ = frames
    model = ft.fit_tfidf(train)
    weights = model.transform(train, ("label",))
    made = ft.sparse_features(weights, model, ("label",)).collect()
    vocabulary, matrix = python_tfidf(DOCS, DOCS)
    for r in made:
        assert np.allclose(r["features"].toArray(), matrix[r["row_id"]])
    hashed = ft.sparse_features(weights, model, ("label",), hash_buckets=8).collect()
    assert all(r["features"].size == 8 for r in hashed)


def test_projection_and_regions(spark):
    df = blobs(spark)
    coords = hd.project_vectors(df, 2)
    first = coords.first()
    assert len(first["coords"]) == 2
    flat = coords.select(F.col("coords")[0].alias("x"), F.col("coords")[1].alias("y"), "label")
    grid = hd.decision_regions(flat, steps=20)
    assert grid.count() == 400 and {r[0] for r in grid.select("label").distinct().collect()} == {"a", "b", "c"}
    low, high = flat.agg(F.min("x"), F.max("x")).first()
    edge = grid.agg(F.min("x"), F.max("x")).first()
    assert math.isclose(edge[0], low - 3) and math.isclose(edge[1], high + 3)


def test_embedding_cache_encodes_each_text_once(spark):
    docs = spark.createDataFrame([(1, "one text", "a"), (2, "one text", "b"), (3, "other", "a"), (4, "", "a")], SCHEMA)
    path, seen = new_path(spark, "cache"), new_path(spark, "seen")

    def encoder(texts):
        import os
        os.makedirs(seen.removeprefix("file:"), exist_ok=True)
        for t in texts:
            name = f"{seen.removeprefix('file:')}/{t or 'empty'}"
            assert not os.path.exists(name)
            open(name, "w").close()
        return [np.array([3.0, 4.0]) if t else np.zeros(2) for t in texts]

    first = ft.embed_corpus_cached(docs.where("row_id < 3"), path, encoder, "e")
    assert [r["v"] for r in first.collect()] == [[0.6, 0.8]] * 2
    both = {r["row_id"]: r["v"] for r in ft.embed_corpus_cached(docs, path, encoder, "e").collect()}
    assert both[4] == [0.0, 0.0] and len(both) == 4


def test_neighbours_at_ties_of_nine_digits(spark):
    """Two groups of copies 2.5e-5 apart: all similarities are equal, so the smallest ids win."""
    near = [math.cos(2.5e-5), math.sin(2.5e-5)]
    rows = [(k, [1.0, 0.0], "a") for k in range(60)] + [(100 + k, near, "b") for k in range(60)]
    base = spark.createDataFrame(rows, "vec_id bigint, v array<double>, label string")
    query = spark.createDataFrame([(900, near, "b")], "vec_id bigint, v array<double>, label string")
    found = nn.nearest(query.select("vec_id", "v"), base, 5).collect()
    assert sorted(r["neighbour_id"] for r in found) == [0, 1, 2, 3, 4]


def test_ids_of_different_sources_stay_apart(spark, tmp_path):
    from labelscope.operators.profile import split_leakage
    from labelscope.sources.corpus import union_sources

    for name, texts in (("one", ["same text", "other"]), ("two", ["only here", "Same text"])):
        spark.createDataFrame([(k, t, "l") for k, t in enumerate(texts)], "id bigint, text string, label string").write.parquet(f"{tmp_path}/{name}")
    spec = lambda name, split: dict(name=name, split=split, path=f"{tmp_path}/{name}", id="id", text="text", label="label")
    rows = union_sources(spark, [spec("one", "train"), spec("two", "test")])
    assert rows.select("row_id").distinct().count() == 4
    weights = ft.fit_tfidf(rows).transform(rows)
    assert weights.select("row_id").distinct().count() == 4
    assert [tuple(r) for r in split_leakage(rows).collect()] == [("same text", 1, 1)]
    shared_ids = rows.withColumn("row_id", F.get_json_object("row_id", "$.row_id"))
    assert [tuple(r) for r in split_leakage(shared_ids).collect()] == [("same text", 1, 1)]


def test_parts_that_count_terms_follow_the_size_of_the_texts(spark):
    # 24 MB of text that a shuffle squeezes to a fraction: merged by that size, one task would count all of it
    rows = spark.range(240).select(
        F.col("id").alias("row_id"), F.lit("x").alias("label"),
        F.array_join(F.transform(F.sequence(F.lit(0), F.lit(9_999)), lambda i: F.concat(F.lit("a"), F.lpad((i % 200).cast("string"), 8, "0"))), " ").alias("text"),
    )
    counts = ft.term_counts(rows, ft.TfidfOptions(), ("label",))
    parts = counts.groupBy(F.spark_partition_id()).agg(F.countDistinct("row_id").alias("n"), F.sum("tf").alias("tf")).collect()
    assert sum(r["n"] for r in parts) == 240 and sum(r["tf"] for r in parts) == 2_400_000
    assert max(r["n"] for r in parts) <= 100


def test_small_cells_travel_in_bundles(spark):
    # 1024 cells of 60 vectors and one of 900 in three parts: a query came once for each of them
    count, parts = np.array([60] * 1024 + [900]), np.array([1] * 1024 + [3])
    found = nn.bundled(count, parts, np.random.default_rng(1).permutation(1025), 400)
    held = np.bincount(found[:-1], count[:-1])
    assert held.max() <= 400 and len(set(found[:-1])) <= 1024 * 60 / 300
    assert not set(found[:-1]) & set(range(found[-1], found[-1] + 3))

    # many cells to a bundle, queries outside of the base, and cells in parts: the same neighbours as brute force
    rng = np.random.default_rng(2)
    rows = np.round(rng.normal(size=(900, 6)), 3)
    rows[400:] = rows[400] + np.round(rng.normal(size=(500, 6)), 3) / 1000
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    frame = spark.createDataFrame([(k, v.tolist(), "a") for k, v in enumerate(rows)], "vec_id long, v array<double>, label string")
    got = {}
    for r in nn.nearest(frame.where("vec_id % 3 = 0").select("vec_id", "v"), frame.where("vec_id % 3 > 0"), 4, block_rows=90).orderBy("place").collect():
        got.setdefault(r["query_id"], []).append(r["neighbour_id"])
    base = [k for k in range(900) if k % 3]
    for q in range(0, 900, 3):
        near = np.round(unit[base] @ unit[q], nn.DIGITS)
        assert got[q] == [base[j] for j in np.lexsort((base, -near))[:4]]


def test_rows_meet_the_vocabulary_in_their_part(spark, monkeypatch):
    monkeypatch.setattr(ft, "TEXT_BYTES", 200)
    train = spark.createDataFrame([(k, f"aa w{k % 7} w{k % 5} w{k % 5}", "xy"[k % 2]) for k in range(60)], "row_id long, text string, label string")
    test = spark.createDataFrame([(1, "w1 w2 aa w1"), (2, "unseen words"), (3, None), (None, "aa w3"), (4, "w4"), (4, "w6 w4")], "row_id long, text string")
    model = ft.fit_tfidf(train)
    fitted = fit_multinomial_nb(model.transform(train, ("label",)), train.select("row_id", "label"), n_terms=model.n_terms)
    counts = stored(ft.term_counts(train, model.options, ("label",)), "terms")
    assert counts.select("part").distinct().count() > 3
    assert counts.groupBy("row_id").agg(F.countDistinct("part").alias("n")).where("n > 1").isEmpty()
    found = lambda df: sorted((str(r["row_id"]), r["y_pred"], [round(x, 9) for x in r["scores"]]) for r in df.collect())
    for rows in (train, test):
        cut = stored(ft.term_counts(rows, model.options, ("label",) if rows is train else ()), "terms")
        assert found(fitted.predict_counts(rows, cut, model)) == found(fitted.predict(rows, model.transform(rows)))
    norms = model.weigh(stored(ft.term_counts(test, model.options), "terms")).groupBy("row_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    assert sorted((str(r["row_id"]), round(r["n"], 9)) for r in norms.collect()) == [("1", 1.0), ("4", 1.0), ("None", 1.0)]


def test_every_group_of_parts_has_a_task_of_its_own(spark, monkeypatch):
    from pyspark.sql import types as T
    monkeypatch.setattr(ft, "GROUPED", 1)
    rows = stored(spark.range(400).select(F.col("id").alias("row_id"), F.concat(F.lit("t"), F.col("id") % 7).alias("term"),
                                          F.lit(1).cast("bigint").alias("tf"), (F.col("id") % 40).cast("int").alias("part")), "rows")
    table = rows.select("term").distinct().withColumn("idf", F.lit(1.0))

    def where(found, answers):
        import pyarrow as pa
        from pyspark import TaskContext
        return pa.table({"task": [TaskContext.get().partitionId()], "n": [len(found)]})

    kind = T.StructType([T.StructField("task", T.LongType()), T.StructField("n", T.LongType())])
    found = ft.meet(rows, table, kind, where).collect()
    assert len({r["task"] for r in found}) == len(found) == 40 and {r["n"] for r in found} == {10}


@pytest.mark.parametrize("again", [[], [(0, "card card rate", "arrival"), (None, "no card", "atm"), (None, "late", "atm")]])
def test_texts_are_cut_once(spark, monkeypatch, again):
    rows = stored(spark.createDataFrame([*DOCS, *TEST, *again], SCHEMA), "rows")
    learn = F.coalesce(F.col("row_id") < 100, F.lit(True))
    wanted = ft.fit_tfidf(rows.where(learn), ngram_range=(1, 2)).transform(rows).collect()
    cut, real = [], ft.terms
    monkeypatch.setattr(ft, "terms", lambda options: cut.append(1) or real(options))
    model, found = ft.fit_transform_tfidf(rows, learn, ngram_range=(1, 2))
    key = lambda r: (str(r["row_id"]), r["term"])
    found = sorted(found.collect(), key=key)
    assert [key(r) for r in found] == sorted(map(key, wanted))
    assert [r["weight"] for r in found] == pytest.approx([r["weight"] for r in sorted(wanted, key=key)])
    assert model.n_docs == len(DOCS) + len(again) and len(cut) == (2 if again else 1)
