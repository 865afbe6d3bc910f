import json

import pandas as pd
from pyspark.sql import functions as F

from labelscope.operators import labelling as lb
from labelscope.operators import profile as pr
from labelscope.runtime import new_path
from labelscope.sources import corpus as co
from labelscope.sources import runs as rn

ROWS = [
    (0, "Where is my card", "arrival", "train"), (1, " where is my CARD ", "arrival", "train"),
    (2, "where is my card", "arrival", "test"), (3, "card card lost", "lost", "train"),
    (4, "", "lost", "test"), (5, "Lost 2 cards {x} é", "lost", "test"), (6, "new label", "extra", "test"),
]
SCHEMA = "row_id bigint, text string, label string, split string"


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_distribution_counts_missing_sides(spark):
    got = {r["label"]: (r["train"], r["test"], r["train_pct"]) for r in pr.class_distribution(frame(spark)).collect()}
    assert got == {"arrival": (2, 1, 66.67), "lost": (1, 2, 33.33), "extra": (0, 1, 0.0)}


def test_duplicates_leakage_artefacts(spark):
    df = frame(spark)
    got = {r["split"]: r["duplicates"] for r in pr.exact_duplicates(df).collect()}
    assert got == {"train": 1, "test": 0}
    leaks = [tuple(r) for r in pr.split_leakage(df).collect()]
    assert leaks == [("where is my card", 2, 1)]
    assert pr.leakage_summary(pr.split_leakage(df)).first()["n_leaking"] == 1
    assert tuple(pr.artefact_flags(df).first()) == (1, 1, 1, 1)
    assert [(r["char"], r["code_point"], r["name"]) for r in pr.special_chars(df).collect()] == [
        ("é", 233, "LATIN SMALL LETTER E WITH ACUTE")]


def test_majority_ties_go_to_the_smallest_label(spark):
    df = spark.createDataFrame([(0, "b", "train"), (1, "a", "train"), (2, "a", "test"), (3, "b", "test"), (4, "b", "test")],
                               "row_id bigint, label string, split string")
    row = pr.majority_baseline(df).first()
    assert (row["label"], row["accuracy"], row["chance"]) == ("a", round(1 / 3, 6), 0.5)


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 9.9, 10, 10]], "x double")
    assert {r["bin"]: r["n"] for r in pr.histogram(df, "x", 10).collect()} == {0: 1, 1: 1, 2: 1, 9: 3}
    same = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert sum(r["n"] for r in pr.histogram(same, "x").collect()) == 4


def test_overlap_fills_with_zero_pairs(spark):
    rows = [(0, "red blue", "a"), (1, "red green", "b"), (2, "black", "c"), (3, "white", "d")]
    df = spark.createDataFrame(rows, "row_id bigint, text string, label string")
    got = [(r["label_a"], r["label_b"], r["jaccard"], r["shared_words"]) for r in pr.class_vocab_overlap(df, top=4).collect()]
    assert got == [("a", "b", round(1 / 3, 6), "red"), ("c", "d", 0.0, ""), ("b", "d", 0.0, ""), ("b", "c", 0.0, "")]
    assert pr.class_vocab_overlap(df, top=50).count() == 6


def test_context_window(spark):
    df = spark.createDataFrame([(n,) for n in range(1, 101)], "n_words bigint")
    row = pr.context_window_check(df, "n_words", (90,)).first()
    assert (row["p50"], row["p99"], row["max_len"], row["padded_len"]) == (50.5, 99.01, 100, 104)
    assert (row["truncated_pct"], row["over_90_pct"]) == (0.0, 10.0)


def test_data_checks(spark):
    got = {r["check_name"]: (r["violations"], r["passed"]) for r in pr.data_checks(frame(spark), ["arrival", "lost"], 18).collect()}
    assert got == {"empty_text": (1, False), "unknown_label": (1, False), "too_long": (0, True), "split_duplicates": (1, False)}


def test_sources_map_columns(spark):
    path = new_path(spark, "src")
    spark.createDataFrame([(1, "hi", 5)], "i int, utt string, intent int").write.parquet(path)
    spec = dict(name="s", path=path, split="train", id="i", text="utt", label="intent")
    assert [tuple(r) for r in co.union_sources(spark, [spec, {**spec, "split": "test"}]).collect()] == [
        ("s", split, '{"source":"s","split":"%s","row_id":1}' % split, "hi", "5") for split in ("train", "test")]
    profile = {r["split"]: r["n_rows"] for r in co.profile_corpus(frame(spark)).collect()}
    assert profile == {"train": 3, "test": 4, "all": 7}


def test_ids_of_sources_never_meet(spark):
    path, other = new_path(spark, "src"), new_path(spark, "src")
    spark.createDataFrame([(None, "no id", 1), (11, "x", 1), (1, "one", 1)], "i int, utt string, intent int").write.parquet(path)
    spark.createDataFrame([(1, "number", 1), (None, "none", 1)], "i int, utt string, intent int").write.parquet(other)
    spec = lambda name, split, path: dict(name=name, path=path, split=split, id="i", text="utt", label="intent")
    rows = co.union_sources(spark, [spec("a", "b/c", path), spec("a/b", "c", path), spec("a", 'b","row_id":"1', other), spec("z", "t", other)])
    assert rows.count() == 10 and rows.select("row_id").distinct().count() == 10
    assert rows.where("row_id is null").count() == 0


def test_registry_upsert_and_frontier(spark):
    schema = "model_key string, accuracy double, macro_f1 double, model string"
    old = spark.createDataFrame([("A_x", 0.5, None, None), ("B_y", 0.7, 0.6, "y")], schema)
    new = spark.createDataFrame([("A_x", 0.876543, 0.8, "x2")], schema)
    merged = rn.upsert_results(old, new)
    assert [(r["model_key"], r["accuracy"]) for r in merged.collect()] == [("A_x", 0.8765), ("B_y", 0.7)]
    board = rn.scoreboard(old).collect()
    assert [(r["model"], r["macro_f1_pct"]) for r in board] == [("y", 60.0), ("A_x", 0.0)]
    table = spark.createDataFrame([("s", 1.0, 80.0), ("m", 5.0, 79.0), ("l", 9.0, 90.0), ("n", None, 95.0)],
                                  "family string, params_mio double, accuracy_pct double")
    assert {r["family"]: r["on_frontier"] for r in rn.efficiency_frontier(table).collect()} == {"s": True, "m": False, "l": True}


def test_prediction_store_replaces_one_run(spark):
    path = new_path(spark, "preds")
    schema = "model_key string, row_id bigint, y_true string, y_pred string"
    rn.save_predictions(spark.createDataFrame([("a", 1, "x", "x"), ("b", 1, "x", "y")], schema), path)
    rn.save_predictions(spark.createDataFrame([("a", 1, "x", "z")], schema), path)
    assert {(r["model_key"], r["y_pred"]) for r in rn.load_predictions(spark, path).collect()} == {("a", "z"), ("b", "y")}
    assert rn.load_predictions(spark, path, ["b"]).count() == 1


def test_chat_lines_are_json(spark):
    path = new_path(spark, "chat")
    rn.export_chat_jsonl(frame(spark), "S \"q\"", path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert len(lines) == len(ROWS)
    assert {"messages": [{"role": "system", "content": 'S "q"'}, {"role": "user", "content": "card card lost"},
                         {"role": "assistant", "content": "lost"}]} in lines


def test_completion_is_cached_and_resumed(spark):
    path, calls = new_path(spark, "answers"), spark.sparkContext.accumulator(0)

    def completer(messages: pd.Series) -> pd.Series:
        calls.add(len(messages))
        return messages.map(lambda m: json.loads(m)[-1]["content"].upper() or None)

    make = lb.few_shot("Labels:\n", ["card", "lost"], [("demo", "card")])
    df = frame(spark)
    first = lb.classify(df.where("row_id in (2, 3)"), ["card", "lost"], make, completer, path, "m")
    assert {r["row_id"]: r["y_pred"] for r in first.collect()} == {2: "card", 3: "card"}
    assert calls.value == 2
    doubled = df.unionByName(df.withColumn("row_id", F.col("row_id") + 100))
    whole = {r["row_id"]: r["y_pred"] for r in lb.classify(doubled, ["card", "lost"], make, completer, path, "m").collect()}
    assert len(whole) == 14 and whole[4] == "unknown" and whole[105] == "card"
    assert calls.value == 7  # seven distinct texts in all


def test_keyword_classifier(spark):
    words = spark.createDataFrame([("lost", "lost"), ("arrival", "where"), ("arrival", "card"), ("arrival", "card")], "label string, word string")
    got = {r["row_id"]: r["y_pred"] for r in lb.keyword_classifier(frame(spark), words).collect()}
    assert got[0] == "arrival" and got[3] == "arrival" and got[5] == "lost" and got[4] == "unknown"


def test_misses(spark):
    df = spark.createDataFrame([(k, "r", "a", "b" if k % 2 else "a") for k in range(9)], "row_id bigint, raw string, y_pred string, gold string")
    assert [r["row_id"] for r in lb.misses(df, 3).collect()] == [1, 3, 5]


def test_waves_commit_everything_once(spark):
    path = new_path(spark, "waves")
    df = frame(spark)
    shout = lambda messages: messages.map(lambda m: json.loads(m)[-1]["content"].upper())
    got = lb.cached_completion(df, lb.zero_shot("S", ["a"]), shout, path, "m", rows_per_commit=2)
    assert {r["row_id"]: r["raw"] for r in got.collect()} == {r[0]: r[1].upper() for r in ROWS}
    assert spark.read.parquet(path).count() == len({r[1] for r in ROWS})


def test_evaluate_and_save_makes_versions(spark):
    root, store = new_path(spark, "registry"), new_path(spark, "store")
    schema = "model_key string, row_id bigint, y_true string, y_pred string, scores array<double>"
    details = lambda key: spark.createDataFrame([(key, "name", {"n": "1"})], "model_key string, model string, extra map<string,string>")
    save = lambda key, preds: rn.evaluate_and_save(
        spark.createDataFrame([(key, k, "x", p, [0.5]) for k, p in enumerate(preds)], schema), details(key), root, store)
    assert save("A", "xx").count() == 1
    table = save("B", "xy")
    assert [(r["model_key"], r["accuracy"]) for r in table.orderBy("model_key").collect()] == [("A", 1.0), ("B", 0.5)]
    assert {r["model_key"]: r["accuracy"] for r in save("A", "yy").collect()} == {"A": 0.0, "B": 0.5}
    assert rn.read_registry(spark, root)[0] == 3
    assert rn.list_models(rn.load_predictions(spark, store)).count() == 2


def test_repeated_cache_rows_do_not_repeat_answers(spark):
    path = new_path(spark, "twice")
    df = frame(spark)
    stub = lambda messages: messages.map(lambda m: "a")
    lb.cached_completion(df, lb.zero_shot("S", ["a"]), stub, path, "m")
    spark.read.parquet(path).limit(3).write.mode("append").parquet(path)  # as a second writer would
    assert lb.cached_completion(df, lb.zero_shot("S", ["a"]), stub, path, "m").count() == len(ROWS)
