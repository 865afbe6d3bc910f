import hashlib
import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelscope.operators import selection as sl
from labelscope.operators import split as sp
from labelscope.runtime import ranked, scratch, shared_folder, stored


def corpus(spark, sizes):
    rows = [(k, f"t{k % 7}", label) for k, label in enumerate(l for l, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "row_id bigint, text string, label string"), rows


def key(row_id, seed=42):
    return hashlib.md5(f"{row_id}:{seed}".encode()).hexdigest()[:8], row_id


def expected_quotas(sizes, fraction):
    n = sum(sizes.values())
    target = math.ceil(round(n * fraction, 6))
    base = {c: k * target // n for c, k in sizes.items()}
    rest = sorted(sizes, key=lambda c: (-(sizes[c] * target % n), c))
    for c in rest[: target - sum(base.values())]:
        base[c] += 1
    return base


def test_stratified_split_is_exact_with_a_hot_label(spark):
    sizes = {"hot": 700, "b": 101, "c": 33, "tiny": 1}
    df, rows = corpus(spark, sizes)
    for digits in (1, 2, 4):
        got = sp.stratified_split(df.repartition(5), 0.15, cell_digits=digits)
        val = {r["row_id"] for r in got.where("part = 'val'").collect()}
        wanted = set()
        for label, quota in expected_quotas(sizes, 0.15).items():
            wanted |= set(sorted((r[0] for r in rows if r[2] == label), key=key)[:quota])
        assert val == wanted and len(val) == math.ceil(0.15 * len(rows))
        assert got.count() == len(rows)


def test_subsample_and_holdout(spark):
    df, rows = corpus(spark, {"a": 20, "b": 1})
    picks = sp.stratified_subsample(df, 3)
    assert Counter(r["label"] for r in picks.collect()) == {"a": 3, "b": 1}
    held = {(r["text"], r["label"]) for r in picks.collect()}
    rest = sp.exclude_holdout(df, picks).collect()
    assert {r["row_id"] for r in rest} == {r[0] for r in rows if (r[1], r[2]) not in held}


def test_folds_rotate(spark):
    df, _ = corpus(spark, {"a": 23, "b": 9})
    counts = Counter((r["label"], r["fold"]) for r in sp.stratified_folds(df, 4).collect())
    assert all(abs(counts[("a", f)] - 23 / 4) < 1 and abs(counts[("b", f)] - 9 / 4) < 1 for f in range(4))


def test_encode_uses_train_labels_only(spark):
    rows = [(1, "b", "train"), (2, "a", "train"), (3, "c", "test"), (4, "a", "test")]
    df = spark.createDataFrame(rows, "row_id bigint, label string, split string")
    codes, coded = sp.encode_labels(df)
    got = {r["row_id"]: (r["label_id"], r["decoded"]) for r in sp.decode_labels(coded, codes).collect()}
    assert got == {1: (1, "b"), 2: (0, "a"), 3: (None, None), 4: (0, "a")}


def test_ranked_equals_sorting(spark):
    rows = [("hot", k * 37 % 11, k) for k in range(500)] + [("b", 1, 1000), ("b", 0, 1001)]
    df = spark.createDataFrame(rows, "g string, x int, i int").repartition(7)
    got = {(r["g"], r["i"]): r["place"] for r in ranked(df, ["g"], [F.desc("x"), F.col("i")], "place").collect()}
    for g in ("hot", "b"):
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [got[(g, r[2])] for r in order] == list(range(1, len(order) + 1))


def test_broadcast_plans(spark, capsys):
    df, _ = corpus(spark, {"a": 50, "b": 5})
    sp.stratified_split(df).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_subsample_sorts_no_label_in_one_task(spark, capsys, monkeypatch):
    df, rows = corpus(spark, {"a": 900, "b": 5})
    monkeypatch.setattr(sl, "FEW", 20)
    monkeypatch.setattr(sl, "BINS", 8)
    picks = sp.stratified_subsample(df, 500)
    wanted = {c: sorted((r[0] for r in rows if r[2] == c), key=key)[:500] for c in "ab"}
    for c, ids in wanted.items():
        got = [(r["pick"], r["row_id"]) for r in picks.where(f"label = '{c}'").orderBy("pick").collect()]
        assert got == list(enumerate(ids, 1))
    picks.explain()
    assert "Window" not in capsys.readouterr().out


@pytest.mark.parametrize("few, bins", [(4, 4), (1 << 15, 1 << 12)])
def test_selection_at_ties_and_hot_keys(spark, monkeypatch, few, bins):
    monkeypatch.setattr(sl, "FEW", few)
    monkeypatch.setattr(sl, "BINS", bins)
    r = random.Random(few)
    table = [("hot", r.choice([0.5, 0.5, 0.5, r.random()]), k, r.random() < 0.5) for k in range(400)]
    table += [("one", 3.0, 7, True)] + [("same", 1.0, 10**17 + k, k % 2 == 0) for k in range(60)]
    df = spark.createDataFrame([(g, x, k, int(v)) for g, x, k, v in table], "g string, x double, id bigint, v int")
    wanted = [("hot", 1), ("hot", 37), ("hot", 250), ("hot", 400), ("one", 1), ("same", 1), ("same", 33), ("same", 60)]
    got = sl.first_rows(df, spark.createDataFrame(wanted, "g string, n int"), "g", ["x", "id"], "v").collect()
    found = {(row["g"], row["n"]): (row["hits"], row["cut"]["x"], row["cut"]["id"]) for row in got}
    for g, n in wanted:
        order = sorted((x, k, v) for h, x, k, v in table if h == g)
        assert found[g, n] == (sum(v for _, _, v in order[:n]), *order[n - 1][:2])


def test_resampling_meets_its_targets(spark):
    df, rows = corpus(spark, {"a": 70, "b": 9, "c": 1})
    for direction, size in (("under", 1), ("over", 70)):
        got = sp.resample(df, sp.balanced_targets(df, direction)).collect()
        counts = {}
        for r in got:
            counts.setdefault(r["label"], []).append((r["row_id"], r["copy"]))
        assert {c: len(x) for c, x in counts.items()} == dict.fromkeys("abc", size)
        assert all(len(set(x)) == size for x in counts.values())
    targets = spark.createDataFrame([("a", 30), ("b", 25), ("zzz", 4)], "label string, target bigint")
    got = sp.resample(df, targets).groupBy("label").agg(F.count("*").alias("n"), F.countDistinct("row_id").alias("d"), F.max("copy").alias("top")).collect()
    assert {tuple(r) for r in got} == {("a", 30, 30, 1), ("b", 25, 9, 3)}
    assert sp.resample(df.where("false"), targets).count() == 0


def test_stored_table_lies_in_the_shared_folder(spark):
    table = stored(spark.range(3).withColumn("v", F.array(F.lit(1.5))), "probe")
    assert table.count() == 3
    assert shared_folder(spark).split(":")[-1] in table.inputFiles()[0]


def test_scratch_tables_go_at_the_end(spark):
    outside = stored(spark.range(4), "outside")
    with scratch(spark):
        inside = stored(spark.range(3), "inside")
        path = inside.inputFiles()[0].split(":")[-1]
        assert inside.count() == 3 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path)) and outside.count() == 4
    with pytest.raises(ValueError), scratch(spark):
        path = stored(spark.range(2), "failed").inputFiles()[0].split(":")[-1]
        raise ValueError
    assert not os.path.exists(path)
