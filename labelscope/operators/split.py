"""Stratified splits and samples with a reproducible order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelscope.functions.text import hash_number, seeded_hash
from labelscope.operators.selection import first_rows
from labelscope.runtime import ranked, stored


def class_quotas(counts: DataFrame, fraction: float) -> DataFrame:
    """Validation rows per class: floor of the share, the remainder to the largest rests.

    The total is ceil(fraction * n). Works on one row per class, in integers.
    """
    everything = Window.partitionBy()
    n = F.sum("n").over(everything)
    target = F.ceil(F.round(n * F.lit(fraction), 6)).cast("bigint")
    product = "cast(n as decimal(19, 0)) * cast(_target as decimal(19, 0))"  # too wide for bigint
    shares = counts.withColumn("_target", target).withColumn("_all", n).select(
        "label", "n", "_target",
        F.expr(f"({product}) div _all").alias("_base"),
        F.expr(f"({product}) % _all").alias("_rest"),
    )
    by_rest = Window.partitionBy().orderBy(F.desc("_rest"), "label")
    missing = F.col("_target") - F.sum("_base").over(everything)
    extra = (F.row_number().over(by_rest) <= missing).cast("bigint")
    return shares.select("label", "n", (F.col("_base") + extra).alias("quota"))


def stratified_split(
    corpus: DataFrame, fraction: float = 0.15, seed: int = 42, cell_digits: int = 4
) -> DataFrame:
    """Add ``part`` = 'val' for an exact stratified share of each label, else 'train'.

    Within a label, rows are taken in the order of a seeded hash, then id. Instead of
    sorting whole labels, a histogram of the hash prefix finds the cell where each
    quota ends, and only that cell (1/65536 of a label) is ordered to get the cut. The
    corpus itself is never shuffled: the cuts are one row per label.
    """
    keyed = corpus.select("label", "row_id", seeded_hash(F.col("row_id"), f":{seed}").alias("_h"))
    prefix = F.substring("_h", 1, cell_digits)
    cells = stored(
        keyed.groupBy("label", prefix.alias("_cell")).agg(F.count("*").alias("n")), "split-cells"
    )
    quotas = class_quotas(cells.groupBy("label").agg(F.sum("n").alias("n")), fraction)
    up_to = (
        Window.partitionBy("label").orderBy("_cell")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ends = (
        cells.withColumn("_upto", F.sum("n").over(up_to))
        .join(quotas.select("label", "quota"), "label")
        .where((F.col("_upto") >= F.col("quota")) & (F.col("_upto") - F.col("n") < F.col("quota")))
        .select("label", "_cell", (F.col("quota") - F.col("_upto") + F.col("n")).alias("_need"))
    )
    in_cell = keyed.withColumn("_cell", prefix).join(stored(ends, "split-ends"), ["label", "_cell"])
    order = Window.partitionBy("label").orderBy("_h", "row_id")
    cuts = (
        in_cell.withColumn("_at", F.row_number().over(order))
        .where(F.col("_at") == F.col("_need"))
        .select("label", F.struct("_h", "row_id").alias("_cut"))
    )
    own = F.struct(
        seeded_hash(F.col("row_id"), f":{seed}").alias("_h"), F.col("row_id").alias("row_id")
    )
    return (
        corpus.join(stored(cuts, "split-cuts"), "label", "left")
        .withColumn("part", F.when(own <= F.col("_cut"), "val").otherwise("train"))
        .drop("_cut")
    )


def seeded_order(corpus: DataFrame, seed: int) -> DataFrame:
    """(label, place, row_id): ``place`` is the number a label's rows are ordered by, then by row_id."""
    return corpus.select("label", hash_number(F.col("row_id"), f":{seed}").alias("place"), "row_id")


def head_cuts(corpus: DataFrame, heads: DataFrame, seed: int) -> DataFrame:
    """(label, _cut): the last of the first ``n`` rows of each label in seeded order; ``heads`` has (label, n), n >= 1."""
    cuts = first_rows(seeded_order(corpus, seed), heads.select("label", "n"), "label", ["place", "row_id"])
    return stored(cuts.select("label", F.col("cut").alias("_cut")), "head-cuts")


def own_place(seed: int) -> Column:
    return F.struct(hash_number(F.col("row_id"), f":{seed}").alias("place"), F.col("row_id").alias("row_id"))


def stratified_subsample(corpus: DataFrame, per_class: int, seed: int = 42) -> DataFrame:
    """``per_class`` seeded picks per label (all, if there are fewer), numbered by ``pick``, ordered by label.

    Where a label's quota ends is found by histograms of the order; only the picks themselves are
    ranked, by ranges. No label is sorted in one task, whatever ``per_class`` is.
    """
    sizes = corpus.groupBy("label").agg(F.least(F.count("*"), F.lit(per_class)).alias("n")).where("n > 0")
    picked = corpus.join(head_cuts(corpus, sizes, seed), "label").where(own_place(seed) <= F.col("_cut")).drop("_cut")
    placed = picked.withColumn("_place", hash_number(F.col("row_id"), f":{seed}"))
    return ranked(placed, ["label"], [F.col("_place"), F.col("row_id")], "pick").drop("_place").orderBy("label", "pick")


def resample(corpus: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """Rows with ``copy`` 1, 2, ..: every label brought to ``target`` rows, down by leaving rows out, up by repeats.

    ``targets`` has (label, target); labels without one are left out. With t = q n + r for a label of n rows,
    each row comes q times and the first r in seeded order once more. A label of which all rows come equally often
    needs no cut; the others take theirs from histograms.
    """
    sizes = corpus.groupBy("label").agg(F.count("*").alias("n"))
    shares = stored(sizes.join(targets.select("label", "target"), "label").select(
        "label", F.floor(F.col("target") / F.col("n")).cast("bigint").alias("_each"), F.pmod("target", "n").cast("bigint").alias("_more")
    ), "resample-shares")
    cuts = head_cuts(corpus, shares.where("_more > 0").select("label", F.col("_more").alias("n")), seed)
    once_more = F.coalesce(own_place(seed) <= F.col("_cut"), F.lit(False)).cast("bigint")
    counted = corpus.join(shares, "label").join(cuts, "label", "left").withColumn("_times", F.col("_each") + once_more)
    return counted.where("_times > 0").select(*corpus.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), "_times")).alias("copy"))


def balanced_targets(corpus: DataFrame, direction: str) -> DataFrame:
    """(label, target): the size of the smallest label ('under') or of the largest one ('over')."""
    extreme = {"under": F.min, "over": F.max}[direction]
    sizes = corpus.groupBy("label").agg(F.count("*").alias("n"))
    return sizes.select("label", extreme("n").over(Window.partitionBy()).alias("target"))  # one row per label


def exclude_holdout(corpus: DataFrame, holdout: DataFrame) -> DataFrame:
    """Rows whose (text, label) value does not occur in the holdout; copies go as well.

    Texts are compared by digest. The holdout's digests are stored: as long as they fit the
    broadcast threshold, the corpus is filtered in place.
    """
    key = F.sha2(F.to_json(F.struct("text", "label")), 256)
    held = stored(holdout.select(key.alias("_key")).distinct(), "holdout-keys")
    return corpus.withColumn("_key", key).join(held, "_key", "left_anti").drop("_key")


def stratified_folds(corpus: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1: rotating over the seeded order of each label."""
    keyed = corpus.select("label", "row_id", seeded_hash(F.col("row_id"), f":{seed}").alias("_h"))
    places = ranked(keyed, ["label"], [F.col("_h"), F.col("row_id")], "_rank")
    return places.select("label", "row_id", F.pmod(F.col("_rank") - 1, F.lit(k)).cast("bigint").alias("fold"))


def encode_labels(corpus: DataFrame, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    """(code table, coded corpus): sorted distinct train labels become 0..K-1.

    Test rows are mapped by the train codes; a label unseen in train gets null.
    """
    train = corpus.where(F.col(split_col) == "train").select("label").distinct()
    codes = stored(
        train.agg(F.array_sort(F.collect_set("label")).alias("all"))
        .select(F.posexplode("all").alias("label_id", "label"))
        .select("label", F.col("label_id").cast("bigint").alias("label_id")),
        "label-codes",
    )
    return codes, corpus.join(codes, "label", "left")


def decode_labels(coded: DataFrame, codes: DataFrame, id_col: str = "label_id") -> DataFrame:
    """Label name of a predicted code as ``decoded``."""
    names = codes.select(F.col("label_id").alias(id_col), F.col("label").alias("decoded"))
    return coded.join(names, id_col, "left")


def balanced_weights(corpus: DataFrame) -> DataFrame:
    """Weight n / (K * n_c) per label."""
    counts = corpus.groupBy("label").agg(F.count("*").alias("n"))
    everything = Window.partitionBy()
    classes = F.count("*").over(everything)
    weight = F.sum("n").over(everything) / (classes * F.col("n"))
    return counts.select("label", "n", weight.alias("weight"))
