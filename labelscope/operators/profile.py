"""Corpus profile: class sizes, lengths, vocabulary, duplicates, artefacts, baseline."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelscope.functions import text as tx
from labelscope.runtime import stored


def class_distribution(corpus: DataFrame) -> DataFrame:
    """Rows per label in train and test (0 if absent) and the label's share of train in %."""
    train = F.count_if(F.col("split") == "train")
    counts = corpus.groupBy("label").agg(
        train.alias("train"), F.count_if(F.col("split") == "test").alias("test")
    )
    total = F.sum("train").over(Window.partitionBy())
    return counts.withColumn("train_pct", F.round(F.col("train") / total * 100, 2))


def class_size_extremes(distribution: DataFrame, n: int = 5) -> DataFrame:
    """The n largest and n smallest classes by train size."""
    distribution = stored(distribution, "class-sizes")  # one row per class, read twice
    largest = distribution.orderBy(F.desc("train"), "label").limit(n)
    smallest = distribution.orderBy("train", "label").limit(n)
    side = lambda df, name: df.select(F.lit(name).alias("side"), "label", "train", "test")
    return side(largest, "largest").unionByName(side(smallest, "smallest"))


def class_size_summary(distribution: DataFrame) -> DataFrame:
    """Min, median (truncated) and max class size per split."""
    sizes = distribution.select(
        F.explode(
            F.create_map(F.lit("train"), F.col("train"), F.lit("test"), F.col("test"))
        ).alias("split", "n")
    )
    return sizes.groupBy("split").agg(
        F.min("n").alias("min_n"),
        F.floor(F.percentile("n", F.lit(0.5))).cast("bigint").alias("median_n"),
        F.max("n").alias("max_n"),
    )


def text_lengths(corpus: DataFrame) -> DataFrame:
    return corpus.select(
        "row_id", "label",
        tx.word_count(F.col("text")).alias("n_words"),
        tx.char_count(F.col("text")).alias("n_chars"),
    )


def length_summary(lengths: DataFrame) -> DataFrame:
    """Min, median and max of words and of characters."""
    long = lengths.select(
        F.explode(
            F.create_map(F.lit("words"), F.col("n_words"), F.lit("chars"), F.col("n_chars"))
        ).alias("measure", "n")
    )
    return long.groupBy("measure").agg(
        F.min("n").alias("min_n"),
        F.percentile("n", F.lit(0.5)).alias("median_n"),
        F.max("n").alias("max_n"),
    )


def median_length_by_class(lengths: DataFrame, n: int = 5) -> DataFrame:
    """The n classes with the shortest and the longest median word count."""
    medians = stored(
        lengths.groupBy("label").agg(F.percentile("n_words", F.lit(0.5)).alias("median_words")),
        "median-words",
    )
    shortest = medians.orderBy("median_words", "label").limit(n)
    longest = medians.orderBy(F.desc("median_words"), "label").limit(n)
    side = lambda df, name: df.select(F.lit(name).alias("side"), "label", "median_words")
    return side(shortest, "shortest").unionByName(side(longest, "longest"))


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Counts in equal-width bins over [min, max]; the last bin is closed. Empty bins are left out."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        low = high = 0.0
    if low == high:  # one value: a unit-wide range around it
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("bigint")
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1).cast("bigint")).alias("bin"))
        .agg(F.count("*").alias("n"))
        .withColumn("bin_low", F.lit(low) + F.col("bin") * F.lit(width))
    )


def words(corpus: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    """(row_id, label, word), one row per token."""
    tokens = tx.tokenise_alpha(F.col("text"))
    if stop_words is not None:
        tokens = tx.drop_stopwords(tokens, list(stop_words))
    return corpus.select("row_id", "label", F.explode(tokens).alias("word"))


def word_counts(corpus: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    return words(corpus, stop_words).groupBy("word").agg(F.count("*").alias("n"))


def vocabulary_top(counts: DataFrame, top: int = 15) -> DataFrame:
    """The most frequent words with the size of the whole vocabulary beside them.

    The counts are stored, so the texts are cut into words once.
    """
    counts = stored(counts, "word-counts")
    totals = counts.agg(F.struct(F.sum("n").alias("tokens"), F.count("*").alias("words"))).scalar()
    return (
        counts.orderBy(F.desc("n"), "word").limit(top)
        .withColumn("_t", totals)
        .select("word", "n", F.col("_t.tokens").alias("total_tokens"), F.col("_t.words").alias("distinct_tokens"))
    )


def hapax_share(counts: DataFrame) -> DataFrame:
    """Words seen once and their share of the vocabulary."""
    return counts.agg(
        F.count("*").alias("vocabulary"),
        F.count_if(F.col("n") == 1).alias("hapax"),
        F.round(F.count_if(F.col("n") == 1) / F.count("*") * 100, 6).alias("hapax_pct"),
    )


def top_words_by_class(
    corpus: DataFrame, k: int = 8, stop_words: Sequence[str] | None = None
) -> DataFrame:
    """k most frequent words per label; each task keeps k per label before the shuffle."""
    counts = words(corpus, stop_words).groupBy("label", "word").agg(F.count("*").alias("n"))
    order = Window.partitionBy("label").orderBy(F.desc("n"), "word")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def class_vocab_overlap(
    corpus: DataFrame, k: int = 15, top: int = 10, stop_words: Sequence[str] | None = None
) -> DataFrame:
    """Jaccard overlap of the top-k word sets of two labels, highest first.

    Only label-sized data is paired: at most k words per label, matched on the word.
    Label pairs without a shared word score 0 and can only fill the list behind the
    sharing pairs. In list order (both labels descending) the first of them lie among the
    last few labels, so only these are paired up.
    """
    best = stored(top_words_by_class(corpus, k, stop_words).select("label", "word"), "top-words")
    sizes = best.groupBy("label").agg(F.count("*").alias("n"))
    a = best.select(F.col("label").alias("label_a"), "word")
    b = best.select(F.col("label").alias("label_b"), "word")
    sharing = (
        a.join(b, "word").where("label_a < label_b")
        .groupBy("label_a", "label_b")
        .agg(F.count("*").alias("shared"), F.array_sort(F.collect_list("word")).alias("_words"))
    )
    few = math.isqrt(4 * top) + 3  # few * (few - 1) / 2 > 2 * top pairs
    last = sizes.orderBy(F.desc("label")).limit(few).agg(F.collect_list("label").alias("_all"))
    fill = (
        last.select(F.explode("_all").alias("label_a"), "_all")
        .select("label_a", F.explode("_all").alias("label_b"))
        .where("label_a < label_b")
        .join(sharing, ["label_a", "label_b"], "left_anti")
        .withColumn("shared", F.lit(0).cast("bigint"))
        .withColumn("_words", F.array().cast("array<string>"))
    )
    size_a = sizes.select(F.col("label").alias("label_a"), F.col("n").alias("n_a"))
    size_b = sizes.select(F.col("label").alias("label_b"), F.col("n").alias("n_b"))
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return (
        sharing.unionByName(fill)
        .join(size_a, "label_a")
        .join(size_b, "label_b")
        .select(
            "label_a", "label_b", "shared",
            F.round(F.col("shared") / union, 6).alias("jaccard"),
            F.array_join("_words", ", ").alias("shared_words"),
        )
        .orderBy(F.desc("jaccard"), F.desc("label_a"), F.desc("label_b"))
        .limit(top)
    )


def exact_duplicates(corpus: DataFrame) -> DataFrame:
    """Surplus copies per split after normalising the text."""
    copies = corpus.groupBy("split", F.md5(tx.normalise_text(F.col("text"))).alias("key")).agg(
        F.count("*").alias("n")
    )
    return copies.groupBy("split").agg(
        F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("duplicates")
    )


def split_leakage(corpus: DataFrame) -> DataFrame:
    """Normalised texts found in train and in test, one row each.

    Digests are grouped first and remember one row each; texts are only read again for these
    rows. A text with very many copies is one row by then.
    """
    leaking = stored(
        corpus.groupBy(F.md5(tx.normalise_text(F.col("text"))).alias("_key"))
        .agg(
            F.count_if(F.col("split") == "train").alias("n_train"),
            F.count_if(F.col("split") == "test").alias("n_test"),
            F.min(F.struct("split", "row_id")).alias("_first"),
        )
        .where("n_train > 0 and n_test > 0")
        .select("n_train", "n_test", "_first.*"),
        "leaking-keys",
    )
    texts = corpus.select("split", "row_id", tx.normalise_text(F.col("text")).alias("text"))
    return texts.join(leaking, ["split", "row_id"]).select("text", "n_train", "n_test")


def leakage_summary(leaks: DataFrame, examples: int = 5) -> DataFrame:
    """Number of leaking texts beside the first few of them, cut to 80 characters."""
    leaks = stored(leaks, "leaks")
    return leaks.orderBy("text").limit(examples).select(
        F.substring("text", 1, 80).alias("example"),
        leaks.agg(F.count("*")).scalar().alias("n_leaking"),
    )


def artefact_flags(corpus: DataFrame) -> DataFrame:
    """How many texts hold non-ASCII characters, nothing at all, digits, braces."""
    text = F.col("text")
    return corpus.agg(
        F.count_if(tx.has_non_ascii(text)).alias("non_ascii"),
        F.count_if(tx.is_blank(text)).alias("blank"),
        F.count_if(tx.has_digit(text)).alias("with_digits"),
        F.count_if(tx.has_brace(text)).alias("with_braces"),
    )


def special_chars(corpus: DataFrame) -> DataFrame:
    """Non-ASCII characters with code point, Unicode name and number of texts."""
    return (
        corpus.select(F.explode(tx.non_ascii_chars(F.col("text"))).alias("char"))
        .groupBy("char")
        .agg(F.count("*").alias("n_texts"))
        .withColumn("code_point", F.ascii("char").cast("bigint"))
        .withColumn("name", tx.char_name("char"))
    )


def class_examples(corpus: DataFrame, classes: Sequence[str] | None, n: int = 6) -> DataFrame:
    """First n texts of the chosen classes; each task keeps n per class before the shuffle."""
    chosen = corpus if classes is None else corpus.where(F.col("label").isin(list(classes)))
    order = Window.partitionBy("label").orderBy("row_id")
    return chosen.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def majority_baseline(corpus: DataFrame) -> DataFrame:
    """Always predict the most frequent train label; accuracy on test, chance = 1/classes."""
    counts = corpus.groupBy("label").agg(
        F.count_if(F.col("split") == "train").alias("train"),
        F.count_if(F.col("split") == "test").alias("test"),
    )
    best = F.min(F.struct(-F.col("train"), "label", "test"))
    classes = F.count_if(F.col("train") > 0)
    return counts.agg(best.alias("b"), F.sum("test").alias("n"), classes.alias("k")).select(
        F.col("b.label").alias("label"),
        F.round(F.col("b.test") / F.col("n"), 6).alias("accuracy"),
        F.round(1 / F.col("k"), 6).alias("chance"),
    )


def context_window_check(
    lengths: DataFrame, length_col: str, windows: Sequence[int] = (256, 512)
) -> DataFrame:
    """Length percentiles, padded maximum ceil(p99 / 8) * 8, and share above each window.

    Lengths are counted first, so the percentiles work on one row per distinct length.
    """
    counts = stored(
        lengths.groupBy(F.col(length_col).alias("n")).agg(F.count("*").alias("freq")), "lengths"
    )
    share = lambda above: F.round(
        F.sum(F.when(F.col("n") > above, F.col("freq")).otherwise(0)) / F.sum("freq") * 100, 6
    )
    at = lambda p: F.percentile("n", F.lit(p), F.col("freq"))
    padded = counts.agg((F.ceil(at(0.99) / 8) * 8).cast("bigint")).scalar()
    return counts.withColumn("_padded", padded).agg(
        at(0.5).alias("p50"),
        F.round(at(0.95), 6).alias("p95"),
        F.round(at(0.99), 6).alias("p99"),
        F.max("n").alias("max_len"),
        F.max("_padded").alias("padded_len"),
        share(F.col("_padded")).alias("truncated_pct"),
        *[share(w).alias(f"over_{w}_pct") for w in windows],
    )


def data_checks(corpus: DataFrame, known_labels: Sequence[str], max_chars: int) -> DataFrame:
    """Pass/fail table: null or blank text, unknown label, over-long text, split duplicates."""
    text, label = F.col("text"), F.col("label")
    flags = corpus.agg(
        F.count_if(text.isNull() | tx.is_blank(text)).alias("empty_text"),
        F.count_if(label.isNull() | ~label.isin(list(known_labels))).alias("unknown_label"),
        F.count_if(F.length(text) > max_chars).alias("too_long"),
    )
    pairs = [x for c in flags.columns for x in (F.lit(c), F.col(c))]
    simple = flags.select(F.explode(F.create_map(*pairs)).alias("check_name", "violations"))
    leaks = split_leakage(corpus).agg(F.count("*").alias("violations")).select(
        F.lit("split_duplicates").alias("check_name"), "violations"
    )
    return simple.unionByName(leaks).withColumn("passed", F.col("violations") == 0)


def label_leak_terms(
    corpus: DataFrame, min_docs: int = 5, min_share: float = 0.9
) -> DataFrame:
    """Words that give the label away: P(label | word) high over at least min_docs texts."""
    per_label = (
        corpus.select("label", F.explode(F.array_distinct(tx.tokenise_alpha(F.col("text")))).alias("word"))
        .groupBy("word", "label")
        .agg(F.count("*").alias("n"))
    )
    per_word = per_label.groupBy("word").agg(
        F.sum("n").alias("n_docs"), F.max("n").alias("_n"),
        F.min(F.struct(-F.col("n"), "label")).alias("_best"),
    )
    return per_word.select(
        "word", F.col("_best.label").alias("label"), "n_docs",
        F.round(F.col("_n") / F.col("n_docs"), 6).alias("share"),
    ).where((F.col("n_docs") >= min_docs) & (F.col("_n") >= F.lit(min_share) * F.col("n_docs")))
