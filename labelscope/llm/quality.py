"""Quality rules: counts per text and a hashed n-gram log-likelihood ratio, all in DataFrame functions.

Words are runs of non-blank characters. The method compares two multinomials over hashed word
unigrams and bigrams, one of trusted documents and one of the whole corpus, smoothed towards
each other over a fixed number of buckets. A document's score is the mean log ratio of its
n-grams in nats; it is kept when the score reaches ``threshold``. Ratios are rounded to
millionths and summed as integers, so the verdict does not depend on the order of rows.

The trusted side is fitted on at most ``trusted_documents`` documents labelled good (those of
the smallest hash); a label table without any good document leaves the score at 0. Corpus
counts cover all texts.

A null text counts as empty. Texts without words fail the base rules (fewer than 10 words).
Repeated rows are judged one by one and alike; a null doc_id is kept as null. Extra columns of
``docs`` are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelscope.functions.bind import bind
from labelscope.runtime import stored

BLANK = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
WINDOW = 5
SCALE = 1_000_000
BUCKETS = 1 << 18
TRUSTED_DOCUMENTS = 20_000
#: Corpus n-grams added to each bucket, and as many trusted ones as the trusted share predicts:
#: a bucket with few n-grams says little.
SMOOTHING = 10
#: Nats per n-gram. Prose of the corpus lies around 0, text of another kind well below.
THRESHOLD = -0.25


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def repeated_words(words: Column) -> Column:
    """Words covered by 5-word windows that occur twice or more in the text."""

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = bind(placed, lambda p: F.filter(
            p, lambda x, k: F.coalesce(x.h == F.get(p, k - 1).h, F.lit(False)) | F.coalesce(x.h == F.get(p, k + 1).h, F.lit(False))
        ))
        starts = F.sort_array(F.transform(repeated, lambda x: x.i))
        return bind(starts, lambda s: F.aggregate(
            F.transform(s, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW)))),
            F.lit(0), lambda total, n: total + n,
        ))

    def counted(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))),
        )
        return bind(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))

    return bind(words, lambda w: F.when(F.size(w) <= WINDOW, 0).otherwise(counted(w))).cast("long")


def base_counts(docs: DataFrame) -> DataFrame:
    """row, doc_id, the base counts and the words of each text; ``row`` numbers the rows of this plan."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return (
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.xxhash64("text").alias("text_key"), words_of(text).alias("words"),
            F.length(F.regexp_replace(text, BLANK, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            bind(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        )
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("n_repeat_words", repeated_words(F.col("words")))
    )


def grams(rows: DataFrame, keep: list[str], buckets: int) -> DataFrame:
    """A row per word: its bucket ``one`` and that of the pair with the next word, ``two``."""
    nexts = F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0)))
    pair = F.explode_outer(F.arrays_zip(F.col("words").alias("a"), nexts.alias("b")))
    hashed = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")
    return rows.select(*keep, pair.alias("g")).select(
        *keep,
        F.when(F.col("g.a").isNotNull(), hashed("g.a")).alias("one"),
        F.when(F.col("g.b").isNotNull(), hashed("g.a", "g.b")).alias("two"),
    )


def ratio_table(docs: DataFrame, labels: DataFrame, buckets: int, trusted_documents: int) -> DataFrame:
    """bucket, ratio: log of trusted share over corpus share, in millionths of a nat.

    At most ``buckets`` rows, all that the corpus uses.
    """
    trusted = F.broadcast(  # at most trusted_documents ids
        labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_documents).withColumn("good", F.lit(1))
    )
    texts = docs.join(trusted, "doc_id", "left").select(
        words_of(F.coalesce("text", F.lit(""))).alias("words"), F.coalesce("good", F.lit(0)).alias("good")
    )
    counts = stored(
        grams(texts, ["good"], buckets)
        .select("good", F.explode(F.array("one", "two")).alias("bucket")).where("bucket is not null")
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("target")),
        "bucket-counts",
    )
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not target:
        return counts.select("bucket", F.lit(0).cast("long").alias("ratio"))
    part = F.lit(target / raw)
    ratio = (F.col("target") + SMOOTHING * part) / ((F.col("raw") + SMOOTHING) * part)
    return counts.select("bucket", F.round(F.log(ratio) * SCALE).cast("long").alias("ratio"))


def judge(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS,
    trusted_documents: int = TRUSTED_DOCUMENTS,
) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, base counts, base_failed, ratio_sum, n_grams, kept."""
    ratios = F.broadcast(ratio_table(docs, labels, buckets, trusted_documents))  # at most ``buckets`` rows
    base = ["word_chars", "n_symbols", "n_dup_lines", "n_words", "n_repeat_words"]
    rows = grams(base_counts(docs), ["row", "doc_id", "text_key", *base], buckets)
    first = ratios.select(F.col("bucket").alias("one"), F.col("ratio").alias("r1"))
    second = ratios.select(F.col("bucket").alias("two"), F.col("ratio").alias("r2"))
    scored = rows.join(first, "one", "left").join(second, "two", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("text_key").alias("text_key"), *(F.max(c).alias(c) for c in base),
        F.sum(F.coalesce("r1", F.lit(0)) + F.coalesce("r2", F.lit(0))).alias("ratio_sum"),
        (F.count("one") + F.count("two")).alias("n_grams"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passes = F.col("ratio_sum") >= F.round(F.lit(threshold) * SCALE) * F.col("n_grams")
    return scored.drop("row").withColumn("base_failed", failed).withColumn("kept", ~failed & passes)


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept."""
    bad = judge(docs, labels, **options).where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_key")), "left_anti")
