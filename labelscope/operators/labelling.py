"""Batch labelling with a pluggable answer function, a response cache and answer parsing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelscope.functions import text as tx
from labelscope.functions.answers import UNKNOWN, message, parse_label, prompt_cache_key
from labelscope.operators.features import append_in_waves, one_per_key, read_cache
from labelscope.operators.profile import top_words_by_class

MakeMessages = Callable[[Column], Column]


def zero_shot(system: str, labels: Sequence[str]) -> MakeMessages:
    """Prompt builder: task text and the label list as system turn, the text as user turn."""
    block = system + "\n".join(labels)
    return lambda text: F.array(message("system", F.lit(block)), message("user", text))


def few_shot(system: str, labels: Sequence[str], demos: Sequence[tuple[str, str]]) -> MakeMessages:
    """Prompt builder with solved (text, label) turns between the system and the user turn."""
    block = system + "\n".join(labels)
    solved = [
        turn for text, label in demos
        for turn in (message("user", F.lit(text)), message("assistant", F.lit(label)))
    ]
    return lambda text: F.array(message("system", F.lit(block)), *solved, message("user", text))


def demo_turns(demos: DataFrame) -> list[tuple[str, str]]:
    """Demos (label, pick, text) as an ordered list: a fixed number per class by construction."""
    rows = demos.select("label", "pick", "text").orderBy("label", "pick").collect()
    return [(r["text"], r["label"]) for r in rows]


def prompts(corpus: DataFrame, make_messages: MakeMessages) -> DataFrame:
    return corpus.select("row_id", make_messages(F.col("text")).alias("messages"))


def cached_completion(
    corpus: DataFrame,
    make_messages: MakeMessages,
    completer: Callable[[pd.Series], pd.Series],
    cache_path: str,
    model: str,
    temperature: float = 0.0,
    max_tokens: int = 40,
    rows_per_commit: int = 1_000_000,
) -> DataFrame:
    """(row_id, cache_key, raw): answers from the cache, computed only for unseen keys.

    ``completer`` maps a batch of message lists (JSON text) to raw answers; null means no
    answer. It runs in parallel on the executors. The shuffle carries keys and texts only:
    messages, with their long shared part, are built again next to the completer. Keys are
    made distinct first, by partial aggregation, so copies of one text cost one call. Answers are
    committed ``rows_per_commit`` at a time; an interrupted run is resumed by calling again.
    """
    key = prompt_cache_key(make_messages(F.col("text")), model, temperature, max_tokens)
    keyed = corpus.select("row_id", "text", key.alias("cache_key"))
    cache = read_cache(corpus.sparkSession, cache_path, "cache_key string, raw string")
    distinct = keyed.groupBy("cache_key").agg(F.first("text").alias("text"))
    unseen = distinct.join(cache.select("cache_key"), "cache_key", "left_anti")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            raw = completer(frame["messages"])
            yield pd.DataFrame({"cache_key": frame["cache_key"].to_numpy(), "raw": list(raw)})

    append_in_waves(
        unseen, "cache_key", rows_per_commit, cache_path,
        lambda rows: rows.select(
            "cache_key", F.to_json(make_messages(F.col("text"))).alias("messages")
        ).mapInPandas(answer, "cache_key string, raw string"),
    )
    answers = one_per_key(corpus.sparkSession.read.parquet(cache_path), "cache_key")
    return keyed.select("row_id", "cache_key").join(answers, "cache_key").select(
        "row_id", "cache_key", "raw"
    )


def classify(
    corpus: DataFrame, labels: Sequence[str], make_messages: MakeMessages,
    completer: Callable[[pd.Series], pd.Series], cache_path: str, model: str, **settings,
) -> DataFrame:
    """(row_id, raw, y_pred): cached answers with their parsed labels."""
    raws = cached_completion(corpus, make_messages, completer, cache_path, model, **settings)
    return raws.withColumn("y_pred", parse_label(F.col("raw"), list(labels)))


def misses(answers: DataFrame, n: int = 8) -> DataFrame:
    """First n wrong answers (row_id, raw, y_pred, gold)."""
    return answers.where("y_pred <> gold").orderBy("row_id").limit(n).select(
        "row_id", "raw", "y_pred", "gold"
    )


def self_consistency(votes: DataFrame) -> DataFrame:
    """(row_id, y_pred): majority over several answers; the smallest label wins a tie."""
    counts = votes.groupBy("row_id", "y_pred").agg(F.count("*").alias("n"))
    return counts.groupBy("row_id").agg(F.min(F.struct(-F.col("n"), "y_pred")).alias("b")).select(
        "row_id", F.col("b.y_pred").alias("y_pred")
    )


def keyword_classifier(corpus: DataFrame, keywords: DataFrame, default: str = UNKNOWN) -> DataFrame:
    """Label with the most keyword hits; smallest label on a tie, ``default`` without hits.

    ``keywords`` has (label, word). Tokens are counted per text before they meet the list.
    """
    tokens = (
        corpus.select("row_id", F.explode(tx.tokenise_alpha(F.col("text"))).alias("word"))
        .groupBy("row_id", "word").agg(F.count("*").alias("n"))
    )
    hits = tokens.join(keywords.distinct(), "word").groupBy("row_id", "label").agg(F.sum("n").alias("n"))
    best = hits.groupBy("row_id").agg(F.min(F.struct(-F.col("n"), "label")).alias("b"))
    return corpus.select("row_id").join(best, "row_id", "left").select(
        "row_id", F.coalesce("b.label", F.lit(default)).alias("y_pred")
    )


def keyword_list(corpus: DataFrame, per_class: int = 20, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Keyword table from each class's most frequent words that no other class has on its list."""
    top = top_words_by_class(corpus, per_class, stop_words).select("label", "word")
    classes = F.count("*").over(Window.partitionBy("word"))
    return top.withColumn("_n", classes).where("_n = 1").select("label", "word")
