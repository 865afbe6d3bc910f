"""Corpus and vector sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelscope.runtime import stored

SCAN_PARTITIONS = "spark.labelscope.scanPartitions"


def load_corpus(
    spark: SparkSession, path: str, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """One Parquet split as (row_id, text, label); the scan reads these three columns.

    The session setting SCAN_PARTITIONS, meant for local runs over single files, deals the rows
    out; without it the partitions of the scan stay.
    """
    rows = spark.read.parquet(path).select(
        F.col(id_col).cast("bigint").alias("row_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(label_col).cast("string").alias("label"),
    )
    partitions = spark.conf.get(SCAN_PARTITIONS, None)
    return rows.repartition(int(partitions), "row_id") if partitions else rows


def union_sources(
    spark: SparkSession, sources: Sequence[Mapping[str, str]]
) -> DataFrame:
    """Map every source's own column names to one schema and concatenate.

    A source gives ``name, path, split, id, text, label``; several shards of one split
    are several entries (or one path pattern). Ids of different sources may collide, so the
    union's ``row_id`` is the JSON text of source, split and id. Names with any character stay apart,
    and a null id, which leaves its field out, meets no other id.
    """
    parts = [
        load_corpus(spark, s["path"], s["id"], s["text"], s["label"]).select(
            F.lit(s["name"]).alias("source"), F.lit(s["split"]).alias("split"),
            F.to_json(F.struct(F.lit(s["name"]).alias("source"), F.lit(s["split"]).alias("split"), "row_id")).alias("row_id"), "text", "label",
        )
        for s in sources
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def profile_corpus(corpus: DataFrame, split_col: str = "split") -> DataFrame:
    """Per split and over all splits: rows, labels, median / max / min text length.

    One pass over the texts counts rows per (split, label, length); both levels come from
    these counts.
    """
    counts = stored(
        corpus.groupBy(F.col(split_col).alias("split"), "label", F.length("text").alias("n_chars"))
        .agg(F.count("*").alias("freq")),
        "length-counts",
    )
    measures = [
        F.sum("freq").alias("n_rows"),
        F.countDistinct("label").alias("n_labels"),
        F.floor(F.percentile("n_chars", F.lit(0.5), F.col("freq"))).cast("bigint").alias("median_chars"),
        F.max("n_chars").cast("bigint").alias("max_chars"),
        F.min("n_chars").cast("bigint").alias("min_chars"),
    ]
    return counts.groupBy("split").agg(*measures).unionByName(
        counts.agg(F.lit("all").alias("split"), *measures)
    )


def head_rows(corpus: DataFrame, n: int = 4, width: int = 90) -> DataFrame:
    """First ``n`` rows by id, long texts cut to ``width`` characters plus an ellipsis."""
    cut = F.concat(F.substring("text", 1, width), F.lit("…"))
    return (
        corpus.orderBy("row_id")
        .limit(n)
        .select("row_id", "label", F.when(F.length("text") > width, cut).otherwise(F.col("text")).alias("text"))
    )


def load_vectors(
    spark: SparkSession,
    path: str,
    id_col: str,
    vector_col: str,
    label_col: str,
    classes: Sequence | None = None,
) -> DataFrame:
    """Embedding table as (vec_id, v, label), limited to the chosen classes."""
    table = spark.read.parquet(path)
    if classes is not None:
        table = table.where(F.col(label_col).isin(list(classes)))
    return table.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("v"),
        F.col(label_col).cast("string").alias("label"),
    )
