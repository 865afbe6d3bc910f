"""Corpus cleaning pipeline over ``documents``: five stages of labelscope.llm, each written and read again.

Quality rules drop what they reject; line dedup removes repeated lines, and documents left
without a word; MinHash near-dedup keeps the first document of each group, a document being its id and text; mixing repeats
documents as often as the mix reads them, in training order (a reading that the target ends
early is kept when at least half of the document is due); the last stage encodes the texts.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelscope.llm import lines, minhash, mixing, pieces, quality
from labelscope.llm.queries import PIECE_MODEL
from labelscope.runtime import stored


#: Columns the stages work on; all others travel in one struct, so that no name of theirs can clash.
OWN, OTHERS = ("doc_id", "text", "source"), "_other_columns"


def keeping_other_columns(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [F.col(c) for c in docs.columns if c not in OWN]
        found = stage(spark, docs.select(*OWN, (F.struct(*others) if others else F.lit(0)).alias(OTHERS)), sf_dir)
        return found.select(*(F.col(c) if c in OWN else F.col(OTHERS)[c].alias(c) for c in docs.columns))

    return run_stage


@keeping_other_columns
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_documents(docs, labels)


@keeping_other_columns
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs)


@keeping_other_columns
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is its id and its text: rows that agree in both are one, and different texts stay apart whether they
    share an id or have none. A group keeps the document with the smallest id, null last; among equal ids any one, always the same."""
    keyed = docs.withColumn("_key", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))
    groups = minhash.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"))
    members = keyed.select("_key", "doc_id").distinct().join(groups.select(F.col("doc_id").alias("_key"), "component_id").distinct(), "_key")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key")).alias("_first")
    kept = members.groupBy("component_id").agg(first).select("_first._key")
    versions = Window.partitionBy("_key").orderBy(F.lit(0))
    rows = keyed.join(kept, "_key", "left_semi").withColumn("_version", F.row_number().over(versions)).where("_version = 1")
    return rows.select(*docs.columns)


@keeping_other_columns
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = [c for c in docs.columns if c not in ("doc_id", "source")]
    placed = mixing.placements(mixing.assign(docs, keep=rest))
    return placed.where(2 * F.col("words") >= F.col("size")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces, ids."""
    found = pieces.encode(docs, pieces.load(PIECE_MODEL), keep=("doc_id", "source"))
    return found.select("doc_id", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_repeated_lines),
    ("MinHash near-dedup", one_of_each_group),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding", encoded),
]
#: Grouping and packing are iterative; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
