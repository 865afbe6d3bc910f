"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelscope.llm import align, backoff, hosts, lines, minhash, mixing, pieces, pii, quality, quotes, runs, topk, vertical

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op5_minhash")
def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), percent=85)


@query("op1_quality")
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op2_pii")
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


#: Words of a text in DuckDB; an absent text has none.
N_WORDS = "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))"


def time_sql(share: str, knots) -> str:
    """Time at which the integral of a piecewise linear weight reaches ``share`` of its total."""
    areas = [(b - a) * (u + v) / 2 for (a, u), (b, v) in zip(knots, knots[1:])]
    total, cases, done = sum(areas), "", 0.0
    for ((a, u), (b, v)), area in zip(zip(knots, knots[1:]), areas):
        slope = (v - u) / (b - a)
        due = f"(({share}) - {done / total!r}::DOUBLE) * {total!r}::DOUBLE"
        step = f"{due} / {u!r}::DOUBLE" if slope == 0 else f"(sqrt(greatest(0.0::DOUBLE, {u * u!r}::DOUBLE + {2 * slope!r}::DOUBLE * ({due}))) - {u!r}::DOUBLE) / {slope!r}::DOUBLE"
        done += area
        cases += f" WHEN ({share}) <= {done / total!r}::DOUBLE THEN {a!r}::DOUBLE + {step}"
    return f"CASE{cases} ELSE {knots[-1][0]!r}::DOUBLE END"


SCHEDULE_SQL = " ".join(f"WHEN {k} THEN {time_sql('ahead / target', knots)}" for k, knots in enumerate(mixing.SCHEDULES))
OP4_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, {N_WORDS} AS size, md5(coalesce(text, '')) AS digest,
         CAST(concat('0x', substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', md5(coalesce(text, '')))), 1, 8)) AS BIGINT) AS place
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS slot,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM sources WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size, slot, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM levels),
placed AS (
  SELECT s.*, t.source_size, t.target, t.slot, CAST(round(target) AS BIGINT) AS due,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS full_reads,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id NULLS FIRST, digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT *, greatest(0, least(size, due - full_reads * source_size - ahead)) AS rest FROM placed),
counted AS (SELECT *, CASE WHEN size > 0 THEN full_reads + CAST(rest > 0 AS BIGINT) ELSE 0 END AS readings FROM cut)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(full_reads * size + rest AS BIGINT) AS taken, CAST(readings AS BIGINT) AS readings,
       CASE WHEN readings > 0 THEN round(CASE slot {SCHEDULE_SQL} END, 9) END AS position
FROM counted"""


@query("op4_mixing", OP4_SQL)
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document, in the order of its first reading; documents that are never read come last."""
    found = mixing.in_training_order(mixing.assign(table(spark, folder, "documents")))
    return found.select("doc_id", "size", "source_size", "target", "taken", "readings", F.round("position", 9).alias("position"))


URL_RULES = (
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
)


@query("op8_hosts")
def op8_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return hosts.judge(table(spark, folder, "pages"), URL_RULES)


OP9_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
parts AS (SELECT r, vec_id, generate_subscripts(embedding, 1) AS d, unnest(embedding) AS x FROM usable),
whole AS (SELECT r, vec_id, d, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM parts),
scores AS (
  SELECT q.r AS qr, c.r AS cr, q.vec_id AS query_id, c.vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, cr) AS r FROM scores)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5"""


@query("op9_topk", OP9_SQL)
def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


@query("op10_quotes")
def op10_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.conversations(table(spark, folder, "conversations"))


@query("op7_backoff")
def op7_backoff(spark: SparkSession, folder: str) -> DataFrame:
    return backoff.score(table(spark, folder, "documents"))


@query("op3_lines")
def op3_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    per_text = lines.by_document(docs)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    same = rows["doc_id"].eqNullSafe(per_text["doc_id"]) & (rows["text_key"] == per_text["text_key"])
    return rows.join(per_text, same, "left").select(
        rows["doc_id"], F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.size(F.coalesce("removed", F.array().cast("array<int>"))).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


#: SentencePiece model that op6 and the pipeline encode with.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


@query("op6_pieces")
def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = pieces.load(PIECE_MODEL)
    found = pieces.decode(pieces.encode(table(spark, folder, "documents"), model), model)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_digest"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


@query("op12_runs")
def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digest_columns(runs.runs_by_text(table(spark, folder, "documents"), runs.planted))


#: Byte-level BPE that op13 aligns with the pieces.
BYTE_MODEL = os.environ.get("BYTE_MODEL", "/opt/tokenizers/byte_bpe_50k.json")


@query("op13_alignment")
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.alignments(table(spark, folder, "documents"), align.load(BYTE_MODEL, PIECE_MODEL))


@query("op11_vertical")
def op11_vertical(spark: SparkSession, folder: str) -> DataFrame:
    return vertical.components(table(spark, folder, "documents"), percent=80)
