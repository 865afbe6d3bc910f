"""Inputs of the registered queries, derived from the given tables, in Spark and in SQL.

Every derived value comes from table columns and md5, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelscope.functions.scores import softmax
from labelscope.functions.text import WHITESPACE, hash_number
from labelscope.sources.corpus import load_corpus, load_vectors

# Frequent function words of the four languages in the corpus.
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "for", "with", "that", "are", "der", "die", "und",
              "das", "ist", "le", "la", "les", "et", "de", "un", "une", "en", "el", "los", "que", "por", "con"]

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# Run key and error percentage of the derived predictions.
RUNS = [("A_plain_bayes", 30), ("A_tuned_bayes", 18), ("B_plain_knn", 15),
        ("B_tuned_knn", 12), ("C_plain_net", 10), ("D_prompt", 40)]
SCORED = ["A_tuned_bayes", "B_tuned_knn", "C_plain_net"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def corpus(spark: SparkSession, folder: str, label: str = "lang") -> DataFrame:
    """documents as (row_id, text, label, split); about a fifth is test."""
    rows = load_corpus(spark, f"{folder}/documents.parquet", "doc_id", "text", label)
    test = hash_number(F.col("row_id"), ":test") % 10 < 2
    return rows.withColumn("split", F.when(test, "test").otherwise("train"))


def train_part(rows: DataFrame) -> DataFrame:
    return rows.where("split = 'train'").drop("split")


def test_part(rows: DataFrame) -> DataFrame:
    return rows.where("split = 'test'").drop("split")


def predictions(spark: SparkSession, folder: str, salt: str = "") -> DataFrame:
    """Six runs over all events; a run errs on a hash-chosen share of the rows."""
    runs = F.array(*[F.struct(F.lit(k).alias("model_key"), F.lit(e).alias("err")) for k, e in RUNS])
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("row_id"), F.col("event_type").alias("y_true"), F.inline(runs)
    )
    names = F.lit(EVENT_TYPES)
    draw = lambda tag: hash_number(F.col("row_id"), ":", F.col("model_key"), salt + tag)
    place = F.array_position(names, F.col("y_true"))  # 1-based, so this is index + 1
    other = F.element_at(names, (F.pmod(place + draw(":e") % 4, F.lit(5)) + 1).cast("int"))
    missing = (F.col("model_key") == "D_prompt") & (draw(":u") % 3 == 0)
    wrong = F.when(missing, "unknown").otherwise(other)
    return rows.select(
        "model_key", "row_id", "y_true",
        F.when(draw("") % 100 < F.col("err"), wrong).otherwise(F.col("y_true")).alias("y_pred"),
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of three runs with logits and scores; the net keeps raw logits."""
    rows = predictions(spark, folder).where(F.col("model_key").isin(SCORED))
    digest = F.md5(F.concat(F.col("row_id").cast("string"), F.lit(":"), F.col("model_key"), F.lit(":s")))
    names = F.lit(EVENT_TYPES)
    logits = [
        F.conv(F.substring("_d", 1 + 6 * j, 6), 16, 10).cast("bigint") % 1000 / 250.0
        + F.when(F.col("y_pred") == name, 4.0).otherwise(0.0)
        for j, name in enumerate(EVENT_TYPES)
    ]
    net = F.col("model_key") == "C_plain_net"
    return (
        rows.withColumn("_d", digest)
        .withColumn("logits", F.array(*logits)).drop("_d")
        .withColumn("classes", names)
        .withColumn("scores", F.when(net, F.col("logits")).otherwise(softmax(F.col("logits"))))
        .withColumn("score_type", F.when(net, "decision_function").otherwise("proba"))
    )


def vectors(spark: SparkSession, folder: str, dims: int = 64) -> DataFrame:
    """embeddings as (vec_id, v, label), optionally cut to the first ``dims`` numbers."""
    rows = load_vectors(spark, f"{folder}/embeddings.parquet", "vec_id", "embedding", "label")
    return rows.withColumn("v", F.slice("v", 1, dims))


def vector_is_query() -> F.Column:
    return hash_number(F.col("vec_id"), ":q") % 5 == 0


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """events as (row_id, gold, raw): raw model answers in six shapes."""
    kind = hash_number(F.col("row_id"), ":r") % 6
    gold = F.col("gold")
    return (
        table(spark, folder, "events")
        .select(F.col("event_id").alias("row_id"), F.col("event_type").alias("gold"))
        .withColumn(
            "raw",
            F.when(kind == 0, gold)
            .when(kind == 1, F.concat(F.lit("  "), F.upper(gold), F.lit(" ")))
            .when(kind == 2, F.concat(F.lit("The label is **"), gold, F.lit("**.")))
            .when(kind == 3, "purchase or view")
            .when(kind == 4, "no idea"),
        )
    )


def trials(spark: SparkSession, folder: str) -> DataFrame:
    """events as a training log: one run per event type, one epoch per day."""
    return table(spark, folder, "events").groupBy(
        F.col("event_type").alias("run"), F.dayofmonth("ts").cast("bigint").alias("epoch")
    ).agg(F.round(F.avg("value") / 100, 6).alias("val_f1"))


# ---- the same inputs in SQL ------------------------------------------------------------

WS = WHITESPACE
STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


def h(text: str) -> str:
    return f"CAST(concat('0x', substr(md5({text}), 1, 8)) AS BIGINT)"


def strip_sql(column: str) -> str:
    return f"trim({column}, '{WS}')"


def norm_sql(column: str) -> str:
    return f"lower({strip_sql(column)})"


def words_sql(column: str) -> str:
    return f"CASE WHEN {strip_sql(column)} = '' THEN 0 ELSE len(regexp_split_to_array({strip_sql(column)}, '[{WS}]+')) END"


def corpus_sql(label: str = "lang") -> str:
    return f"""corpus AS (
  SELECT doc_id AS row_id, text, {label} AS label,
         CASE WHEN {h("concat(doc_id, ':test')")} % 10 < 2 THEN 'test' ELSE 'train' END AS split
  FROM documents)"""


def predictions_sql(name: str = "predictions", salt: str = "") -> str:
    runs = ", ".join(f"('{k}', {e})" for k, e in RUNS)
    names = "[" + ", ".join(f"'{x}'" for x in EVENT_TYPES) + "]"
    draw = lambda tag: h(f"concat(event_id, ':', model_key, '{salt}{tag}')")
    return f"""{name} AS (
  SELECT model_key, event_id AS row_id, event_type AS y_true,
    CASE WHEN {draw('')} % 100 >= err THEN event_type
         WHEN model_key = 'D_prompt' AND {draw(':u')} % 3 = 0 THEN 'unknown'
         ELSE {names}[((list_position({names}, event_type) + {draw(':e')} % 4) % 5) + 1] END AS y_pred
  FROM events, (VALUES {runs}) r(model_key, err))"""


def scored_sql() -> str:
    """CTEs predictions, logit (long) and scored (long: one row per class)."""
    keys = ", ".join(f"'{k}'" for k in SCORED)
    names = ", ".join(f"({j}, '{x}')" for j, x in enumerate(EVENT_TYPES))
    return predictions_sql() + f""",
logit AS (
  SELECT p.model_key, p.row_id, p.y_true, p.y_pred, c.j, c.label,
    CAST(concat('0x', substr(md5(concat(row_id, ':', model_key, ':s')), 1 + 6 * j, 6)) AS BIGINT) % 1000 / 250.0
      + CASE WHEN y_pred = label THEN 4.0 ELSE 0.0 END AS z
  FROM predictions p, (VALUES {names}) c(j, label) WHERE model_key IN ({keys})),
scored AS (
  SELECT *, CASE WHEN model_key = 'C_plain_net' THEN 'decision_function' ELSE 'proba' END AS score_type,
    CASE WHEN model_key = 'C_plain_net' THEN CAST(z AS DOUBLE)
         ELSE exp(z) / sum(exp(z)) OVER w END AS s
  FROM logit WINDOW w AS (PARTITION BY model_key, row_id)),
conf AS (
  SELECT model_key, row_id, score_type, max(s) AS conf,
         CAST(arg_min(label, (-s, j)) = any_value(y_true) AS BIGINT) AS correct
  FROM scored GROUP BY ALL)"""


def vectors_sql(dims: int = 64, name: str = "vecs") -> str:
    return f"""{name} AS (
  SELECT vec_id, CAST(label AS VARCHAR) AS label, list_transform(u, lambda x: x / sqrt(list_dot_product(u, u))) AS v
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[])[1:{dims}] AS u FROM embeddings))"""


def answers_sql() -> str:
    return f"""answers AS (
  SELECT event_id AS row_id, event_type AS gold,
    CASE {h("concat(event_id, ':r')")} % 6 WHEN 0 THEN event_type WHEN 1 THEN concat('  ', upper(event_type), ' ')
      WHEN 2 THEN concat('The label is **', event_type, '**.') WHEN 3 THEN 'purchase or view'
      WHEN 4 THEN 'no idea' END AS raw
  FROM events),
parsed AS (
  SELECT row_id, gold, raw,
    CASE WHEN raw IS NULL THEN 'unknown'
         WHEN lower(trim(raw)) IN ('click', 'error', 'purchase', 'signup', 'view') THEN lower(trim(raw))
         ELSE coalesce((SELECT arg_min(l, (-length(l), l)) FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) t(l)
                        WHERE contains(lower(raw), l)), 'unknown') END AS y_pred
  FROM answers)"""


METRICS_SQL = """stats AS (
  SELECT model_key, label, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp,
         2.0 * sum(tp) / (sum(support) + sum(predicted)) AS f1
  FROM (SELECT model_key, y_true AS label, 1 AS support, 0 AS predicted, CAST(y_true = y_pred AS INT) AS tp FROM predictions
        UNION ALL SELECT model_key, y_pred, 0, 1, 0 FROM predictions)
  GROUP BY ALL),
metrics AS (
  SELECT model_key, CAST(sum(support) AS BIGINT) AS n, sum(tp) / sum(support) AS accuracy, avg(f1) AS macro_f1,
         sum(f1 * support) / sum(support) AS weighted_f1
  FROM stats GROUP BY model_key)"""
