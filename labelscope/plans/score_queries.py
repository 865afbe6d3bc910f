"""Registered queries: metrics, significance, confidence, registries, batch labelling."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F

from labelscope.functions import answers as an
from labelscope.functions import scores as sc
from labelscope.operators import confidence as cf
from labelscope.operators import labelling as lb
from labelscope.operators import metrics as mt
from labelscope.operators import significance as sg
from labelscope.operators import split as sp
from labelscope.operators import tuning as tn
from labelscope.plans import inputs as i
from labelscope.plans.registry import query
from labelscope.plans.text_queries import C, SAMPLE
from labelscope.runtime import new_path
from labelscope.sources import runs as rn

P = i.predictions_sql()
S = i.scored_sql()
M = i.METRICS_SQL
A = i.answers_sql()


# ---- hard metrics


@query("accuracy", f"WITH {P} SELECT model_key, round(avg(CAST(y_true = y_pred AS INT)), 6) AS accuracy FROM predictions GROUP BY model_key")
def _(spark, d):
    return mt.run_metrics(i.predictions(spark, d)).select("model_key", "accuracy")


@query("macro_f1", f"WITH {P}, {M} SELECT model_key, round(macro_f1, 6) AS macro_f1 FROM metrics")
def _(spark, d):
    return mt.run_metrics(i.predictions(spark, d)).select("model_key", "macro_f1")


@query("weighted_f1", f"WITH {P}, {M} SELECT model_key, round(weighted_f1, 6) AS weighted_f1 FROM metrics")
def _(spark, d):
    return mt.run_metrics(i.predictions(spark, d)).select("model_key", "weighted_f1")


REPORT = """report AS (SELECT model_key, label, round(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END, 6) AS precision,
  round(CASE WHEN support > 0 THEN tp / support ELSE 0 END, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM stats)"""


@query("class_report", f"WITH {P}, {M}, {REPORT} SELECT * FROM report")
def _(spark, d):
    return mt.class_report(i.predictions(spark, d))


@query("weakest_classes", f"""WITH {P}, {M}, {REPORT} SELECT model_key, place, label, f1, recall, support FROM (SELECT *,
  row_number() OVER (PARTITION BY model_key ORDER BY f1, label) AS place FROM report) WHERE place <= 3""")
def _(spark, d):
    return mt.weakest_classes(i.predictions(spark, d), 3)


@query("confusion_matrix", f"""WITH {P}, labels AS (SELECT model_key, y_true AS label FROM predictions UNION SELECT model_key, y_pred FROM predictions),
  cells AS (SELECT a.model_key, a.label AS y_true, b.label AS y_pred, count(p.row_id) AS n FROM labels a JOIN labels b USING (model_key)
    LEFT JOIN predictions p ON p.model_key = a.model_key AND p.y_true = a.label AND p.y_pred = b.label GROUP BY ALL)
  SELECT *, round(n / greatest(sum(n) OVER (PARTITION BY model_key, y_true), 1), 6) AS share FROM cells""")
def _(spark, d):
    return mt.confusion_matrix(i.predictions(spark, d), normalise=True)


@query("top_confusions", f"""WITH {P} SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY model_key ORDER BY n DESC, y_true, y_pred) AS place FROM (SELECT model_key, y_true, y_pred,
  count(*) AS n FROM predictions WHERE y_true <> y_pred GROUP BY ALL)) WHERE place <= 15""")
def _(spark, d):
    return mt.top_confusions(i.predictions(spark, d), 15)


@query("error_examples", f"""WITH {P} SELECT model_key, row_id, y_true, y_pred, props AS text
  FROM predictions JOIN events ON row_id = event_id WHERE y_true <> y_pred""")
def _(spark, d):
    texts = i.table(spark, d, "events").select(F.col("event_id").alias("row_id"), F.col("props").alias("text"))
    return mt.error_examples(i.predictions(spark, d), texts)


@query("unknown_rate", f"""WITH {P} SELECT model_key, count(*) AS n, count(*) FILTER (y_pred = 'unknown') AS n_unknown,
  round(count(*) FILTER (y_pred = 'unknown') / count(*), 6) AS unknown_share FROM predictions GROUP BY model_key""")
def _(spark, d):
    return mt.unknown_rate(i.predictions(spark, d))


RATERS = f"""{P}, raters AS (SELECT row_id, max(y_pred) FILTER (model_key = 'A_plain_bayes') AS a,
  max(y_pred) FILTER (model_key = 'B_plain_knn') AS b FROM predictions GROUP BY row_id),
  agree AS (SELECT count(*) AS n, avg(CAST(a = b AS INT)) AS po FROM raters),
  pe AS (SELECT sum(x.c * y.c) / any_value(n * n) AS pe FROM (SELECT a, count(*) AS c FROM raters GROUP BY a) x
    JOIN (SELECT b, count(*) AS c FROM raters GROUP BY b) y ON a = b, agree)"""


@query("cohens_kappa", f"WITH {RATERS} SELECT n, round(po, 6) AS observed, round(pe, 6) AS chance, round((po - pe) / (1 - pe), 6) AS kappa FROM agree, pe")
def _(spark, d):
    rows = i.predictions(spark, d)
    side = lambda key, name: rows.where(F.col("model_key") == key).select("row_id", F.col("y_pred").alias(name))
    return mt.cohens_kappa(side("A_plain_bayes", "a").join(side("B_plain_knn", "b"), "row_id"))


# ---- significance


@query("bootstrap_ci", f"""WITH {P}, c AS (SELECT model_key, count(*) AS n, count(*) FILTER (y_true = y_pred) AS hits FROM predictions GROUP BY model_key),
  cell AS (SELECT model_key, n, hits, unnest(range(0, n + 1)) AS k FROM c),
  pmf AS (SELECT model_key, n, k, exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(hits / n) + (n - k) * ln(1 - hits / n)) AS p FROM cell),
  cdf AS (SELECT model_key, k, sum(p) OVER (PARTITION BY model_key ORDER BY k) AS at FROM pmf WHERE p > 1e-40),
  draw AS (SELECT model_key, ({i.h("concat(model_key, ':0:', b)")} + 0.5) / 4294967296.0 AS u FROM c, range(1, 2001) t(b)),
  got AS (SELECT d.model_key, d.u, min(f.k) AS k FROM draw d JOIN cdf f ON f.model_key = d.model_key AND f.at >= d.u GROUP BY ALL),
  q AS (SELECT model_key, quantile_cont(CAST(k AS DOUBLE), 0.025) AS lo, quantile_cont(CAST(k AS DOUBLE), 0.975) AS hi FROM got GROUP BY model_key)
  SELECT model_key, round(hits / n * 100, 6) AS accuracy_pct, round(lo / n * 100, 6) AS low_pct, round(hi / n * 100, 6) AS high_pct
  FROM c JOIN q USING (model_key)""")
def _(spark, d):
    return sg.bootstrap_ci(i.predictions(spark, d), n_boot=2000, seed=0)


@query("mcnemar_pairs", f"""WITH {P}, r AS (SELECT model_key, row_id, y_true = y_pred AS ok FROM predictions),
  n AS (SELECT a.model_key AS model_a, b.model_key AS model_b, count(*) FILTER (NOT a.ok AND b.ok) AS only_b, count(*) FILTER (a.ok AND NOT b.ok) AS only_a
        FROM r a JOIN r b ON a.row_id = b.row_id AND a.model_key < b.model_key GROUP BY ALL),
  t AS (SELECT *, only_a + only_b AS m, unnest(range(0, least(only_a, only_b) + 1)) AS j FROM n),
  p AS (SELECT model_a, model_b, only_b, only_a, CASE WHEN any_value(m) = 0 THEN 1.0 ELSE
        least(1.0, 2 * sum(exp(lgamma(m + 1) - lgamma(j + 1) - lgamma(m - j + 1) - m * ln(2)))) END AS p FROM t GROUP BY ALL)
  SELECT model_a, model_b, only_b, only_a, round(p, 6) AS p_value, p < 0.05 AS significant FROM p""")
def _(spark, d):
    return sg.mcnemar_pairs(i.predictions(spark, d))


# ---- scores


@query("softmax_scores", f"WITH {S} SELECT model_key, row_id, label, round(s, 6) AS score FROM scored WHERE score_type = 'proba'")
def _(spark, d):
    rows = i.scored(spark, d).where("score_type = 'proba'")
    return rows.select("model_key", "row_id", F.explode(F.arrays_zip("classes", "scores")).alias("z")).select(
        "model_key", "row_id", F.col("z.classes").alias("label"), F.round("z.scores", 6).alias("score"))


@query("argmax_label", f"""WITH {S} SELECT model_key, row_id, arg_min(label, (-s, j)) AS y_arg, round(max(s), 6) AS confidence FROM scored GROUP BY ALL""")
def _(spark, d):
    s, c = F.col("scores"), F.col("classes")
    return i.scored(spark, d).select("model_key", "row_id", sc.argmax_label(s, c).alias("y_arg"),
                                     F.round(sc.confidence(s), 6).alias("confidence"))


@query("score_eligibility", f"""WITH {S} SELECT model_key, any_value(score_type) AS score_type, any_value(score_type) = 'proba' AS calibration, true AS ranking,
  count(DISTINCT row_id) AS n FROM scored GROUP BY model_key
  UNION ALL SELECT 'D_prompt', NULL, false, false, count(*) FROM predictions WHERE model_key = 'D_prompt'""")
def _(spark, d):
    bare = i.predictions(spark, d).where("model_key = 'D_prompt'")
    rows = i.scored(spark, d).unionByName(bare, allowMissingColumns=True)
    kind = F.col("score_type")
    return rows.groupBy("model_key").agg(F.max("score_type").alias("score_type"), F.count("*").alias("n")).select(
        "model_key", "score_type", sc.calibration_allowed(kind).alias("calibration"),
        sc.ranking_allowed(kind).alias("ranking"), "n")


BINS = """bins AS (SELECT model_key, CAST(least(floor(conf * 10), 9) AS BIGINT) AS bin, count(*) AS n, avg(conf) AS mean_conf, avg(correct) AS accuracy
  FROM conf WHERE score_type = 'proba' GROUP BY ALL)"""


@query("reliability_bins", f"WITH {S}, {BINS} SELECT model_key, bin, n, round(mean_conf, 6) AS mean_conf, round(accuracy, 6) AS accuracy FROM bins")
def _(spark, d):
    return cf.reliability_bins(i.scored(spark, d)).select(
        "model_key", "bin", "n", F.round("mean_conf", 6).alias("mean_conf"), F.round("accuracy", 6).alias("accuracy"))


@query("ece", f"WITH {S}, {BINS} SELECT model_key, round(sum(n * abs(accuracy - mean_conf)) / sum(n), 6) AS ece FROM bins GROUP BY model_key")
def _(spark, d):
    return cf.expected_calibration_error(cf.reliability_bins(i.scored(spark, d))).withColumn("ece", F.round("ece", 6))


@query("topk_accuracy", f"""WITH {S}, r AS (SELECT model_key, row_id, label = y_true AS own, row_number() OVER (PARTITION BY model_key, row_id ORDER BY s DESC, j) AS r FROM scored),
  own AS (SELECT model_key, r FROM r WHERE own)
  SELECT model_key, k, round(avg(CAST(r <= k AS INT)) * 100, 6) AS topk_pct FROM own, range(1, 6) t(k) GROUP BY ALL""")
def _(spark, d):
    return cf.topk_accuracy(i.scored(spark, d))


@query("risk_coverage", f"""WITH {S}, o AS (SELECT model_key, count(*) OVER (PARTITION BY model_key) AS n,
    row_number() OVER w AS place, sum(correct) OVER w AS hits FROM conf WINDOW w AS (PARTITION BY model_key ORDER BY round(conf, 12) DESC, row_id)),
  cut AS (SELECT model_key, i AS step, round(0.05::DOUBLE + i * (0.95::DOUBLE / 18), 6) AS coverage,
    CAST(greatest(floor((0.05::DOUBLE + i * (0.95::DOUBLE / 18)) * n + 1e-9), 1) AS BIGINT) AS n_answered
    FROM (SELECT DISTINCT model_key, n FROM o), range(0, 19) t(i))
  SELECT model_key, step, coverage, n_answered, round(hits / n_answered, 6) AS accuracy FROM cut JOIN o USING (model_key) WHERE place = n_answered""")
def _(spark, d):
    return cf.risk_coverage(i.scored(spark, d))


@query("soft_vote", f"""WITH {S}, v AS (SELECT row_id, any_value(y_true) AS y_true, label, any_value(j) AS j, avg(s) AS s FROM scored
    WHERE model_key IN ('A_tuned_bayes', 'B_tuned_knn') GROUP BY row_id, label)
  SELECT row_id, any_value(y_true) AS y_true, arg_min(label, (-s, j)) AS y_pred, round(max(s), 6) AS confidence FROM v GROUP BY row_id""")
def _(spark, d):
    rows = cf.soft_vote(i.scored(spark, d), "A_tuned_bayes", "B_tuned_knn")
    return rows.select("row_id", "y_true", "y_pred", F.round(sc.confidence(F.col("scores")), 6).alias("confidence"))


@query("cascade", f"""WITH {S}, a AS (SELECT row_id, any_value(y_true) AS y_true, arg_min(label, (-s, j)) AS y_pred, max(s) AS c FROM scored WHERE model_key = 'A_tuned_bayes' GROUP BY row_id)
  SELECT row_id, y_true, y_pred, 'A_tuned_bayes' AS answered_by FROM a WHERE c >= 0.9
  UNION ALL SELECT row_id, p.y_true, p.y_pred, 'C_plain_net' FROM predictions p JOIN a USING (row_id) WHERE model_key = 'C_plain_net' AND c < 0.9""")
def _(spark, d):
    return cf.cascade(i.scored(spark, d), "A_tuned_bayes", "C_plain_net", 0.9)


# Rows of the runs with probabilities: a fifth of the rows (by hash) fits, the rest is repaired.
FITS = i.h("concat(row_id, ':fit')") + " % 5 = 0"
CALIBRATED = f"""{S}, proba AS (SELECT model_key, row_id, conf, correct, {FITS} AS fits FROM conf WHERE score_type = 'proba'),
  pts AS (SELECT model_key, c, count(*) AS w, sum(correct) AS h, row_number() OVER (PARTITION BY model_key ORDER BY c) AS k
          FROM (SELECT *, round(conf, 2) AS c FROM proba WHERE fits) GROUP BY model_key, c),
  cum AS (SELECT *, sum(w) OVER z AS cw, sum(h) OVER z AS ch FROM pts WINDOW z AS (PARTITION BY model_key ORDER BY k)),
  spans AS (SELECT a.model_key, a.k AS a, b.k AS b, (b.ch - a.ch + a.h) / (b.cw - a.cw + a.w)::DOUBLE AS m
            FROM cum a JOIN cum b ON b.model_key = a.model_key AND b.k >= a.k),
  lows AS (SELECT model_key, a, b AS i, min(m) OVER (PARTITION BY model_key, a ORDER BY b DESC) AS m FROM spans),
  iso AS (SELECT p.model_key, p.c, max(l.m) AS y FROM lows l JOIN pts p ON p.model_key = l.model_key AND p.k = l.i GROUP BY ALL),
  used AS (SELECT * FROM proba WHERE NOT fits),
  below AS (SELECT u.*, i.c AS c0, i.y AS y0 FROM used u ASOF LEFT JOIN iso i ON i.model_key = u.model_key AND i.c <= u.conf),
  both_sides AS (SELECT b.*, i.c AS c1, i.y AS y1 FROM below b ASOF LEFT JOIN iso i ON i.model_key = b.model_key AND i.c >= b.conf),
  repaired AS (SELECT model_key, row_id, conf, correct, CASE WHEN c0 IS NULL THEN y1 WHEN c1 IS NULL OR c1 = c0 THEN y0
      ELSE y0 + (y1 - y0) * (conf - c0) / (c1 - c0) END AS calibrated FROM both_sides)"""


def calibrated_runs(spark, d, method="isotonic"):
    rows = cf.scored_rows(i.scored(spark, d).where(sc.calibration_allowed(F.col("score_type")))).drop("score_type")
    fits = i.hash_number(F.col("row_id"), ":fit") % 5 == 0
    return cf.calibrate(rows.where(~fits), method, rows.where(fits), 2)


@query("calibrate_isotonic", f"WITH {CALIBRATED} SELECT model_key, row_id, round(conf, 6) AS conf, correct, round(calibrated, 6) AS calibrated FROM repaired")
def _(spark, d):
    return calibrated_runs(spark, d).withColumns({c: F.round(c, 6) for c in ("conf", "calibrated")})


@query("calibration_effect", f"""WITH {CALIBRATED},
  long AS (SELECT model_key, correct, 'before' AS side, conf AS p FROM repaired UNION ALL SELECT model_key, correct, 'after', calibrated FROM repaired),
  bins AS (SELECT model_key, side, least(floor(p * 10 + 1e-12), 9) AS bin, count(*) AS n, abs(avg(correct) - avg(p)) AS gap FROM long GROUP BY ALL),
  ece AS (SELECT model_key, side, sum(n * gap) / sum(n) AS e, CAST(sum(n) AS BIGINT) AS n FROM bins GROUP BY ALL)
  SELECT b.model_key, b.n, round(b.e, 6) AS ece_before, round(a.e, 6) AS ece_after FROM ece b JOIN ece a USING (model_key) WHERE b.side = 'before' AND a.side = 'after'""")
def _(spark, d):
    found = cf.calibration_effect(calibrated_runs(spark, d))
    return found.withColumns({c: F.round(c, 6) for c in ("ece_before", "ece_after")})


@query("calibrate_platt")
def _(spark, d):
    runs = cf.scored_rows(i.scored(spark, d)).where("model_key = 'A_tuned_bayes'")
    fits = i.hash_number(F.col("row_id"), ":fit") % 5 == 0
    return cf.calibrate(runs.where(~fits), "platt", runs.where(fits))


# ---- registries and logs


def details(rows, salt=""):
    """Model name and extra fields per run."""
    return rows.select("model_key").distinct().select(
        "model_key", F.concat(F.lit("model "), F.substring("model_key", 3, 20)).alias("model"),
        F.create_map(F.lit("note"), F.concat(F.lit("seed"), F.lit(salt))).alias("extra"))


def registry(spark, d, salt=""):
    """Measured runs with model name and extras; one run has no macro-F1."""
    rows = i.predictions(spark, d, salt)
    runs = mt.evaluate_runs(rows, details(rows, salt))
    return runs.withColumn("macro_f1", F.when(F.col("model_key") != "D_prompt", F.col("macro_f1")))


def registry_sql(name: str = "reg", table: str = "predictions", salt: str = "") -> str:
    metrics = M.replace("stats", f"{name}_stats").replace("metrics AS", f"{name}_metrics AS").replace("FROM predictions", f"FROM {table}")
    return f"""{metrics}, {name} AS (SELECT model_key, round(accuracy, 4) AS accuracy,
      CASE WHEN model_key <> 'D_prompt' THEN round(macro_f1, 4) END AS macro_f1, round(weighted_f1, 4) AS weighted_f1,
      concat('model ', substr(model_key, 3, 20)) AS model, 'seed{salt}' AS note FROM {name}_metrics)"""


R = f"{P}, {registry_sql()}"
FLAT = ["model_key", "accuracy", "macro_f1", "weighted_f1", "model"]


@query("evaluate_run", f"""WITH {P}, {registry_sql()}
  SELECT r.model_key, r.accuracy, round(m.macro_f1, 4) AS macro_f1, r.weighted_f1, model, note FROM reg r JOIN reg_metrics m USING (model_key)""")
def _(spark, d):
    root, store = new_path(spark, "registry"), new_path(spark, "predictions")
    rows = i.predictions(spark, d)
    for part in (rows.where("model_key <> 'D_prompt'"), rows.where("model_key >= 'C'")):  # C is measured again
        table = rn.evaluate_and_save(part, details(part), root, store)
    return table.select(*FLAT, F.col("extra")["note"].alias("note"))


@query("upsert_result", f"""WITH {P}, {i.predictions_sql('again', ':2')}, {registry_sql()}, {registry_sql('fresh', 'again', ':2')},
  new AS (SELECT * FROM fresh WHERE model_key IN ('B_tuned_knn', 'D_prompt'))
  SELECT * FROM reg WHERE model_key NOT IN (SELECT model_key FROM new) UNION ALL SELECT * FROM new""")
def _(spark, d):
    new = registry(spark, d, ":2").where(F.col("model_key").isin("B_tuned_knn", "D_prompt"))
    return rn.upsert_results(registry(spark, d), new).select(*FLAT, F.col("extra")["note"].alias("note"))


@query("save_predictions", f"WITH {P} SELECT model_key, row_id, y_true, y_pred FROM predictions WHERE model_key IN ('A_plain_bayes', 'D_prompt')")
def _(spark, d):
    path = new_path(spark, "predictions")
    rn.save_predictions(i.predictions(spark, d), path)
    return rn.load_predictions(spark, path, ["A_plain_bayes", "D_prompt"]).select("model_key", "row_id", "y_true", "y_pred")


@query("list_models", f"WITH {P} SELECT DISTINCT model_key, model_key IN ('A_tuned_bayes', 'B_tuned_knn', 'C_plain_net') AS has_scores FROM predictions")
def _(spark, d):
    scored = i.scored(spark, d)
    rest = i.predictions(spark, d).where(~F.col("model_key").isin(i.SCORED))
    return rn.list_models(scored.unionByName(rest, allowMissingColumns=True))


GEN = "CASE upper(substr({0}, 1, 1)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sc.GENERATION.items()) + " ELSE substr({0}, 1, 1) END"


@query("derive_generation", f"""WITH {P}, k AS (SELECT model_key AS key, count(*) AS n FROM predictions GROUP BY 1
  UNION ALL SELECT event_type, count(*) FROM events GROUP BY 1) SELECT key, n, {GEN.format('key')} AS generation FROM k""")
def _(spark, d):
    runs = i.predictions(spark, d).groupBy(F.col("model_key").alias("key")).agg(F.count("*").alias("n"))
    types = i.table(spark, d, "events").groupBy(F.col("event_type").alias("key")).agg(F.count("*").alias("n"))
    return runs.unionByName(types).withColumn("generation", sc.generation(F.col("key")))


@query("scoreboard", f"""WITH {R} SELECT model, {GEN.format('model_key')} AS generation, round(accuracy * 100, 2) AS accuracy_pct,
  round(coalesce(macro_f1, 0) * 100, 2) AS macro_f1_pct, model_key FROM reg""")
def _(spark, d):
    return rn.scoreboard(registry(spark, d))


PAIRS = [("A · Bayes", "A_plain_bayes", "A_tuned_bayes"), ("B · kNN", "B_plain_knn", "B_tuned_knn"),
         ("C · Net", "C_plain_net", "C_tuned_net")]
PAIRS_SQL = ", ".join(str(p) for p in PAIRS)


@query("tuning_delta", f"""WITH {R} SELECT strategy, {GEN.format('strategy')} AS generation, round(p.accuracy * 100, 2) AS plain_pct,
  round(t.accuracy * 100, 2) AS tuned_pct, round((t.accuracy - p.accuracy) * 100, 2) AS delta_points
  FROM (VALUES {PAIRS_SQL}) v(strategy, pk, tk) JOIN reg p ON p.model_key = pk JOIN reg t ON t.model_key = tk""")
def _(spark, d):
    pairs = spark.createDataFrame(PAIRS, "strategy string, plain_key string, tuned_key string")
    return rn.tuning_deltas(registry(spark, d), pairs)


def measurements(spark, d):
    """Latency per run from the event log; parameters from the users seen, null for one run."""
    place = F.array_position(F.lit(i.EVENT_TYPES), F.col("event_type"))
    keys = F.lit([k for k, _ in i.RUNS[:4]] + ["X_unknown"])
    log = i.table(spark, d, "events").select(
        F.element_at(keys, place.cast("int")).alias("family"), F.col("value").alias("latency_ms"), "ts", "event_id", "user_id")
    timed = mt.latency_summary(log, ["ts", "event_id"], digits=4)
    users = log.groupBy("family").agg(F.countDistinct("user_id").alias("users"), F.count("*").alias("n"))
    params = F.when(F.col("family") != "B_plain_knn", F.col("n") / 100)
    return timed.join(users, "family").select(
        F.col("family").alias("result_key"), F.concat(F.lit("family "), "family").alias("family"),
        params.alias("params_mio"), "latency_ms", (F.col("users") * 4.0).alias("size_mb"))


KEYS = "[" + ", ".join(f"'{k}'" for k in [k for k, _ in i.RUNS[:4]] + ["X_unknown"]) + "]"
LOG = f"""log AS (SELECT {KEYS}[list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type)] AS family, value AS latency_ms, ts, event_id, user_id FROM events),
  timed AS (SELECT family, count(*) AS n_measured, round(quantile_cont(latency_ms, 0.5), 4) AS latency_ms FROM (SELECT *,
    row_number() OVER (PARTITION BY family ORDER BY ts, event_id) AS p FROM log) WHERE p BETWEEN 6 AND 35 GROUP BY family)"""
OPS = f"""{R}, {LOG}, meas AS (SELECT t.family AS result_key, concat('family ', t.family) AS family,
    CASE WHEN t.family <> 'B_plain_knn' THEN u.n / 100 END AS params_mio, latency_ms, u.users * 4.0::DOUBLE AS size_mb
    FROM timed t JOIN (SELECT family, count(DISTINCT user_id) AS users, count(*) AS n FROM log GROUP BY family) u USING (family)),
  ops AS (SELECT family, params_mio, latency_ms, size_mb, round(accuracy * 100, 2) AS accuracy_pct FROM meas LEFT JOIN reg ON model_key = result_key)"""


@query("latency_summary", f"WITH {LOG} SELECT * FROM timed")
def _(spark, d):
    rows = i.table(spark, d, "events")
    place = F.array_position(F.lit(i.EVENT_TYPES), F.col("event_type"))
    keys = F.lit([k for k, _ in i.RUNS[:4]] + ["X_unknown"])
    log = rows.select(F.element_at(keys, place.cast("int")).alias("family"), F.col("value").alias("latency_ms"), "ts", "event_id")
    return mt.latency_summary(log, ["ts", "event_id"], digits=4)


@query("ops_with_accuracy", f"WITH {OPS} SELECT * FROM ops")
def _(spark, d):
    return rn.measurements_with_accuracy(measurements(spark, d), registry(spark, d))


@query("efficiency_frontier", f"""WITH {OPS} SELECT family, params_mio, accuracy_pct, coalesce(accuracy_pct > max(accuracy_pct) OVER
    (ORDER BY params_mio, accuracy_pct DESC, family ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS on_frontier
  FROM ops WHERE params_mio IS NOT NULL AND accuracy_pct IS NOT NULL""")
def _(spark, d):
    return rn.efficiency_frontier(rn.measurements_with_accuracy(measurements(spark, d), registry(spark, d)))


@query("rank_shift", f"""WITH {R}, r AS (SELECT model_key, rank() OVER (ORDER BY accuracy DESC) AS rank_accuracy,
    rank() OVER (ORDER BY macro_f1 DESC NULLS LAST) AS rank_macro_f1 FROM reg)
  SELECT *, rank_accuracy - rank_macro_f1 AS places_gained FROM r""")
def _(spark, d):
    return rn.rank_shift(registry(spark, d))


@query("experiment_log", """SELECT event_type AS key, event_id AS seq, value AS metric, props AS config FROM (SELECT *,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS p FROM events) WHERE p = 1""")
def _(spark, d):
    path = new_path(spark, "log")
    entries = i.table(spark, d, "events").select(
        F.col("event_type").alias("key"), F.col("event_id").alias("seq"), F.col("value").alias("metric"), F.col("props").alias("config"))
    rn.append_log(entries.where("metric < 100"), path)
    rn.append_log(entries.where("metric >= 100"), path)
    return rn.latest_runs(spark.read.parquet(path))


TRIALS = "trials AS (SELECT event_type AS run, CAST(day(ts) AS BIGINT) AS epoch, round(avg(value) / 100, 6) AS val_f1 FROM events GROUP BY ALL)"


@query("best_config", f"""WITH {TRIALS} SELECT run, val_f1 AS best_val_f1, epoch AS best_epoch, greatest(1, epoch) AS refit_epochs
  FROM trials ORDER BY val_f1 DESC, run, epoch LIMIT 1""")
def _(spark, d):
    return tn.best_config(i.trials(spark, d))


@query("early_stop_epoch", f"""WITH {TRIALS}, m AS (SELECT *, row_number() OVER w AS s, coalesce(val_f1 > max(val_f1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS up
    FROM trials WINDOW w AS (PARTITION BY run ORDER BY epoch)),
  x AS (SELECT *, s - max(CASE WHEN up THEN s END) OVER (PARTITION BY run ORDER BY epoch) AS idle FROM m),
  g AS (SELECT run, min(CASE WHEN idle >= 2 THEN epoch END) AS stop, max(epoch) AS fin FROM x GROUP BY run)
  SELECT run, coalesce(stop, fin) AS stop_epoch, stop IS NOT NULL AS stopped_early FROM g""")
def _(spark, d):
    return tn.early_stop_epoch(i.trials(spark, d))


# ---- batch labelling

LABELS = ["de", "en", "es", "fr"]
TASK = "Answer with one label only.\n\nValid labels:\n"
BLOCK = TASK + "\n".join(LABELS)


@query("zero_shot_prompts", f"""SELECT doc_id AS row_id, to_json([{{'role': 'system', 'content': '{BLOCK}'}}, {{'role': 'user', 'content': text}}])::VARCHAR AS messages FROM documents""")
def _(spark, d):
    rows = lb.prompts(i.corpus(spark, d), lb.zero_shot(TASK, LABELS))
    return rows.withColumn("messages", F.to_json("messages"))


DEMOS = """turns AS (SELECT label, pick, 0 AS side, {'role': 'user', 'content': text} AS turn FROM picks
    UNION ALL SELECT label, pick, 1, {'role': 'assistant', 'content': label} FROM picks),
  shots AS (SELECT list(turn ORDER BY label, pick, side) AS demos FROM turns)"""


@query("few_shot_prompts", f"""WITH {C}, {SAMPLE}, {DEMOS} SELECT row_id, md5(to_json(list_concat([{{'role': 'system', 'content': '{BLOCK}'}}], demos,
    [{{'role': 'user', 'content': text}}]))::VARCHAR) AS digest, CAST(len(demos) + 2 AS BIGINT) AS n_turns FROM corpus, shots""")
def _(spark, d):
    rows = i.corpus(spark, d)
    demos = lb.demo_turns(sp.stratified_subsample(i.train_part(rows), 2))
    made = lb.prompts(rows, lb.few_shot(TASK, LABELS, demos))
    return made.select("row_id", F.md5(F.to_json("messages")).alias("digest"), F.size("messages").cast("bigint").alias("n_turns"))


def key_sql(column: str) -> str:
    system = json.dumps(BLOCK)
    return f"""sha256(concat('{{"extra": {{}}, "max_tokens": 30, "messages": [{{"content": ', '{system}', ', "role": "system"}}, {{"content": ',
      to_json({column})::VARCHAR, ', "role": "user"}}], "model": "stub-1", "temperature": 0.0}}'))"""


@query("prompt_cache_key", f"SELECT doc_id AS row_id, {key_sql('text')} AS cache_key FROM documents")
def _(spark, d):
    make = lb.zero_shot(TASK, LABELS)
    key = an.prompt_cache_key(make(F.col("text")), "stub-1", 0.0, 30)
    return i.corpus(spark, d).select("row_id", key.alias("cache_key"))


def stub_completer(messages: pd.Series) -> pd.Series:
    """Deterministic stand-in for a language model: answers from the text's length."""
    def one(turns: str):
        n = len(json.loads(turns)[-1]["content"])
        return [f"The label is {LABELS[n % 4]}.", LABELS[n % 4].upper(), "not sure", None][n % 7 % 4]

    return messages.map(one)


STUB = """CASE length(text) % 7 % 4 WHEN 0 THEN concat('The label is ', ['de', 'en', 'es', 'fr'][length(text) % 4 + 1], '.')
  WHEN 1 THEN upper(['de', 'en', 'es', 'fr'][length(text) % 4 + 1]) WHEN 2 THEN 'not sure' END"""


@query("cached_completion", f"SELECT doc_id AS row_id, {key_sql('text')} AS cache_key, {STUB} AS raw FROM documents")
def _(spark, d):
    path, rows = new_path(spark, "answers"), i.corpus(spark, d)
    make = lb.zero_shot(TASK, LABELS)
    run = lambda part: lb.cached_completion(part, make, stub_completer, path, "stub-1", max_tokens=30)
    run(i.test_part(rows))  # an interrupted first run leaves a part of the answers
    return run(rows)


@query("classify", f"""WITH a AS (SELECT doc_id AS row_id, {STUB} AS raw FROM documents)
  SELECT row_id, raw, CASE WHEN raw IS NULL OR raw = 'not sure' THEN 'unknown' WHEN length(raw) = 2 THEN lower(raw)
    ELSE substr(raw, 14, 2) END AS y_pred FROM a""")
def _(spark, d):
    made = lb.classify(i.corpus(spark, d), LABELS, lb.zero_shot(TASK, LABELS), stub_completer,
                       new_path(spark, "answers"), "stub-1", max_tokens=30)
    return made.select("row_id", "raw", "y_pred")


@query("parse_label", f"WITH {A} SELECT row_id, raw, y_pred FROM parsed")
def _(spark, d):
    return i.answers(spark, d).select("row_id", "raw", an.parse_label(F.col("raw"), i.EVENT_TYPES).alias("y_pred"))


@query("prompt_variant_report", f"""WITH {A}, predictions AS (SELECT 'parsed' AS model_key, row_id, gold AS y_true, y_pred FROM parsed
    UNION ALL SELECT 'strict', row_id, gold, CASE WHEN raw = gold THEN raw ELSE 'unknown' END FROM parsed), {M}
  SELECT model_key, n, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1,
    (SELECT count(*) FROM predictions p WHERE p.model_key = m.model_key AND y_pred = 'unknown') AS n_unknown FROM metrics m""")
def _(spark, d):
    rows = i.answers(spark, d)
    loose = an.parse_label(F.col("raw"), i.EVENT_TYPES)
    strict = F.when(F.col("raw") == F.col("gold"), F.col("raw")).otherwise("unknown")
    both = F.array(F.struct(F.lit("parsed").alias("model_key"), loose.alias("y_pred")),
                   F.struct(F.lit("strict").alias("model_key"), strict.alias("y_pred")))
    return mt.prompt_variant_report(rows.select("row_id", F.col("gold").alias("y_true"), F.inline(both)))


@query("misses", f"WITH {A} SELECT row_id, raw, y_pred, gold FROM parsed WHERE y_pred <> gold ORDER BY row_id LIMIT 8")
def _(spark, d):
    return lb.misses(i.answers(spark, d).withColumn("y_pred", an.parse_label(F.col("raw"), i.EVENT_TYPES)))


@query("self_consistency", f"""WITH {P}, v AS (SELECT row_id, y_pred, count(*) AS n FROM predictions WHERE model_key IN ('A_plain_bayes', 'B_plain_knn', 'D_prompt') GROUP BY ALL)
  SELECT row_id, arg_min(y_pred, (-n, y_pred)) AS y_pred FROM v GROUP BY row_id""")
def _(spark, d):
    votes = i.predictions(spark, d).where(F.col("model_key").isin("A_plain_bayes", "B_plain_knn", "D_prompt"))
    return lb.self_consistency(votes)


@query("keyword_classifier", f"""WITH {C}, tw AS (SELECT label, word FROM (SELECT label, word,
      row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, word) AS place
      FROM (SELECT label, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM corpus WHERE split = 'train')
      WHERE word NOT IN ({i.STOP_SQL}) GROUP BY label, word) WHERE place <= 20),
    kw AS (SELECT label, word FROM tw QUALIFY count(*) OVER (PARTITION BY word) = 1),
    tok AS (SELECT row_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM corpus WHERE split = 'test'),
    hit AS (SELECT row_id, kw.label, count(*) AS n FROM tok JOIN kw USING (word) GROUP BY ALL)
  SELECT c.row_id, coalesce(arg_min(hit.label, (-n, hit.label)), 'unknown') AS y_pred FROM corpus c LEFT JOIN hit USING (row_id) WHERE split = 'test' GROUP BY c.row_id""")
def _(spark, d):
    rows = i.corpus(spark, d)
    return lb.keyword_classifier(i.test_part(rows), lb.keyword_list(i.train_part(rows), 20, i.STOP_WORDS))
