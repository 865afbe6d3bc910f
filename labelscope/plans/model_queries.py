"""Registered queries: features, classifiers, tuning, neighbours."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from labelscope.functions import scores as sc
from labelscope.functions import text as tx
from labelscope.operators import audit as au
from labelscope.operators import augment as ag
from labelscope.operators import bayes as nb
from labelscope.operators import chunks as ck
from labelscope.operators import features as ft
from labelscope.operators import heads as hd
from labelscope.operators import hinge as hg
from labelscope.operators import metrics as mt
from labelscope.operators import neighbours as nn
from labelscope.operators import split as sp
from labelscope.operators import tuning as tn
from labelscope.plans import inputs as i
from labelscope.plans.registry import query
from labelscope.plans.score_queries import REPORT
from labelscope.plans.text_queries import C, C20, part_sql
from labelscope.runtime import new_path, stored

# Units of a text in SQL, and the terms made of a unit and the ones after it.
TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
CHARS = f"string_split(regexp_replace(lower(text), '[{i.WS}]{{2,}}', ' ', 'g'), '')"
UNIGRAMS = "SELECT row_id, label, fit, u AS term FROM units"
NEXT = "lead(u{0}) OVER (PARTITION BY row_id, fit ORDER BY pos)"
BIGRAMS = f"{UNIGRAMS} UNION ALL SELECT row_id, label, fit, concat(u, ' ', nxt) FROM (SELECT *, {NEXT.format('')} AS nxt FROM units) WHERE nxt IS NOT NULL"
TRIGRAMS = f"SELECT row_id, label, fit, concat(u, a, b) FROM (SELECT *, {NEXT.format('')} AS a, {NEXT.format(', 2')} AS b FROM units) WHERE b IS NOT NULL"

# Rows of a query: label = language (fit on train, evaluated on test), or label = source
# (fit on the train part of a validation split, evaluated on its val part).
LANG_ROWS = f"{C}, rows AS (SELECT row_id, label, text, split = 'train' AS fit FROM corpus)"
VAL_ROWS = f"{C20}, {part_sql()}, rows AS (SELECT row_id, label, text, part = 'train' AS fit FROM parts)"
TEST_ROWS = f"{C20}, rows AS (SELECT row_id, label, text, split = 'train' AS fit FROM corpus)"
DEFAULT = [("0", 1, False, 1.0, True)]


def tfidf_sql(configs=DEFAULT, grams: str = UNIGRAMS, units: str = TOKENS) -> str:
    """CTEs cfgs .. weights (cfg, row_id, label, fit, term, weight) over rows."""
    values = ", ".join(f"('{c}', {m}, {s}, {a}::DOUBLE, {p})" for c, m, s, a, p in configs)
    return f"""cfgs(cfg, min_df, sub, alpha, fp) AS (VALUES {values}),
  units AS (SELECT row_id, label, fit, unnest(l) AS u, generate_subscripts(l, 1) AS pos FROM (SELECT row_id, label, fit, {units} AS l FROM rows)),
  terms AS (SELECT row_id, label, fit, term, count(*) AS tf FROM ({grams}) g(row_id, label, fit, term) GROUP BY ALL),
  dfs AS (SELECT term, count(*) AS df FROM terms WHERE fit GROUP BY term),
  size AS (SELECT count(*) AS n FROM rows WHERE fit),
  raw_w AS (SELECT cfg, row_id, label, fit, term, CASE WHEN sub THEN 1 + ln(tf) ELSE tf END * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS w
            FROM terms JOIN dfs USING (term), size, cfgs WHERE df >= min_df),
  weights AS (SELECT cfg, row_id, label, fit, term, w / sqrt(sum(w * w) OVER (PARTITION BY cfg, row_id, fit)) AS weight FROM raw_w)"""


def bayes_sql(configs=DEFAULT) -> str:
    """CTEs up to jll (cfg, row_id, y_true, c, s) and predictions of multinomial Naive Bayes."""
    return f"""{tfidf_sql(configs)},
  classes AS (SELECT label AS c, count(*) AS nc FROM rows WHERE fit GROUP BY label),
  vocab AS (SELECT cfg, count(DISTINCT term) AS v FROM weights WHERE fit GROUP BY cfg),
  tc AS (SELECT cfg, label AS c, term, sum(weight) AS s FROM weights WHERE fit GROUP BY ALL),
  tot AS (SELECT cfg, c, sum(s) AS t FROM tc GROUP BY ALL),
  ll AS (SELECT x.cfg, x.row_id, tot.c, sum(x.weight * (ln(coalesce(tc.s, 0) + alpha) - ln(tot.t + alpha * v))) AS l
         FROM weights x JOIN tot ON tot.cfg = x.cfg JOIN vocab ON vocab.cfg = x.cfg JOIN cfgs ON cfgs.cfg = x.cfg
         LEFT JOIN tc ON tc.cfg = x.cfg AND tc.c = tot.c AND tc.term = x.term WHERE NOT x.fit GROUP BY ALL),
  jll AS (SELECT cfgs.cfg, r.row_id, r.label AS y_true, k.c,
            CASE WHEN fp THEN ln(k.nc / n) ELSE -ln((SELECT count(*) FROM classes)) END + coalesce(ll.l, 0) AS s
          FROM rows r, classes k, cfgs, size LEFT JOIN ll ON ll.cfg = cfgs.cfg AND ll.row_id = r.row_id AND ll.c = k.c WHERE NOT r.fit),
  predictions AS (SELECT cfg AS model_key, row_id, any_value(y_true) AS y_true, arg_min(c, (-s, c)) AS y_pred, max(s) AS top FROM jll GROUP BY cfg, row_id)"""


def lang_parts(spark, d):
    rows = i.corpus(spark, d)
    return i.train_part(rows), i.test_part(rows)


def source_parts(spark, d):
    """Train, val and test rows labelled by source, stored for repeated evaluation."""
    rows = i.corpus(spark, d, "source")
    train = stored(sp.stratified_split(i.train_part(rows)), "parts")
    return train.where("part = 'train'").drop("part"), train.where("part = 'val'").drop("part"), i.test_part(rows)


# ---- features


def tfidf_query(name, sql, **options):
    @query(name, sql)
    def _(spark, d):
        _, weights = ft.fit_transform_tfidf(i.corpus(spark, d), F.col("split") == "train", **options)
        return weights.withColumn("weight", F.round("weight", 6))


def weights_sql(min_df=1, sub=False, grams=UNIGRAMS):
    return f"WITH {LANG_ROWS}, {tfidf_sql([('0', min_df, sub, 1.0, True)], grams)} SELECT row_id, term, round(weight, 6) AS weight FROM weights"


tfidf_query("tfidf", weights_sql())
tfidf_query("tfidf_bigrams", weights_sql(grams=BIGRAMS), ngram_range=(1, 2))
tfidf_query("tfidf_min_df", weights_sql(min_df=2), min_df=2)
tfidf_query("tfidf_sublinear", weights_sql(sub=True), sublinear_tf=True)


@query("char_ngrams", f"""WITH {LANG_ROWS}, {tfidf_sql([('0', 2, False, 1.0, True)], TRIGRAMS, CHARS)}
  SELECT row_id, count(*) AS n_terms, round(sum(weight), 6) AS total FROM weights GROUP BY row_id""")
def _(spark, d):
    rows = i.corpus(spark, d)
    model = ft.fit_tfidf(i.train_part(rows), analyzer="char", ngram_range=(3, 3), min_df=2)
    return model.transform(rows).groupBy("row_id").agg(
        F.count("*").alias("n_terms"), F.round(F.sum("weight"), 6).alias("total"))


@query("l2_normalise", """SELECT vec_id, round(sqrt(list_dot_product(u, u)), 6) AS norm_before, round(u[1] / sqrt(list_dot_product(u, u)), 6) AS first
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[])[1:32] AS u FROM embeddings)""")
def _(spark, d):
    return i.vectors(spark, d, 32).select("vec_id", F.round(sc.vector_norm(F.col("v")), 6).alias("norm_before"),
                                          F.round(sc.l2_normalise(F.col("v"))[0], 6).alias("first"))


@query("embed_corpus_cached", """WITH w AS (SELECT doc_id, md5(word) AS m FROM (SELECT doc_id,
    unnest(regexp_extract_all(lower(concat('query: ', text)), '[a-z]+')) AS word FROM documents)),
  n AS (SELECT doc_id, CAST(concat('0x', substr(m, 1, 8)) AS BIGINT) AS x FROM w),
  b AS (SELECT doc_id, x % 64 AS dim, CAST(sum(CASE WHEN (x // 64) % 2 = 0 THEN 1 ELSE -1 END) AS DOUBLE) AS s FROM n GROUP BY ALL),
  u AS (SELECT doc_id, dim, s / sqrt(sum(s * s) OVER (PARTITION BY doc_id)) AS v FROM b)
  SELECT doc_id AS row_id, dim, round(v, 6) AS v FROM u WHERE v <> 0""")
def _(spark, d):
    rows, path = i.corpus(spark, d), new_path(spark, "vectors")
    run = lambda part: ft.embed_corpus_cached(part, path, ft.hashed_encoder(64), "hashed-64", prefix="query: ")
    run(i.test_part(rows))  # the second call only encodes what is missing
    long = run(rows).select("row_id", F.posexplode("v").alias("dim", "v")).where("v <> 0")
    return long.select("row_id", F.col("dim").cast("bigint").alias("dim"), F.round("v", 6).alias("v"))


CHUNK_CTES = f"""words AS (SELECT doc_id, list_filter(regexp_split_to_array({i.strip_sql("coalesce(text, '')")}, '[{i.WS}]+'), lambda w: w <> '') AS l FROM documents),
  cut AS (SELECT doc_id, unnest(range(0, CAST(greatest(ceil((len(l) - 128) / 96.0), 0) AS BIGINT) + 1)) AS chunk, l FROM words),
  chunks AS (SELECT doc_id, chunk, 96 * chunk AS start, least(96 * chunk + 128, len(l)) AS "end",
             array_to_string(l[96 * chunk + 1 : 96 * chunk + 128], ' ') AS text FROM cut)"""


@query("text_chunks", f"""WITH {CHUNK_CTES} SELECT doc_id AS row_id, chunk, start, "end", md5(text) AS digest FROM chunks""")
def _(spark, d):
    return ck.chunks(i.corpus(spark, d), 128, 96).select("row_id", "chunk", "start", "end", F.md5("text").alias("digest"))


@query("chunk_and_pool", f"""WITH {CHUNK_CTES},
  w AS (SELECT doc_id, chunk, CAST(concat('0x', substr(md5(word), 1, 8)) AS BIGINT) AS x
        FROM (SELECT doc_id, chunk, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM chunks)),
  b AS (SELECT doc_id, chunk, x % 16 AS dim, CAST(sum(CASE WHEN (x // 16) % 2 = 0 THEN 1 ELSE -1 END) AS DOUBLE) AS s FROM w GROUP BY ALL),
  u AS (SELECT doc_id, chunk, dim, s / sqrt(sum(s * s) OVER (PARTITION BY doc_id, chunk)) AS v FROM b QUALIFY sum(s * s) OVER (PARTITION BY doc_id, chunk) > 0),
  n AS (SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id)
  SELECT c.doc_id AS row_id, n.n AS n_chunks, t.dim, round(sum(coalesce(u.v, 0)) / n.n, 6) AS mean, round(max(coalesce(u.v, 0)), 6) AS largest
  FROM chunks c CROSS JOIN range(0, 16) t(dim) JOIN n ON n.doc_id = c.doc_id LEFT JOIN u ON u.doc_id = c.doc_id AND u.chunk = c.chunk AND u.dim = t.dim
  GROUP BY c.doc_id, n.n, t.dim""")
def _(spark, d):
    path = new_path(spark, "chunk-vectors")
    encode = lambda rows: ft.embed_corpus_cached(rows, path, ft.hashed_encoder(16), "hashed-16")
    found = ck.chunk_and_pool(i.corpus(spark, d), encode, 128, 96)
    long = found.select("row_id", "n_chunks", F.posexplode(F.arrays_zip("mean", "largest")).alias("dim", "z"))
    return long.select("row_id", "n_chunks", F.col("dim").cast("bigint").alias("dim"), (F.round("z.mean", 6) + 0.0).alias("mean"), (F.round("z.largest", 6) + 0.0).alias("largest"))


# ---- Naive Bayes


@query("multinomial_nb", f"WITH {LANG_ROWS}, {bayes_sql()} SELECT row_id, y_true, y_pred, round(top, 6) AS top FROM predictions")
def _(spark, d):
    found = tn.bayes_predictions(*lang_parts(spark, d), {})
    return found.select("row_id", "y_true", "y_pred", F.round(F.array_max("scores"), 6).alias("top"))


@query("multinomial_nb_tuned", f"""WITH {TEST_ROWS}, {bayes_sql([('0', 2, True, 0.1, False)])}
  SELECT row_id, y_true, y_pred, round(top, 6) AS top FROM predictions""")
def _(spark, d):
    rows = i.corpus(spark, d, "source")
    config = {"min_df": 2, "sublinear_tf": True, "alpha": 0.1, "fit_prior": False}
    found = tn.bayes_predictions(i.train_part(rows), i.test_part(rows), config)
    return found.select("row_id", "y_true", "y_pred", F.round(F.array_max("scores"), 6).alias("top"))


def complement_sql(norm: bool) -> str:
    weight = "lg / sum(lg) OVER (PARTITION BY c)" if norm else "-lg"
    return f"""WITH {LANG_ROWS}, {tfidf_sql()},
  tc AS (SELECT label AS c, term, sum(weight) AS s FROM weights WHERE fit GROUP BY ALL),
  every AS (SELECT term, sum(s) AS a FROM tc GROUP BY term),
  comp AS (SELECT k.c, e.term, e.a + 1.0 - coalesce(tc.s, 0) AS v FROM every e CROSS JOIN (SELECT DISTINCT c FROM tc) k
           LEFT JOIN tc ON tc.c = k.c AND tc.term = e.term),
  lgs AS (SELECT c, term, ln(v / sum(v) OVER (PARTITION BY c)) AS lg FROM comp),
  cw AS (SELECT c, term, {weight} AS cw FROM lgs),
  jll AS (SELECT row_id, any_value(label) AS y_true, c, sum(weight * cw) AS s FROM weights JOIN cw USING (term) WHERE NOT fit GROUP BY row_id, c)
  SELECT row_id, any_value(y_true) AS y_true, arg_min(c, (-s, c)) AS y_pred, round(max(s), 6) AS top FROM jll GROUP BY row_id
  UNION ALL SELECT row_id, label, (SELECT min(c) FROM tc), 0.0 FROM rows WHERE NOT fit AND row_id NOT IN (SELECT row_id FROM jll)"""


def complement_query(name: str, norm: bool):
    @query(name, complement_sql(norm))
    def _(spark, d):
        found = tn.bayes_predictions(*lang_parts(spark, d), {"norm": norm}, "complement")
        return found.select("row_id", "y_true", "y_pred", F.round(F.array_max("scores"), 6).alias("top"))


complement_query("complement_nb", False)
complement_query("complement_nb_norm", True)


@query("bayes_class_report", f"WITH {LANG_ROWS}, {bayes_sql()}, {i.METRICS_SQL}, {REPORT} SELECT label, precision, recall, f1, support FROM report")
def _(spark, d):
    return mt.class_report(tn.bayes_predictions(*lang_parts(spark, d), {})).drop("model_key")


@query("model_scores", f"""WITH {LANG_ROWS}, {bayes_sql()}
  SELECT row_id, c AS label, 'proba' AS score_type, round(exp(s - max(s) OVER w) / sum(exp(s - m)) OVER w * exp(max(s) OVER w - m), 6) AS score
  FROM (SELECT *, max(s) OVER (PARTITION BY row_id) AS m FROM jll) WINDOW w AS (PARTITION BY row_id)""")
def _(spark, d):
    found = tn.bayes_predictions(*lang_parts(spark, d), {})
    long = found.select("row_id", F.explode(F.arrays_zip("classes", sc.softmax(F.col("scores")).alias("p"))).alias("z"))
    return long.select("row_id", F.col("z.classes").alias("label"), F.lit("proba").alias("score_type"),
                       F.round(F.col("z")["p"], 6).alias("score"))


@query("explain_linear", f"""WITH {LANG_ROWS}, {bayes_sql()},
  lp AS (SELECT tot.c, e.term, ln(coalesce(tc.s, 0) + 1.0) - ln(tot.t + v) AS lp FROM (SELECT DISTINCT term FROM tc) e, tot, vocab
         LEFT JOIN tc ON tc.c = tot.c AND tc.term = e.term),
  adv AS (SELECT c AS label, term, lp - avg(lp) OVER (PARTITION BY term) AS a FROM lp),
  r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(a, 9) DESC, term) AS place FROM adv)
  SELECT label, place, term, round(a, 6) AS advantage FROM r WHERE place <= 10""")
def _(spark, d):
    train, _ = lang_parts(spark, d)
    model = ft.fit_tfidf(train)
    fitted = nb.fit_multinomial_nb(model.transform(train, ("label",)), train.select("row_id", "label"), n_terms=model.n_terms)
    return fitted.strongest_terms(10).withColumn("advantage", F.round("advantage", 6))


@query("save_load_model", f"WITH {LANG_ROWS}, {bayes_sql()} SELECT row_id, y_pred FROM predictions")
def _(spark, d):
    train, test = lang_parts(spark, d)
    model, path = ft.fit_tfidf(train), new_path(spark, "model")
    nb.fit_multinomial_nb(model.transform(train, ("label",)), train.select("row_id", "label"), n_terms=model.n_terms).save(path)
    counts = stored(ft.term_counts(test, model.options), "terms")
    return nb.BayesModel.load(spark, path).predict_counts(test, counts, model).select("row_id", "y_pred")


@query("invariance_check", f"""WITH {C}, swapped AS (SELECT row_id, label, text FROM corpus WHERE split = 'test' AND regexp_matches(text, '\\bthe\\b')),
  rows AS (SELECT row_id, label, text, true AS fit FROM corpus WHERE split = 'train'
    UNION ALL SELECT row_id, label, text, false FROM swapped
    UNION ALL SELECT -1 - row_id, label, regexp_replace(text, '\\bthe\\b', 'der', 'g'), false FROM swapped), {bayes_sql()}
  SELECT count(*) AS n_touched, count(*) FILTER (a.y_pred = b.y_pred) AS n_stable, round(count(*) FILTER (a.y_pred = b.y_pred) / count(*), 6) AS stable_share
  FROM predictions a JOIN predictions b ON b.row_id = -1 - a.row_id WHERE a.row_id >= 0""")
def _(spark, d):
    train, test = lang_parts(spark, d)
    model = ft.fit_tfidf(train)
    fitted = nb.fit_multinomial_nb(model.transform(train, ("label",)), train.select("row_id", "label"), n_terms=model.n_terms)
    cut = lambda rows: stored(ft.term_counts(rows, model.options), "terms")
    return tn.invariance_check(lambda rows: fitted.predict_counts(rows, cut(rows), model), test, "the", "der")


# ---- suspicious labels: train rows, a twentieth of them under the label of another language

FLIPPED = i.h("concat(row_id, ':flip')") + " % 20 = 0"
OOF = f"""{C}, names AS (SELECT list_sort(list(DISTINCT label)) AS l FROM corpus WHERE split = 'train'),
  given AS (SELECT row_id, text, CASE WHEN {FLIPPED} THEN l[list_position(l, label) % len(l) + 1] ELSE label END AS label
            FROM corpus, names WHERE split = 'train'),
  rows AS (SELECT row_id, label, text, true AS fit FROM given), {tfidf_sql()},
  folds AS (SELECT row_id, label, (row_number() OVER (PARTITION BY label ORDER BY substr(md5(concat(row_id, ':42')), 1, 8), row_id) - 1) % 5 AS fold FROM given),
  fw AS (SELECT f.row_id, f.label, f.fold, w.term, w.weight FROM weights w JOIN folds f ON f.row_id = w.row_id),
  cell AS (SELECT term, label, fold, sum(weight) AS s FROM fw GROUP BY ALL),
  whole AS (SELECT term, label, sum(s) AS s FROM cell GROUP BY ALL),
  v AS (SELECT count(DISTINCT term) AS v FROM cell),
  kf AS (SELECT k.c, f.fold, (SELECT count(*) FROM folds x WHERE x.label = k.c AND x.fold <> f.fold) AS nc,
           (SELECT count(*) FROM folds x WHERE x.fold <> f.fold) AS n, (SELECT coalesce(sum(s), 0) FROM cell x WHERE x.label = k.c AND x.fold <> f.fold) AS t
         FROM (SELECT DISTINCT label AS c FROM folds) k, (SELECT DISTINCT fold FROM folds) f),
  ll AS (SELECT x.row_id, kf.c, sum(x.weight * (ln(greatest(coalesce(w.s, 0) - coalesce(e.s, 0), 0) + 1.0) - ln(kf.t + v))) AS l
         FROM fw x JOIN kf ON kf.fold = x.fold, v LEFT JOIN whole w ON w.term = x.term AND w.label = kf.c
         LEFT JOIN cell e ON e.term = x.term AND e.label = kf.c AND e.fold = x.fold GROUP BY ALL),
  jll AS (SELECT f.row_id, f.label, kf.c, CASE WHEN kf.nc > 0 THEN ln(kf.nc / kf.n) + coalesce(ll.l, 0) ELSE -1e300 END AS s
          FROM folds f JOIN kf ON kf.fold = f.fold LEFT JOIN ll ON ll.row_id = f.row_id AND ll.c = kf.c),
  prob AS (SELECT row_id, label, c, round(exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY row_id), 9) AS p
           FROM (SELECT *, max(s) OVER (PARTITION BY row_id) AS m FROM jll)),
  lim AS (SELECT c, round(avg(p), 9) AS t FROM prob WHERE c = label GROUP BY c),
  sure AS (SELECT row_id, arg_min(c, (-p, c)) AS confident, max(p) AS best FROM prob JOIN lim USING (c) WHERE p >= t GROUP BY row_id),
  conf AS (SELECT o.row_id, o.label, s.confident, o.p AS own, s.best FROM prob o LEFT JOIN sure s USING (row_id) WHERE o.c = o.label)"""


def confident(spark, d):
    rows = i.train_part(i.corpus(spark, d))
    names = sorted(r["label"] for r in rows.select("label").distinct().collect())
    after = F.create_map(*[F.lit(x) for c, other in zip(names, names[1:] + names[:1]) for x in (c, other)])
    flipped = i.hash_number(F.col("row_id"), ":flip") % 20 == 0
    rows = rows.withColumn("label", F.when(flipped, after[F.col("label")]).otherwise(F.col("label")))
    model = ft.fit_tfidf(rows)
    weights = model.weigh(stored(ft.term_counts(rows, model.options), "terms"))
    scored = stored(au.out_of_fold_scores(stored(sp.stratified_folds(rows, 5), "folds"), weights), "out-of-fold")
    return stored(au.confident_labels(scored), "confident")


@query("suspicious_labels", f"""WITH {OOF} SELECT row_id, label, confident AS suggested, round(own, 6) AS own, round(best, 6) AS best, round(round(best - own, 9), 6) AS margin,
  row_number() OVER (ORDER BY round(best - own, 9) DESC, row_id) AS place FROM conf WHERE confident <> label""")
def _(spark, d):
    found = au.suspicious_labels(confident(spark, d))
    return found.select("row_id", "label", "suggested", *[F.round(c, 6).alias(c) for c in ("own", "best", "margin")], "place")


@query("confident_joint", f"""WITH {OOF} SELECT label, confident, n, round(n / sum(n) OVER (PARTITION BY label) * (SELECT count(*) FROM conf x WHERE x.label = j.label)
    / (SELECT count(*) FROM conf x WHERE x.label IN (SELECT label FROM conf WHERE confident IS NOT NULL)), 6) AS share
  FROM (SELECT label, confident, count(*) AS n FROM conf WHERE confident IS NOT NULL GROUP BY ALL) j""")
def _(spark, d):
    return au.confident_joint(confident(spark, d)).withColumn("share", F.round("share", 6))



# ---- augmentation, distillation

AUGMENT = f"""{C}, cut AS (SELECT row_id, label, copy, unnest(l) AS w, generate_subscripts(l, 1) - 1 AS i FROM (
    SELECT row_id, label, list_filter(regexp_split_to_array({i.strip_sql('text')}, '[{i.WS}]+'), lambda w: w <> '') AS l FROM corpus WHERE split = 'train'), range(1, 3) t(copy)),
  drawn AS (SELECT *, {i.h("concat(row_id, ':42:', copy, ':d:', i)")} % 1000 AS d FROM cut),
  left_over AS (SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY row_id, copy) AS n FROM
    (SELECT * FROM drawn QUALIFY d >= 100 OR (i = 0 AND max(d) OVER (PARTITION BY row_id, copy) < 100)) WINDOW w AS (PARTITION BY row_id, copy ORDER BY i)),
  placed AS (SELECT *, {i.h("concat(row_id, ':42:', copy, ':o')")} % 2 AS o FROM left_over),
  pairs AS (SELECT *, CASE WHEN k < o THEN k ELSE o + (k - o) // 2 * 2 END AS first FROM placed),
  moved AS (SELECT *, CASE WHEN k >= o AND first + 1 < n AND {i.h("concat(row_id, ':42:', copy, ':s:', first)")} % 1000 < 100 THEN 2 * first + 1 - k ELSE k END AS spot FROM pairs),
  made AS (SELECT row_id, label, copy, string_agg(w, ' ' ORDER BY spot) AS text, count(*) AS n FROM moved GROUP BY ALL)"""


@query("augment_text", f"""WITH {AUGMENT} SELECT c.row_id, c.label, t.copy, md5(coalesce(m.text, '')) AS digest, CAST(coalesce(m.n, 0) AS BIGINT) AS n_words
  FROM corpus c CROSS JOIN range(1, 3) t(copy) LEFT JOIN made m ON m.row_id = c.row_id AND m.copy = t.copy WHERE c.split = 'train' AND c.text IS NOT NULL""")
def _(spark, d):
    made = ag.augment(i.train_part(i.corpus(spark, d)), 2, 0.1, 0.1)
    return made.select("row_id", "label", "copy", F.md5("text").alias("digest"), F.size(tx.words(F.col("text"))).cast("bigint").alias("n_words"))


POOL = i.h("concat(row_id, ':pool')") + " % 2 = 0"


def rows_cte(fit: str, rest: str) -> str:
    return f"rows AS (SELECT row_id, label, text, true AS fit FROM corpus WHERE {fit} UNION ALL SELECT row_id, label, text, false FROM corpus WHERE {rest})"


DISTIL = f"""{C},
  teacher AS (WITH {rows_cte(f"split = 'train' AND NOT {POOL}", f"split = 'test' OR {POOL}")}, {bayes_sql()} SELECT row_id, y_true, c, s FROM jll),
  said AS (SELECT row_id, c, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY row_id) AS p FROM (SELECT *, max(s) OVER (PARTITION BY row_id) AS m FROM teacher)),
  {rows_cte(f"split = 'train' AND {POOL}", "split = 'test'")}, {tfidf_sql()},
  tc AS (SELECT w.term, s.c, sum(w.weight * s.p) AS s FROM weights w JOIN said s ON s.row_id = w.row_id WHERE w.fit GROUP BY ALL),
  prior AS (SELECT s.c, sum(s.p) AS nc FROM said s JOIN rows r ON r.row_id = s.row_id WHERE r.fit GROUP BY s.c),
  tot AS (SELECT c, sum(s) AS t FROM tc GROUP BY c), v AS (SELECT count(DISTINCT term) AS v FROM weights WHERE fit),
  ll AS (SELECT x.row_id, tot.c, sum(x.weight * (ln(coalesce(tc.s, 0) + 1.0) - ln(tot.t + v))) AS l FROM weights x CROSS JOIN tot CROSS JOIN v
         LEFT JOIN tc ON tc.term = x.term AND tc.c = tot.c WHERE NOT x.fit GROUP BY ALL),
  student AS (SELECT r.row_id, r.label AS y_true, p.c, ln(p.nc / (SELECT sum(nc) FROM prior)) + coalesce(ll.l, 0) AS s
              FROM rows r CROSS JOIN prior p LEFT JOIN ll ON ll.row_id = r.row_id AND ll.c = p.c WHERE NOT r.fit),
  both_preds AS (SELECT a.row_id, a.y_true, a.t, b.s FROM (SELECT row_id, any_value(y_true) AS y_true, arg_min(c, (-s, c)) AS t FROM teacher GROUP BY row_id) a
    JOIN (SELECT row_id, arg_min(c, (-s, c)) AS s FROM student GROUP BY row_id) b USING (row_id))"""


@query("distil", f"""WITH {DISTIL} SELECT count(*) AS n, round(avg(CAST(y_true = t AS INT)), 6) AS teacher_acc, round(avg(CAST(y_true = s AS INT)), 6) AS student_acc,
  round(avg(CAST(t = s AS INT)), 6) AS agreement FROM both_preds""")
def _(spark, d):
    train, test = lang_parts(spark, d)
    in_pool = i.hash_number(F.col("row_id"), ":pool") % 2 == 0
    teacher, student = tn.distil(train.where(~in_pool), train.where(in_pool))
    return tn.agreement(teacher(test), student(test))


# ---- tuning

HEAD_STEPS = [("alpha=0.1", {"alpha": 0.1}), ("uniform prior", {"fit_prior": False})]
HEAD_CONFIGS = [("0", 1, False, 1.0, True), ("1", 1, False, 0.1, True), ("2", 1, False, 1.0, False), ("12", 1, False, 0.1, False)]
MIX_STEPS = [("min_df=2", {"min_df": 2}, None), ("sublinear_tf", {"sublinear_tf": True}, None), ("alpha=0.1", None, {"alpha": 0.1})]
MIX_CONFIGS = [(f"{'1' if m == 2 else ''}{'2' if s else ''}{'3' if a == 0.1 else ''}" or "0", m, s, a, True)
               for m in (1, 2) for s in (False, True) for a in (1.0, 0.1)]


def greedy_sql(names: list[str]) -> str:
    """CTEs that walk the greedy rounds over metrics of all possible configs: r0 .. rn, protocol."""
    parts = ["r0 AS (SELECT '' AS best, macro_f1 AS best_f1, macro_f1 AS f1, accuracy AS acc, true AS kept FROM metrics WHERE model_key = '0')"]
    for n in range(1, len(names) + 1):
        parts.append(f"""r{n} AS (SELECT CASE WHEN m.macro_f1 > best_f1 THEN best || '{n}' ELSE best END AS best, greatest(m.macro_f1, best_f1) AS best_f1,
          m.macro_f1 AS f1, m.accuracy AS acc, m.macro_f1 > best_f1 AS kept FROM r{n - 1} JOIN metrics m ON m.model_key = best || '{n}')""")
    rows = " UNION ALL ".join(
        f"SELECT {n} AS round, '{name}' AS step, round(f1 * 100, 2) AS val_macro_f1, round(acc * 100, 2) AS val_acc, kept FROM r{n}"
        for n, name in enumerate(["defaults", *names]))
    return ",\n  ".join(parts) + f",\n  protocol AS (SELECT CAST(round AS BIGINT) AS round, step, val_macro_f1, val_acc, kept FROM ({rows}))"


GREEDY = f"WITH {VAL_ROWS}, {bayes_sql(HEAD_CONFIGS)}, {i.METRICS_SQL}, {greedy_sql([s for s, _ in HEAD_STEPS])}"
MIXED = f"WITH {VAL_ROWS}, {bayes_sql(MIX_CONFIGS)}, {i.METRICS_SQL}, {greedy_sql([s for s, _, _ in MIX_STEPS])}"


@query("greedy_tune", f"{GREEDY} SELECT * FROM protocol")
def _(spark, d):
    train, val, _ = source_parts(spark, d)
    return tn.greedy_search(spark, tn.bayes_evaluator(train, val), HEAD_STEPS)[1]


@query("tune_tfidf", f"{MIXED} SELECT * FROM protocol")
def _(spark, d):
    train, val, _ = source_parts(spark, d)
    return tn.tune_tfidf(train, val, MIX_STEPS)[2]


@query("round_protocol", f"""{GREEDY} SELECT *, max(val_macro_f1) OVER () AS best_val_macro_f1, val_macro_f1 = max(val_macro_f1) OVER () AS is_best FROM protocol""")
def _(spark, d):
    train, val, _ = source_parts(spark, d)
    return tn.round_protocol(tn.greedy_search(spark, tn.bayes_evaluator(train, val), HEAD_STEPS)[1])


@query("refit_and_test", f"""WITH {TEST_ROWS}, {bayes_sql([('plain', 1, False, 1.0, True), ('best', 2, True, 0.1, True)])}, {i.METRICS_SQL}
  SELECT round(b.accuracy, 6) AS accuracy, round(b.macro_f1, 6) AS macro_f1, round((b.accuracy - p.accuracy) * 100, 6) AS gain_points
  FROM metrics b, metrics p WHERE b.model_key = 'best' AND p.model_key = 'plain'""")
def _(spark, d):
    rows = i.corpus(spark, d, "source")
    best = {"min_df": 2, "sublinear_tf": True, "alpha": 0.1}
    return tn.refit_and_test(i.train_part(rows), i.test_part(rows), best)


@query("ablation", f"""WITH {VAL_ROWS}, {bayes_sql([('all', 2, True, 0.1, True), ('without alpha', 2, True, 1.0, True),
    ('without min_df', 1, True, 0.1, True), ('without sublinear_tf', 2, False, 0.1, True)])}, {i.METRICS_SQL}
  SELECT model_key AS config, round(macro_f1, 6) AS val_macro_f1,
    round(macro_f1 - (SELECT macro_f1 FROM metrics WHERE model_key = 'all'), 6) AS change FROM metrics""")
def _(spark, d):
    train, val, _ = source_parts(spark, d)
    return tn.ablation(train, val, {"min_df": 2, "sublinear_tf": True, "alpha": 0.1})


@query("grid_search", f"""WITH {VAL_ROWS}, {bayes_sql(HEAD_CONFIGS)}, {i.METRICS_SQL}
  SELECT CASE model_key WHEN '0' THEN '{{''alpha'': 1.0, ''fit_prior'': True}}' WHEN '1' THEN '{{''alpha'': 0.1, ''fit_prior'': True}}'
    WHEN '2' THEN '{{''alpha'': 1.0, ''fit_prior'': False}}' ELSE '{{''alpha'': 0.1, ''fit_prior'': False}}' END AS config,
    round(accuracy, 6) AS val_acc, round(macro_f1, 6) AS val_macro_f1 FROM metrics""")
def _(spark, d):
    train, val, _ = source_parts(spark, d)
    found = tn.grid_search(spark, tn.bayes_evaluator(train, val), {"alpha": [1.0, 0.1], "fit_prior": [True, False]})
    return found.select("config", F.round("val_acc", 6).alias("val_acc"), F.round("val_macro_f1", 6).alias("val_macro_f1"))


def curve_sql(size: int | None) -> str:
    used = f"""SELECT row_id, label, text FROM (SELECT *, row_number() OVER (PARTITION BY label
      ORDER BY substr(md5(concat(row_id, ':42')), 1, 8), row_id) AS p FROM parts WHERE part = 'train') {f"WHERE p <= {size}" if size else ""}"""
    return f"""(WITH used AS ({used}), rows AS (SELECT row_id, label, text, true AS fit FROM used UNION ALL
      SELECT row_id, label, text, false FROM parts WHERE part = 'val' UNION ALL SELECT -1 - row_id, label, text, false FROM used), {bayes_sql()},
    sides AS (SELECT CASE WHEN row_id < 0 THEN 'train' ELSE 'val' END AS model_key, row_id, y_true, y_pred FROM predictions),
    {i.METRICS_SQL.replace('FROM predictions', 'FROM sides')}
    SELECT CAST({size or 'NULL'} AS BIGINT) AS per_class, (SELECT round(macro_f1, 6) FROM metrics WHERE model_key = 'train') AS train_f1,
      (SELECT round(macro_f1, 6) FROM metrics WHERE model_key = 'val') AS val_f1)"""


CURVE = f"WITH {C20}, {part_sql()}, curve AS ({curve_sql(4)} UNION ALL {curve_sql(16)} UNION ALL {curve_sql(None)})"


@query("learning_curve", f"{CURVE} SELECT * FROM curve")
def _(spark, d):
    train, val, _ = source_parts(spark, d)
    return tn.learning_curve(train, val, [4, 16])


@query("bias_variance_flag", f"""{CURVE} SELECT concat('n=', coalesce(CAST(per_class AS VARCHAR), 'all')) AS step, train_f1, val_f1,
  CASE WHEN train_f1 < 0.8 THEN 'bias' WHEN train_f1 - val_f1 > 0.1 THEN 'variance' ELSE 'balanced' END AS reading FROM curve""")
def _(spark, d):
    train, val, _ = source_parts(spark, d)
    curve = tn.learning_curve(train, val, [4, 16])
    return tn.bias_variance_flag(curve.select(F.concat(F.lit("n="), F.coalesce(F.col("per_class").cast("string"), F.lit("all"))).alias("step"), "train_f1", "val_f1"))


# ---- neighbours

Q = i.h("concat(vec_id, ':q')") + " % 5 = 0"


def near_sql(source: str, k: int, queries: str, base: str, exclude_self: bool = False) -> str:
    rule = "q.vec_id <> b.vec_id" if exclude_self else "true"
    return f"""near AS (SELECT * FROM (SELECT q.vec_id AS query_id, b.vec_id AS neighbour_id, b.label,
      round(list_dot_product(q.v, b.v), 9) AS similarity, row_number() OVER (PARTITION BY q.vec_id
      ORDER BY round(list_dot_product(q.v, b.v), 9) DESC, b.vec_id) AS place
      FROM {source} q JOIN {source} b ON {rule} WHERE {queries.format('q.vec_id')} AND {base.format('b.vec_id')}) WHERE place <= {k})"""


IS_Q = i.h("concat({0}, ':q')") + " % 5 = 0"
NOT_Q = i.h("concat({0}, ':q')") + " % 5 <> 0"
VOTE = """vote AS (SELECT query_id AS vec_id, arg_min(label, (-n, label)) AS majority FROM
  (SELECT query_id, label, count(*) AS n FROM near GROUP BY ALL) GROUP BY query_id)"""


@query("nearest_vectors", f"""WITH {i.vectors_sql()}, {near_sql('vecs', 15, IS_Q, NOT_Q)}
  SELECT query_id, neighbour_id, label, round(similarity, 6) AS similarity, place FROM near""")
def _(spark, d):
    rows = i.vectors(spark, d)
    found = nn.nearest(rows.where(i.vector_is_query()).select("vec_id", "v"), rows.where(~i.vector_is_query()), 15)
    return found.select("query_id", "neighbour_id", "label", F.round("similarity", 6).alias("similarity"),
                        F.col("place").cast("bigint").alias("place"))


@query("knn_classify", f"WITH {i.vectors_sql()}, {near_sql('vecs', 15, IS_Q, NOT_Q)}, {VOTE} SELECT vec_id, majority AS y_pred FROM vote")
def _(spark, d):
    rows = i.vectors(spark, d)
    return nn.knn_classify(rows.where(~i.vector_is_query()), rows.where(i.vector_is_query()), 15)


@query("neighbour_majority", f"""WITH {i.vectors_sql()}, {near_sql('vecs', 10, 'true', 'true', True)}, {VOTE}
  SELECT vec_id, label, majority FROM vecs JOIN vote USING (vec_id)""")
def _(spark, d):
    return nn.neighbour_majority(i.vectors(spark, d), 10)


def misfit_sql(encoder: str, dims: int) -> str:
    return f"""(WITH {i.vectors_sql(dims)}, {near_sql('vecs', 10, 'true', 'true', True)}, {VOTE}
      SELECT '{encoder}' AS encoder, vec_id, label, majority FROM vecs JOIN vote USING (vec_id) WHERE label <> majority)"""


MISFITS = f"WITH misfits AS ({misfit_sql('half', 32)} UNION ALL {misfit_sql('full', 64)})"


def both_misfits(spark, d):
    return nn.misfits(i.vectors(spark, d, 32), "half").unionByName(nn.misfits(i.vectors(spark, d), "full"))


@query("misfits", f"{MISFITS} SELECT * FROM misfits")
def _(spark, d):
    return both_misfits(spark, d).orderBy("vec_id", "encoder")


@query("misfits_repaired", f"""{MISFITS} SELECT * FROM misfits WHERE encoder = 'half'
  AND vec_id NOT IN (SELECT vec_id FROM misfits WHERE encoder = 'full')""")
def _(spark, d):
    return nn.repaired(stored(both_misfits(spark, d), "misfits"), "half", "full")


# ---- Spark ML heads: no SQL form; checked by tests


def tfidf_features(spark, d):
    train, test = lang_parts(spark, d)
    return tuple(ft.text_vectors(train, [test], ft.TfidfOptions(min_df=2), ("label",))[1])


def vector_features(spark, d):
    rows = i.vectors(spark, d).withColumnRenamed("vec_id", "row_id")
    made = ft.dense_features(rows, "v", ("row_id", "label"))
    is_query = F.col("row_id").isin([]) | (i.hash_number(F.col("row_id"), ":q") % 5 == 0)
    return made.where(~is_query), made.where(is_query)


def head_query(name, features, fit):
    @query(name)
    def _(spark, d):
        train, test = features(spark, d)
        return fit(train).predict(test).select("row_id", F.col("label").alias("y_true"), "y_pred", "score_type",
                                               F.round(F.array_max("scores"), 4).alias("top_score"))


head_query("logreg_tfidf", tfidf_features, lambda t: hd.logistic_head(t, C=10, class_weight="balanced"))
head_query("logreg_dense", vector_features, lambda t: hd.logistic_head(t, C=3))
head_query("linear_svc", tfidf_features, lambda t: hg.squared_hinge_head(t))
head_query("linear_svc_balanced", tfidf_features, lambda t: hg.squared_hinge_head(t, C=10, class_weight="balanced"))
head_query("sgd_linear", tfidf_features, lambda t: hd.sgd_head(t, alpha=1e-4, class_weight="balanced"))
head_query("sgd_log_loss", vector_features, lambda t: hd.sgd_head(t, alpha=1e-4, loss="log_loss"))
head_query("tree_ensemble", vector_features, lambda t: hd.forest_head(t))


@query("head_comparison")
def _(spark, d):
    rows = i.vectors(spark, d)
    train, val = (stored(rows.where(c), "vectors") for c in (~i.vector_is_query(), i.vector_is_query()))
    return hd.head_comparison(train, val, {
        "logreg": lambda t: hd.logistic_head(t, C=3), "linear_svc": lambda t: hg.squared_hinge_head(t)})


LINEAR_STEPS = [("min_df=2", {"min_df": 2}, None), ("C=10", None, {"C": 10.0}), ("balanced", None, {"class_weight": "balanced"})]


@query("tune_linear")
def _(spark, d):
    train, val, _ = source_parts(spark, d)
    return tn.tune_linear(train, val, LINEAR_STEPS, "linear_svc")[2]


@query("refit_linear")
def _(spark, d):
    rows = i.corpus(spark, d, "source")
    return tn.refit_linear(i.train_part(rows), i.test_part(rows), {"min_df": 2, "C": 10.0}, head="linear_svc")


@query("tune_dense")
def _(spark, d):
    return tn.tune_dense(*vector_features(spark, d), [("C=3", {"C": 3.0}), ("balanced", {"class_weight": "balanced"})])[1]


@query("best_head")
def _(spark, d):
    train, test = vector_features(spark, d)
    is_val = i.hash_number(F.col("row_id"), ":val") % 5 == 0
    parts = [stored(train.where(c), "vectors") for c in (~is_val, is_val)]
    return tn.best_head(*parts, test, {"logreg": ("logreg", {"C": 3.0}), "linear_svc": ("linear_svc", {}), "forest": ("forest", {})})[1]


@query("project_vectors")
def _(spark, d):
    return hd.project_vectors(i.vectors(spark, d), 3).select("vec_id", "label", *[
        F.round(F.col("coords")[j], 6).alias(c) for j, c in enumerate("xyz")])


@query("decision_regions")
def _(spark, d):
    flat = hd.project_vectors(i.vectors(spark, d), 2).select(
        F.col("coords")[0].alias("x"), F.col("coords")[1].alias("y"), "label")
    return hd.decision_regions(flat)


@query("word_vectors")
def _(spark, d):
    model = hd.word_vectors(i.corpus(spark, d))
    return model.getVectors().select("word", vector_to_array("vector").alias("v"))
