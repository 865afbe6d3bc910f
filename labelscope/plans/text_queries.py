"""Registered queries: sources, text functions, corpus profile, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelscope.functions import scores as sc
from labelscope.functions import text as tx
from labelscope.operators import profile as pr
from labelscope.operators import split as sp
from labelscope.plans import inputs as i
from labelscope.plans.registry import query
from labelscope.sources import corpus as co
from labelscope.sources import runs as rn
from labelscope.runtime import new_path

C, C20 = i.corpus_sql(), i.corpus_sql("source")

WORDS = "unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word"


# ---- sources and sinks


@query("load_corpus", "SELECT doc_id AS row_id, text, lang AS label FROM documents")
def _(spark, d):
    return co.load_corpus(spark, f"{d}/documents.parquet", "doc_id", "text", "lang")


@query("union_sources", """
  SELECT 'documents' AS source, 'train' AS split, concat('{"source":"documents","split":"train","row_id":', doc_id, '}') AS row_id, lang AS label, md5(text) AS digest FROM documents
  UNION ALL SELECT 'chats', 'train', concat('{"source":"chats","split":"train","row_id":', conv_id, '}'), role, md5(text) FROM conversations
  UNION ALL SELECT 'pages', 'test', concat('{"source":"pages","split":"test","row_id":', page_id, '}'), url, md5(html) FROM pages""")
def _(spark, d):
    spec = lambda name, split, file, id_, text, label: dict(
        name=name, split=split, path=f"{d}/{file}.parquet", id=id_, text=text, label=label)
    rows = co.union_sources(spark, [
        spec("documents", "train", "documents", "doc_id", "text", "lang"),
        spec("chats", "train", "conversations", "conv_id", "text", "role"),
        spec("pages", "test", "pages", "page_id", "html", "url"),
    ])
    return rows.select("source", "split", "row_id", "label", F.md5("text").alias("digest"))


PROFILE = """count(*) AS n_rows, count(DISTINCT label) AS n_labels,
  CAST(floor(quantile_cont(length(text), 0.5)) AS BIGINT) AS median_chars,
  max(length(text)) AS max_chars, min(length(text)) AS min_chars"""


@query("profile_corpus", f"""WITH {C}
  SELECT split, {PROFILE} FROM corpus GROUP BY split UNION ALL SELECT 'all', {PROFILE} FROM corpus""")
def _(spark, d):
    return co.profile_corpus(i.corpus(spark, d))


@query("profile_head", f"""WITH {C} SELECT row_id, label,
  CASE WHEN length(text) > 90 THEN concat(substr(text, 1, 90), '…') ELSE text END AS text
  FROM corpus ORDER BY row_id LIMIT 4""")
def _(spark, d):
    return co.head_rows(i.corpus(spark, d))


@query("load_vectors", """
  SELECT vec_id, CAST(label AS VARCHAR) AS label, CAST(len(embedding) AS BIGINT) AS dims,
         round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total
  FROM embeddings WHERE label IN (1, 3, 5)""")
def _(spark, d):
    rows = co.load_vectors(spark, f"{d}/embeddings.parquet", "vec_id", "embedding", "label", [1, 3, 5])
    return rows.select("vec_id", "label", F.size("v").cast("bigint").alias("dims"),
                       F.round(sc.array_sum(F.col("v")), 6).alias("total"))


SYSTEM = "Classify the message into exactly one label. Respond with only the label."


@query("export_chat_jsonl", f"""
  SELECT to_json({{'messages': [{{'role': 'system', 'content': '{SYSTEM}'}}, {{'role': 'user', 'content': text}},
    {{'role': 'assistant', 'content': lang}}]}})::VARCHAR AS value FROM documents""")
def _(spark, d):
    path = new_path(spark, "chat")
    rn.export_chat_jsonl(i.corpus(spark, d), SYSTEM, path)
    return spark.read.text(path)


# ---- text functions


@query("normalise_text", f"SELECT doc_id AS row_id, {i.norm_sql('text')} AS norm FROM documents")
def _(spark, d):
    return i.corpus(spark, d).select("row_id", tx.normalise_text(F.col("text")).alias("norm"))


@query("tokenise_alpha", """SELECT doc_id AS row_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS t FROM documents)""")
def _(spark, d):
    tokens = i.corpus(spark, d).select("row_id", tx.tokenise_alpha(F.col("text")).alias("t"))
    return tokens.select("row_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query("drop_stopwords", f"""SELECT doc_id AS row_id, array_to_string(list_filter(
  regexp_extract_all(lower(text), '[a-z]+'), lambda w: w NOT IN ({i.STOP_SQL})), ' ') AS tokens FROM documents""")
def _(spark, d):
    kept = tx.drop_stopwords(tx.tokenise_alpha(F.col("text")), i.STOP_WORDS)
    return i.corpus(spark, d).select("row_id", F.array_join(kept, " ").alias("tokens"))


LENGTHS = f"""lengths AS (SELECT row_id, label, CAST({i.words_sql('text')} AS BIGINT) AS n_words,
  CAST(length(text) AS BIGINT) AS n_chars FROM corpus)"""


@query("text_lengths", f"WITH {C}, {LENGTHS} SELECT * FROM lengths")
def _(spark, d):
    return pr.text_lengths(i.corpus(spark, d))


@query("artefact_flags", f"""SELECT
  count(*) FILTER (regexp_matches(text, '[^\\x00-\\x7F]')) AS non_ascii,
  count(*) FILTER ({i.strip_sql('text')} = '') AS blank,
  count(*) FILTER (regexp_matches(text, '{tx.DIGIT_CLASS}')) AS with_digits,
  count(*) FILTER (contains(text, '{{') OR contains(text, '}}')) AS with_braces FROM documents""")
def _(spark, d):
    return pr.artefact_flags(i.corpus(spark, d))


@query("special_chars", r"""SELECT c AS char, count(*) AS n_texts, CAST(unicode(c) AS BIGINT) AS code_point
  FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[^\x00-\x7F]')) AS c FROM documents) GROUP BY c""")
def _(spark, d):
    return pr.special_chars(i.corpus(spark, d)).drop("name")


@query("class_examples", f"""WITH {C} SELECT row_id, label, text, place FROM (SELECT *,
  row_number() OVER (PARTITION BY label ORDER BY row_id) AS place FROM corpus) WHERE label IN ('en', 'fr') AND place <= 6""")
def _(spark, d):
    rows = pr.class_examples(i.corpus(spark, d), ["en", "fr"], 6)
    return rows.select("row_id", "label", "text", F.col("place").cast("bigint").alias("place"))


@query("shorten_text", """SELECT doc_id AS row_id,
  CASE WHEN length(text) <= 80 THEN text ELSE concat(substr(text, 1, 77), '…') END AS short FROM documents""")
def _(spark, d):
    return i.corpus(spark, d).select("row_id", tx.shorten(F.col("text")).alias("short"))


CODES = "codes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id FROM (SELECT DISTINCT label FROM corpus WHERE split = 'train'))"


@query("encode_labels", f"""WITH {C20}, {CODES}
  SELECT row_id, split, label_id, codes.label AS decoded FROM corpus LEFT JOIN codes USING (label)""")
def _(spark, d):
    codes, coded = sp.encode_labels(i.corpus(spark, d, "source"))
    return sp.decode_labels(coded, codes).select("row_id", "split", "label_id", "decoded")


# ---- corpus profile


DIST = "dist AS (SELECT label, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'test') AS test FROM corpus GROUP BY label)"


@query("class_distribution", f"""WITH {C20}, {DIST}
  SELECT *, round(train / (sum(train) OVER ()) * 100, 2) AS train_pct FROM dist""")
def _(spark, d):
    return pr.class_distribution(i.corpus(spark, d, "source"))


@query("class_size_extremes", f"""WITH {C20}, {DIST}
  SELECT 'largest' AS side, * FROM (FROM dist ORDER BY train DESC, label LIMIT 5)
  UNION ALL SELECT 'smallest', * FROM (FROM dist ORDER BY train, label LIMIT 5)""")
def _(spark, d):
    return pr.class_size_extremes(pr.class_distribution(i.corpus(spark, d, "source")))


@query("class_size_summary", f"""WITH {C20}, {DIST}, long AS (SELECT 'train' AS split, train AS n FROM dist UNION ALL SELECT 'test', test FROM dist)
  SELECT split, min(n) AS min_n, CAST(floor(quantile_cont(n, 0.5)) AS BIGINT) AS median_n, max(n) AS max_n FROM long GROUP BY split""")
def _(spark, d):
    return pr.class_size_summary(pr.class_distribution(i.corpus(spark, d, "source")))


@query("length_summary", f"""WITH {C}, {LENGTHS}, long AS (SELECT 'words' AS measure, n_words AS n FROM lengths UNION ALL SELECT 'chars', n_chars FROM lengths)
  SELECT measure, min(n) AS min_n, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median_n, max(n) AS max_n FROM long GROUP BY measure""")
def _(spark, d):
    return pr.length_summary(pr.text_lengths(i.corpus(spark, d)))


@query("median_length_by_class", f"""WITH {C20}, {LENGTHS},
  med AS (SELECT label, CAST(quantile_cont(n_words, 0.5) AS DOUBLE) AS median_words FROM lengths GROUP BY label)
  SELECT 'shortest' AS side, * FROM (FROM med ORDER BY median_words, label LIMIT 5)
  UNION ALL SELECT 'longest', * FROM (FROM med ORDER BY median_words DESC, label LIMIT 5)""")
def _(spark, d):
    return pr.median_length_by_class(pr.text_lengths(i.corpus(spark, d, "source")))


@query("histogram", f"""WITH {C}, {LENGTHS}, lim AS (SELECT min(n_chars) AS lo, (max(n_chars) - min(n_chars)) / 40.0 AS w FROM lengths)
  SELECT bin, count(*) AS n, round(any_value(lo) + bin * any_value(w), 6) AS bin_low
  FROM (SELECT CAST(least(floor((n_chars - lo) / w), 39) AS BIGINT) AS bin, lo, w FROM lengths, lim) GROUP BY bin""")
def _(spark, d):
    return pr.histogram(pr.text_lengths(i.corpus(spark, d)), "n_chars").withColumn("bin_low", F.round("bin_low", 6))


COUNTS = f"counts AS (SELECT word, count(*) AS n FROM (SELECT {WORDS} FROM corpus) GROUP BY word)"
CONTENT = f"counts AS (SELECT word, count(*) AS n FROM (SELECT {WORDS} FROM corpus) WHERE word NOT IN ({i.STOP_SQL}) GROUP BY word)"
TOP = """SELECT word, n, (SELECT CAST(sum(n) AS BIGINT) FROM counts) AS total_tokens,
  (SELECT count(*) FROM counts) AS distinct_tokens FROM counts ORDER BY n DESC, word LIMIT 15"""


@query("vocabulary_counts", f"WITH {C}, {COUNTS} {TOP}")
def _(spark, d):
    return pr.vocabulary_top(pr.word_counts(i.corpus(spark, d)))


@query("content_vocabulary", f"WITH {C}, {CONTENT} {TOP}")
def _(spark, d):
    return pr.vocabulary_top(pr.word_counts(i.corpus(spark, d), i.STOP_WORDS))


@query("hapax_share", f"""WITH {C}, {COUNTS} SELECT count(*) AS vocabulary, count(*) FILTER (n = 1) AS hapax,
  round(count(*) FILTER (n = 1) / count(*) * 100, 6) AS hapax_pct FROM counts""")
def _(spark, d):
    return pr.hapax_share(pr.word_counts(i.corpus(spark, d)))


def top_sql(k: int) -> str:
    return f"""tops AS (SELECT label, word, n, place FROM (SELECT label, word, count(*) AS n,
      row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, word) AS place
      FROM (SELECT label, {WORDS} FROM corpus) WHERE word NOT IN ({i.STOP_SQL}) GROUP BY label, word) WHERE place <= {k})"""


@query("top_words_by_class", f"WITH {C}, {top_sql(8)} SELECT * FROM tops")
def _(spark, d):
    return pr.top_words_by_class(i.corpus(spark, d), 8, i.STOP_WORDS).withColumn("place", F.col("place").cast("bigint"))


@query("class_vocab_overlap", f"""WITH {C20}, {top_sql(15)}, sizes AS (SELECT label, count(*) AS n FROM tops GROUP BY label),
  shared AS (SELECT a.label AS label_a, b.label AS label_b, count(*) AS s, string_agg(a.word, ', ' ORDER BY a.word) AS w
             FROM tops a JOIN tops b ON a.word = b.word AND a.label < b.label GROUP BY ALL)
  SELECT a.label AS label_a, b.label AS label_b, coalesce(s, 0) AS shared,
         round(coalesce(s, 0) / (a.n + b.n - coalesce(s, 0)), 6) AS jaccard, coalesce(w, '') AS shared_words
  FROM sizes a JOIN sizes b ON a.label < b.label LEFT JOIN shared ON label_a = a.label AND label_b = b.label
  ORDER BY jaccard DESC, label_a DESC, label_b DESC LIMIT 10""")
def _(spark, d):
    return pr.class_vocab_overlap(i.corpus(spark, d, "source"), 15, 10, i.STOP_WORDS)


@query("exact_duplicates", f"""WITH {C} SELECT split, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS duplicates
  FROM (SELECT split, {i.norm_sql('text')} AS t, count(*) AS n FROM corpus GROUP BY ALL) GROUP BY split""")
def _(spark, d):
    return pr.exact_duplicates(i.corpus(spark, d))


LEAKS = f"""leaks AS (SELECT {i.norm_sql('text')} AS text, count(*) FILTER (split = 'train') AS n_train,
  count(*) FILTER (split = 'test') AS n_test FROM corpus GROUP BY 1 HAVING n_train > 0 AND n_test > 0)"""


@query("split_leakage", f"WITH {C}, {LEAKS} SELECT * FROM leaks")
def _(spark, d):
    return pr.split_leakage(i.corpus(spark, d))


@query("leakage_summary", f"""WITH {C}, {LEAKS}
  SELECT substr(text, 1, 80) AS example, (SELECT count(*) FROM leaks) AS n_leaking FROM (FROM leaks ORDER BY text LIMIT 5)""")
def _(spark, d):
    return pr.leakage_summary(pr.split_leakage(i.corpus(spark, d)))


@query("majority_baseline", f"""WITH {C}, {DIST} SELECT label, round(test / (SELECT sum(test) FROM dist), 6) AS accuracy,
  round(1.0 / (SELECT count(*) FROM dist WHERE train > 0), 6) AS chance FROM dist ORDER BY train DESC, label LIMIT 1""")
def _(spark, d):
    return pr.majority_baseline(i.corpus(spark, d))


@query("context_window_check", f"""WITH {C}, {LENGTHS}, p AS (SELECT CAST(quantile_cont(n_words, 0.5) AS DOUBLE) AS p50,
    quantile_cont(n_words, 0.95) AS p95, quantile_cont(n_words, 0.99) AS p99, max(n_words) AS max_len,
    CAST(ceil(quantile_cont(n_words, 0.99) / 8) * 8 AS BIGINT) AS padded_len FROM lengths)
  SELECT p50, round(p95, 6) AS p95, round(p99, 6) AS p99, max_len, padded_len,
    (SELECT round(avg(CAST(n_words > padded_len AS INT)) * 100, 6) FROM lengths) AS truncated_pct,
    (SELECT round(avg(CAST(n_words > 256 AS INT)) * 100, 6) FROM lengths) AS over_256_pct,
    (SELECT round(avg(CAST(n_words > 512 AS INT)) * 100, 6) FROM lengths) AS over_512_pct FROM p""")
def _(spark, d):
    return pr.context_window_check(pr.text_lengths(i.corpus(spark, d)), "n_words")


# ---- splits and samples


def part_sql(source: str = "train") -> str:
    """CTEs hashed, quota, parts: the stratified validation part of the train rows."""
    return f"""hashed AS (SELECT row_id, label, text, substr(md5(concat(row_id, ':42')), 1, 8) AS hx FROM corpus WHERE split = '{source}'),
  sizes AS (SELECT label, count(*) AS n, (SELECT count(*) FROM hashed) AS total,
            (SELECT CAST(ceil(round(count(*) * 0.15, 6)) AS BIGINT) FROM hashed) AS target FROM hashed GROUP BY label),
  quota AS (SELECT label, n * target // total + CAST(row_number() OVER (ORDER BY n * target % total DESC, label)
            <= target - sum(n * target // total) OVER () AS BIGINT) AS q FROM sizes),
  parts AS (SELECT row_id, label, text, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY hx, row_id) <= q
            THEN 'val' ELSE 'train' END AS part FROM hashed JOIN quota USING (label))"""


@query("stratified_split", f"WITH {C}, {part_sql()} SELECT row_id, label, part FROM parts")
def _(spark, d):
    return sp.stratified_split(i.train_part(i.corpus(spark, d))).select("row_id", "label", "part")


SAMPLE = """picks AS (SELECT row_id, label, text, pick FROM (SELECT *, row_number() OVER (PARTITION BY label
  ORDER BY substr(md5(concat(row_id, ':42')), 1, 8), row_id) AS pick FROM corpus WHERE split = 'train') WHERE pick <= 2)"""


@query("stratified_subsample", f"WITH {C20}, {SAMPLE} SELECT row_id, label, pick FROM picks")
def _(spark, d):
    rows = sp.stratified_subsample(i.train_part(i.corpus(spark, d, "source")), 2)
    return rows.select("row_id", "label", F.col("pick").cast("bigint").alias("pick"))


@query("exclude_holdout", f"""WITH {C20}, {SAMPLE} SELECT row_id, label FROM corpus c
  WHERE split = 'train' AND NOT EXISTS (FROM picks p WHERE p.text = c.text AND p.label = c.label)""")
def _(spark, d):
    train = i.train_part(i.corpus(spark, d, "source"))
    return sp.exclude_holdout(train, sp.stratified_subsample(train, 2)).select("row_id", "label")


@query("stratified_folds", f"""WITH {C} SELECT row_id, label, (row_number() OVER (PARTITION BY label
  ORDER BY substr(md5(concat(row_id, ':42')), 1, 8), row_id) - 1) % 5 AS fold FROM corpus WHERE split = 'train'""")
def _(spark, d):
    return sp.stratified_folds(i.train_part(i.corpus(spark, d)), 5).select("row_id", "label", "fold")


@query("balanced_weights", f"""WITH {C} SELECT label, count(*) AS n,
  round((SELECT count(*) FROM corpus) / ((SELECT count(DISTINCT label) FROM corpus) * count(*)), 6) AS weight FROM corpus GROUP BY label""")
def _(spark, d):
    return sp.balanced_weights(i.corpus(spark, d)).withColumn("weight", F.round("weight", 6))


def resample_sql(extreme: str) -> str:
    return f"""WITH {C20}, sizes AS (SELECT label, count(*) AS n FROM corpus WHERE split = 'train' GROUP BY label),
    placed AS (SELECT row_id, label, n, (SELECT {extreme}(n) FROM sizes) AS t, row_number() OVER (PARTITION BY label
      ORDER BY substr(md5(concat(row_id, ':42')), 1, 8), row_id) AS p FROM corpus JOIN sizes USING (label) WHERE split = 'train')
  SELECT row_id, label, unnest(range(1, t // n + CAST(p <= t % n AS BIGINT) + 1)) AS copy FROM placed"""


def resample_query(name, direction, extreme):
    @query(name, resample_sql(extreme))
    def _(spark, d):
        train = i.train_part(i.corpus(spark, d, "source"))
        return sp.resample(train, sp.balanced_targets(train, direction)).select("row_id", "label", "copy")


resample_query("undersample", "under", "min")
resample_query("oversample", "over", "max")


@query("data_checks", f"""WITH {C}, {LEAKS}, checks AS (
  SELECT 'empty_text' AS check_name, count(*) FILTER (text IS NULL OR {i.strip_sql('text')} = '') AS violations FROM corpus
  UNION ALL SELECT 'unknown_label', count(*) FILTER (label IS NULL OR label NOT IN ('de', 'en', 'fr')) FROM corpus
  UNION ALL SELECT 'too_long', count(*) FILTER (length(text) > 20000) FROM corpus
  UNION ALL SELECT 'split_duplicates', count(*) FROM leaks)
  SELECT *, violations = 0 AS passed FROM checks""")
def _(spark, d):
    return pr.data_checks(i.corpus(spark, d), ["de", "en", "fr"], 20000)


@query("label_leak_terms", f"""WITH {C}, wl AS (SELECT word, label, count(*) AS n FROM (SELECT DISTINCT row_id, label, {WORDS} FROM corpus) GROUP BY ALL),
  w AS (SELECT word, arg_min(label, (-n, label)) AS label, CAST(sum(n) AS BIGINT) AS n_docs, max(n) AS top FROM wl GROUP BY word)
  SELECT word, label, n_docs, round(top / n_docs, 6) AS share FROM w WHERE n_docs >= 5 AND top >= 0.9 * n_docs""")
def _(spark, d):
    return pr.label_leak_terms(i.corpus(spark, d))
