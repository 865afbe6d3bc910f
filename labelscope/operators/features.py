"""TF-IDF as a relational long table, and cached dense vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, fields

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from labelscope.functions import text as tx
from labelscope.functions.scores import l2_normalise
from labelscope.runtime import ranked, stored, written


@dataclass(frozen=True)
class TfidfOptions:
    """Vectoriser settings, with the usual library defaults."""

    ngram_range: tuple[int, int] = (1, 1)
    min_df: int = 1
    max_df: float = 1.0
    sublinear_tf: bool = False
    analyzer: str = "word"
    use_idf: bool = True
    normalise: bool = True


@dataclass
class TfidfModel:
    """Fitted vocabulary (term, df, idf) as a stored table."""

    options: TfidfOptions
    vocabulary: DataFrame
    n_docs: int
    n_terms: int = field(default=0)

    def transform(self, corpus: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """(row_id, *keep, term, weight) with rows of length 1; unknown terms are dropped.

        The corpus is hashed on row_id once, before texts are blown up into terms; the counts are
        stored, since they are read twice, for the vocabulary and for the weights.
        """
        return self.weigh(stored(term_counts(corpus, self.options, keep), "term-counts"), keep).drop("part")

    def weigh(self, counts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``transform`` for stored term counts; keeps their ``part``.

        A part asks for each of its terms once, so what is shuffled on the term are the parts' vocabularies and not
        the counts, however large the vocabulary. A row lies in one part, which also gives its norm.
        """
        schema = T.StructType([*(f for f in counts.schema.fields if f.name in ("row_id", *keep, "term", "part")), T.StructField("weight", T.DoubleType())])
        options = self.options
        weighed = lambda found, answers: found.append_column("weight", pa.array(row_weights(found, answers, options)))
        return meet(counts, self.vocabulary.select("term", "idf"), schema, weighed)


def codes_of(found: pa.Table, column: str = "row_id") -> tuple[np.ndarray, pa.Array]:
    """A number from 0 for each row of ``found``, equal for equal values (null is one), and the values."""
    coded = found.column(column).combine_chunks().dictionary_encode("encode")
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def row_weights(found: pa.Table, answers: pa.Table, options: TfidfOptions) -> np.ndarray:
    """TF-IDF weights of the rows (row_id, term, tf, at), which hold all known terms of a row_id; ``at`` leads to their idf."""
    tf = found.column("tf").to_numpy().astype(float)
    weight = (1 + np.log(tf) if options.sublinear_tf else tf) * answers.column("idf").to_numpy()[found.column("at").to_numpy()]
    if options.normalise and len(weight):
        row, _ = codes_of(found)
        weight = weight / np.sqrt(np.bincount(row, weights=weight * weight))[row]
    return weight


def meet(
    rows: DataFrame, table: DataFrame, schema: T.StructType, use: Callable[[pa.Table, pa.Table], pa.Table], on: tuple[str, ...] = ("term",)
) -> DataFrame:
    """What ``use`` makes of each group of parts of ``rows`` and of the rows of ``table`` that its keys ``on`` find.

    ``rows`` is stored and has (part, *on, ...), ``table`` one row per key. ``GROUPED`` parts make a group; its keys, each
    about once, are looked up and the answers come back to the group, which has a task of its own (dealt by a hash,
    several groups would share one, and the more the larger the input). Rows travel packed. ``use``
    gets the group's rows whose key was found, with ``at``, the place of the answer, and the answers.
    """
    groups = (rows.agg(F.max("part")).first()[0] or 0) // GROUPED + 1
    group = F.floor(F.col("part") / GROUPED).cast("int").alias("group")
    keys = rows.select(group, *on)
    # as many parts as groups on both sides: a task's keys are those of one group, on the average
    answers = keys.mapInArrow(asked, keys.schema).repartition(groups, *on).join(table.repartition(groups, *on), [*on])
    sent = rows.select(group, "*")
    names, wanted, kinds = schema.names, to_arrow_schema(schema), to_arrow_schema(rows.schema)

    def joined(packed: pa.Table, theirs: pa.Table) -> pa.Table:
        mine = pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all().cast(kinds) for x in packed.column("rows")] or [kinds.empty_table()])
        # two tasks that read the same part ask twice
        first = theirs.select(on).append_column("at", pa.array(np.arange(len(theirs)))).group_by([*on]).aggregate([("at", "min")]).rename_columns([*on, "at"])
        found = mine.join(first, [*on], join_type="inner", use_threads=False)
        return use(found, theirs).select(names).cast(wanted)

    left, right = (side.repartitionById(groups, F.col("group")).groupBy("group") for side in (sent.mapInArrow(pack, "group int, rows binary"), answers))
    return left.cogroup(right).applyInArrow(joined, schema)


#: Rows of a part of weights that came without parts.
PART_ROWS = 1 << 19


def in_parts(weights: DataFrame) -> DataFrame:
    """``weights`` with a ``part`` that holds all rows of a row_id."""
    if "part" in weights.columns:
        return weights
    return weights.repartition(weights.count() // PART_ROWS + 1, "row_id").withColumn("part", F.spark_partition_id())


#: Parts that look up their keys together; rows that a task holds before it sends them.
GROUPED, HELD = 4, 1 << 19


def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches of a task in tables of about ``HELD`` rows."""
    some, n = [], 0
    for batch in batches:
        some.append(batch)
        n += batch.num_rows
        if n >= HELD:
            yield pa.Table.from_batches(some)
            some, n = [], 0
    if some:
        yield pa.Table.from_batches(some)


def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct rows, nearly: they are made distinct ``HELD`` at a time."""
    for table in held(batches):
        yield from table.group_by(table.column_names).aggregate([]).to_batches()


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, ...) as (group, rows): sorted, strings by number, compressed."""
    for table in held(batches):
        for group in pc.unique(table.column("group")).to_pylist():
            mine = table.filter(pc.equal(table.column("group"), group)).drop_columns(["group"]).sort_by("row_id")
            for k, column in enumerate(mine.columns):
                if pa.types.is_string(column.type):
                    mine = mine.set_column(k, mine.column_names[k], column.combine_chunks().dictionary_encode())
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, mine.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(mine.combine_chunks())
            yield pa.RecordBatch.from_pydict({"group": pa.array([group], pa.int32()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def terms(options: TfidfOptions) -> Column:
    low, high = options.ngram_range
    if options.analyzer == "char":
        return tx.grams(tx.characters(F.col("text")), low, high, "")
    return tx.grams(tx.tokenise_terms(F.col("text")), low, high, " ")


#: Bytes of text whose terms one task counts.
TEXT_BYTES = 4 << 20


def text_parts(corpus: DataFrame) -> int:
    """Partitions of about ``TEXT_BYTES`` of text."""
    size = corpus.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // TEXT_BYTES))


def term_counts(
    corpus: DataFrame, options: TfidfOptions, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(row_id, *keep, part, term, tf): long texts shrink to one row per distinct term here; a row_id is in one part.

    Counts take many times the room of their texts, so the number of parts follows the size of the
    texts; parts merged by the size of what was shuffled would grow until a task cannot hold its counts.
    """
    return (
        corpus.select("row_id", "text", *keep)
        .repartition(text_parts(corpus), "row_id")
        .select("row_id", *keep, F.explode(terms(options)).alias("term"))
        .groupBy("row_id", *keep, "term")
        .agg(F.count("*").alias("tf"))
        .withColumn("part", F.spark_partition_id())
    )


def fit_tfidf(corpus: DataFrame, **options) -> TfidfModel:
    """Learn document frequencies: idf = ln((1 + n) / (1 + df)) + 1.

    One shuffle of (term, partial count); a text counts a term once, decided inside the row.
    """
    chosen = TfidfOptions(**options)
    seen = corpus.select(F.explode(F.array_distinct(terms(chosen))).alias("term"))
    return fit_on_terms(seen, corpus.count(), chosen)


def fit_transform_tfidf(corpus: DataFrame, learn: Column, **options) -> tuple[TfidfModel, DataFrame]:
    """The model of the rows where ``learn`` holds, and what it makes of all rows, from texts that are cut once.

    Document frequencies come from the stored counts, part by part, and not from scans of texts, whose terms one task
    would have to hold. Counts add up the rows of a row_id, so rows that share one are cut for the vocabulary on their own.
    """
    if not corpus.groupBy("row_id").count().where("count > 1").isEmpty():
        model = fit_tfidf(corpus.where(learn), **options)
        return model, model.transform(corpus)
    chosen = TfidfOptions(**options)
    rows = corpus.withColumn("_learn", learn)
    counts = stored(term_counts(rows, chosen, ("_learn",)), "term-counts")
    model = fit_on_terms(counts.where("_learn"), rows.where("_learn").count(), chosen)
    return model, model.weigh(counts.drop("_learn")).drop("part")


def fit_on_terms(seen: DataFrame, n_docs: int, options: TfidfOptions) -> TfidfModel:
    """Model from one row per (text, distinct term), such as stored term counts."""
    df = (
        seen.groupBy("term").agg(F.count("*").alias("df"))
        .where((F.col("df") >= options.min_df) & (F.col("df") <= F.lit(options.max_df * n_docs)))
    )
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1
    table = stored(df.withColumn("idf", idf if options.use_idf else F.lit(1.0)), "vocabulary")
    return TfidfModel(options, table, n_docs, table.count())


def sparse_features(
    weights: DataFrame, model: TfidfModel, keep: tuple[str, ...] = (), hash_buckets: int | None = None
) -> DataFrame:
    """(row_id, *keep, features) with sparse ML vectors, written once for iterative fitting.

    By default each term has a column of its own, in the order of the terms. ``hash_buckets``
    hashes the terms into so many columns instead, at every size: a linear model keeps
    classes x columns numbers on the driver.
    """
    if hash_buckets is None:
        places = ranked(model.vocabulary.select("term"), [], [F.col("term")], "i").withColumn("i", (F.col("i") - 1).cast("int"))
        size = max(model.n_terms, 1)
        indexed = weights.join(stored(places, "term-index"), "term")
    else:
        size = hash_buckets
        indexed = (
            weights.withColumn("i", F.pmod(F.xxhash64("term"), F.lit(size)).cast("int"))
            .groupBy("row_id", *keep, "i").agg(F.sum("weight").alias("weight"))
        )
    entries = F.array_sort(F.collect_list(F.struct("i", "weight")))
    vectors = indexed.groupBy("row_id", *keep).agg(entries.alias("e")).select(
        "row_id", *keep,
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(size).alias("size"),
            F.transform("e", lambda x: x["i"]).alias("indices"),
            F.transform("e", lambda x: x["weight"]).alias("values"),
        ).alias("features"),
    )
    return as_ml_vectors(vectors)


def text_vectors(
    train: DataFrame, others: Sequence[DataFrame], options: TfidfOptions, keep: tuple[str, ...] = (), cut: dict | None = None
) -> tuple[TfidfModel, list[DataFrame]]:
    """The model of ``train`` and ``sparse_features`` of it and of ``others``, made where the term counts lie.

    A group of parts asks the vocabulary for idf and column of its terms and makes its rows' vectors, so weights are not
    shuffled by term and by row. Texts are cut once; ``cut`` keeps the counts of an n-gram range and analyzer for later calls.
    """
    cut, kind = {} if cut is None else cut, (options.ngram_range, options.analyzer)
    if kind not in cut:
        cut[kind] = [stored(term_counts(rows, options, keep), "term-counts") for rows in (train, *others)]
    if train.groupBy("row_id").count().where("count > 1").isEmpty():
        model = fit_on_terms(cut[kind][0], train.count(), options)
    else:  # counts add up the rows of a row_id
        model = fit_tfidf(train, **{f.name: getattr(options, f.name) for f in fields(options)})
    places = ranked(model.vocabulary.select("term", "idf"), [], [F.col("term")], "i").withColumn("i", (F.col("i") - 1).cast("int"))
    table, size = stored(places, "term-index"), max(model.n_terms, 1)
    return model, [as_ml_vectors(row_vectors(counts, table, options, keep, size)) for counts in cut[kind]]


def row_vectors(counts: DataFrame, table: DataFrame, options: TfidfOptions, keep: tuple[str, ...], size: int) -> DataFrame:
    """(row_id, *keep, features) of stored term counts in the layout of vectors; ``table`` has (term, idf, i)."""
    layout = T.StructType([
        T.StructField("type", T.ByteType()), T.StructField("size", T.IntegerType()),
        T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType())),
    ])
    schema = T.StructType([*(counts.schema[c] for c in ("row_id", *keep)), T.StructField("features", layout)])
    kinds = to_arrow_schema(schema)

    def made(found: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(found):
            return kinds.empty_table()
        weight, place = row_weights(found, answers, options), answers.column("i").to_numpy()[found.column("at").to_numpy()]
        row = np.zeros(len(found), np.int64)
        for column in ("row_id", *keep):
            code, values = codes_of(found, column)
            row = row * len(values) + code
        _, first, row = np.unique(row, return_index=True, return_inverse=True)
        order = np.lexsort((place, row))
        ends = pa.array(np.append(0, np.cumsum(np.bincount(row))).astype(np.int32))
        n = len(first)
        vectors = pa.StructArray.from_arrays([
            pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)),
            pa.ListArray.from_arrays(ends, pa.array(place[order])), pa.ListArray.from_arrays(ends, pa.array(weight[order])),
        ], ["type", "size", "indices", "values"])
        return found.select(["row_id", *keep]).take(pa.array(first)).append_column("features", vectors)

    return meet(counts, table, schema, made)


def dense_features(vectors: DataFrame, vector_col: str = "v", keep: tuple[str, ...] = ()) -> DataFrame:
    return vectors.select(*keep, array_to_vector(F.col(vector_col)).alias("features"))


def as_ml_vectors(table: DataFrame) -> DataFrame:
    """Store a table whose ``features`` struct has the vector layout; read it back as vectors."""
    fields = [
        StructField(f.name, VectorUDT() if f.name == "features" else f.dataType)
        for f in table.schema.fields
    ]
    path = written(table, "features")
    return table.sparkSession.read.schema(StructType(fields)).parquet(path)


def hashed_encoder(dim: int = 64) -> Callable[[DataFrame], DataFrame]:
    """Built-in text encoder: signed feature hashing of token counts into ``dim`` buckets.

    It works on frames, (key, text) to (key, v), inside the JVM: tokens are counted per text and bucket, and a
    text's sums are put in place as one array.
    """

    def encode(rows: DataFrame) -> DataFrame:
        words = rows.select("key", F.explode(tx.tokenise_alpha(F.col("text"))).alias("word"))
        number = tx.hash_number(F.col("word"))
        sign = F.when(F.pmod(F.floor(number / dim), F.lit(2)) == 0, 1.0).otherwise(-1.0)
        sums = words.repartition("key").groupBy("key", F.pmod(number, F.lit(dim)).cast("int").alias("place")).agg(F.sum(sign).alias("s"))
        entries = sums.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("place", "s"))).alias("_s"))
        at = lambda j: F.coalesce(F.try_element_at("_s", j), F.lit(0.0))
        found = rows.select("key").join(entries, "key", "left")
        return found.select("key", F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), at).alias("v"))

    encode.on_frames = True
    return encode


def embed_corpus_cached(
    corpus: DataFrame,
    cache_path: str,
    encoder: Callable,
    encoder_name: str,
    prefix: str = "",
    batch: int = 64,
    rows_per_commit: int = 10_000_000,
) -> DataFrame:
    """(row_id, v): unit vectors of ``prefix + text``, each distinct text encoded once.

    ``encoder`` maps a batch of texts to vectors, or, with the attribute ``on_frames``, a frame (key, text)
    to (key, v). The cache is a table (encoder, key, v) keyed by the text's digest; a call encodes only
    keys that are not in it and appends them, ``rows_per_commit`` at a time. Rows that share
    a text share its vector.
    """
    spark = corpus.sparkSession
    text = F.concat(F.lit(prefix), F.col("text"))
    keyed = corpus.select("row_id", text.alias("text"), F.sha2(text, 256).alias("key"))
    known = read_cache(spark, cache_path, "encoder string, key string, v array<double>").where(
        F.col("encoder") == encoder_name
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                matrix = np.vstack(encoder(part["text"]))
                norms = np.linalg.norm(matrix, axis=1, keepdims=True)
                unit = np.divide(matrix, norms, out=matrix.copy(), where=norms > 0)
                yield pd.DataFrame({"key": part["key"].to_numpy(), "v": list(unit)})

    def computed(rows: DataFrame) -> DataFrame:
        if getattr(encoder, "on_frames", False):
            return encoder(rows).withColumn("v", l2_normalise(F.col("v")))
        return rows.mapInPandas(encode, "key string, v array<double>")

    distinct = keyed.groupBy("key").agg(F.first("text").alias("text"))
    missing = distinct.join(known.select("key"), "key", "left_anti")
    append_in_waves(
        missing, "key", rows_per_commit, cache_path,
        lambda rows: computed(rows).select(F.lit(encoder_name).alias("encoder"), "key", "v"),
    )
    cache = spark.read.parquet(cache_path).where(F.col("encoder") == encoder_name)
    vectors = one_per_key(cache.select("key", "v"), "key")
    return keyed.select("row_id", "key").join(vectors, "key").select("row_id", "v")


def append_in_waves(
    missing: DataFrame, key: str, rows_per_commit: int, path: str, compute: Callable[[DataFrame], DataFrame]
) -> None:
    """Append ``compute(missing)`` to the table at ``path`` in commits of about ``rows_per_commit``.

    The missing rows are stored and dealt out by the hash of their key. A run that breaks
    off loses the wave it was in; the next one starts from what was committed.
    """
    todo = stored(missing, "missing")
    waves = max(1, -(-todo.count() // rows_per_commit))
    for wave in range(waves):
        rows = todo if waves == 1 else todo.where(F.pmod(F.xxhash64(key), F.lit(waves)) == wave)
        compute(rows).write.mode("append").parquet(path)


def one_per_key(cache: DataFrame, key: str) -> DataFrame:
    """The cache itself, or a stored copy without repeats if two writers have met.

    Either way the join that follows reads a plain table, so the skew join can split a
    text that very many rows share.
    """
    repeats = cache.groupBy(key).count().where("count > 1")
    return cache if repeats.isEmpty() else stored(cache.dropDuplicates([key]), "cache")


def read_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Cache table at ``path``, empty if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)
