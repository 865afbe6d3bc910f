"""Long texts in overlapping chunks: cut, encode, pool."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelscope.functions import text as tx
from labelscope.functions.bind import bind

#: Chunks whose vectors are pooled first, before the pools of a text are.
GROUP = 64


def chunks(corpus: DataFrame, size: int = 128, stride: int = 96, keep: tuple[str, ...] = ()) -> DataFrame:
    """(row_id, *keep, chunk, start, end, text): windows of ``size`` words, one every ``stride`` words.

    ``start`` and ``end`` (exclusive) number the words of the text from 0; a chunk's text is its words joined by a
    blank. The last chunk is the first one that reaches the end. A text of up to ``size`` words is one chunk, a text
    without words or a null one is one empty chunk. Chunks are cut in place, without a shuffle.
    """
    if not 0 < stride <= size:
        raise ValueError("stride must be between 1 and size")
    words = tx.words(F.coalesce("text", F.lit("")))
    last = lambda w: F.greatest(F.ceil((F.size(w) - size) / F.lit(float(stride))), F.lit(0)).cast("int")

    def window(w: Column) -> Callable[[Column], Column]:
        def one(k: Column) -> Column:
            start = k * stride
            end = F.least(start + size, F.size(w))
            return F.struct(
                k.cast("bigint").alias("chunk"), start.cast("bigint").alias("start"), end.cast("bigint").alias("end"),
                F.array_join(F.slice(w, start + 1, F.lit(size)), " ").alias("text"),
            )
        return one

    cut = bind(words, lambda w: F.transform(F.sequence(F.lit(0), last(w)), window(w)))
    return corpus.select("row_id", *keep, F.inline(cut))


def added(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a + b)


def larger(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.greatest(a, b))


def folded(vectors: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """One vector from an array of vectors, dimension by dimension."""
    return F.aggregate(F.slice(vectors, F.lit(2), F.size(vectors)), F.get(vectors, F.lit(0)), merge)


def pool(vectors: DataFrame) -> DataFrame:
    """(row_id, n_chunks, mean, largest): per row the mean and the maximum of its chunk vectors, by dimension.

    ``vectors`` has (row_id, chunk, v), v of one length. Dimensions stay inside the row. The chunks of a text are
    pooled GROUP by GROUP, then the pools, so that the vectors one task holds for a text
    are GROUP, then a GROUP-th of its chunks.
    """
    part = F.floor(F.col("chunk") / GROUP)
    groups = vectors.groupBy("row_id", part.alias("_part")).agg(F.collect_list("v").alias("_all"))
    pools = groups.select("row_id", F.size("_all").alias("_n"), folded(F.col("_all"), added).alias("_sum"), folded(F.col("_all"), larger).alias("_top"))
    rows = pools.groupBy("row_id").agg(
        F.sum("_n").alias("n_chunks"), F.collect_list("_sum").alias("_sums"), F.collect_list("_top").alias("_tops")
    )
    mean = bind(F.col("n_chunks"), lambda n: F.transform(folded(F.col("_sums"), added), lambda x: x / n))
    return rows.select("row_id", "n_chunks", mean.alias("mean"), folded(F.col("_tops"), larger).alias("largest"))


def chunk_and_pool(corpus: DataFrame, encode: Callable[[DataFrame], DataFrame], size: int = 128, stride: int = 96) -> DataFrame:
    """(row_id, n_chunks, mean, largest) of whole texts of any length.

    ``encode`` maps (row_id, text) to (row_id, v); it gets the chunks, with (row_id, chunk) as their row_id, so a cached
    encoder works on chunks as on texts and encodes equal chunks once.
    """
    cut = chunks(corpus, size, stride).select(F.struct("row_id", "chunk").alias("row_id"), "text")
    return pool(encode(cut).select("row_id.row_id", "row_id.chunk", "v"))
