"""Exact top-k inner-product search by term-at-a-time accumulation.

Vector components become integers, floor(scale * x) with x as double, and each dimension is a
term. Candidates are dealt into blocks by a hash of their id and queries likewise; a cell (query block x
candidate block) builds the postings of each dimension once, scatters weight * posting into a
dense score array for every nonzero weight of a query, and selects the best k of the block.
Selections of the blocks merge by a window per query. A cell holds two blocks, whatever the
size of the table; every query meets every candidate.

Vectors that are null, or hold a null or non-finite component, and rows with a null vec_id
take no part. A shorter vector has zeros in the missing dimensions. Rows with the query's own
vec_id are not its candidates. Every row counts for itself: a repeated candidate is found as often as it is stored,
and a vec_id that several query rows have gets a list for each of them. Ties go to the smaller
vec_id. Sums wrap at 64 bits. Empty tables give an empty result.

A cell's blocks follow the length of the vectors: BLOCK_BYTES each, so a table of n candidates
is copied once per lot of queries of that many bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelscope.runtime import stored

#: Bytes of the vectors of a block, candidates or queries.
BLOCK_BYTES = 1 << 23


def components(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(F.forall("v", finite), F.lit(False)))
        .select("vec_id", components(F.col("v"), scale).alias("v"))
    )


def postings(rows: pa.Table) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Ids in ascending order, and per term the places and values of its nonzero components."""
    order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")
    rows = rows.take(order)
    vectors = rows["v"].combine_chunks()
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    dense = np.zeros((int(sizes.max(initial=0)), len(sizes)), np.int64)
    place = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    dense[term, place] = pc.list_flatten(vectors).to_numpy(zero_copy_only=False)
    terms = []
    for values in dense:
        where = np.flatnonzero(values)
        terms.append((slice(None), values) if len(where) == len(values) else (where, values[where]))
    return rows["vec_id"].to_numpy(), terms


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller place."""
    if len(scores) <= k:
        return np.arange(len(scores))
    limit = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > limit)
    return np.concatenate([above, np.flatnonzero(scores == limit)[:k - len(above)]])


def search_cell(table: pa.Table, k: int) -> pa.Table:
    queries = table.filter(pc.equal(table["side"], 0))
    ids, terms = postings(table.filter(pc.equal(table["side"], 1)))
    found = []
    for row, query, weights in zip(*(queries[c].to_pylist() for c in ("row", "vec_id", "v")), strict=True):
        scores = np.zeros(len(ids), np.int64)
        for weight, (where, values) in zip(weights, terms):
            if weight:
                scores[where] += weight * values
        others = np.flatnonzero(ids != query) if len(ids) else np.zeros(0, np.int64)
        chosen = others[best(scores[others], k)]
        found.append((np.full(len(chosen), row), np.full(len(chosen), query), ids[chosen], scores[chosen]))
    parts = [np.concatenate(x) for x in zip(*found)] or [np.zeros(0, np.int64)] * 4
    return pa.table(dict(zip(("row", "query_id", "vec_id", "score"), map(pa.array, parts))))


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each row where ``is_query`` holds."""
    rows = stored(usable(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = rows.where(is_query)
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    block = max(1, BLOCK_BYTES // (8 * max(1, width)))
    blocks, lots = max(1, -(-n // block)), max(1, -(-queries.count() // block))
    place = lambda count: F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    copies = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = queries.select("row", "vec_id", "v", place(lots).alias("lot"), copies(blocks).alias("block"), F.lit(0).alias("side"))
    right = rows.select("row", "vec_id", "v", copies(lots).alias("lot"), place(blocks).alias("block"), F.lit(1).alias("side"))
    partial = left.union(right).groupBy("lot", "block").applyInArrow(
        lambda table: search_cell(table, k), "row long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
