"""Exact cosine nearest neighbours, and what follows from them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelscope.functions.scores import l2_normalise, vector_norm
from labelscope.functions.text import seeded_hash
from labelscope.runtime import stored

SLACK = 1e-6  # covers rounding in distance bounds
#: Similarities are compared at 9 digits: a squared distance may be that much larger and still tie.
TIE = 4e-9
#: Digits of a similarity; queries that are compared with a block at once.
DIGITS, TOGETHER = 9, 64
#: Bundles of cells that the base makes at least, where none holds more than ``block_rows``.
BUNDLES = 16
HIT = "query_id long, neighbour_id long, label string, similarity double"


def nearest(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    exclude_self: bool = False,
    block_rows: int = 1 << 16,
    max_pivots: int = 1024,
) -> DataFrame:
    """(query_id, neighbour_id, label, similarity, place): the k most similar base vectors.

    ``queries`` has (vec_id, v), ``base`` (vec_id, v, label). Exact, and without pairing
    all rows: base vectors are grouped around pivots, and a query visits only groups that
    the triangle inequality cannot rule out.

    1. A bounded number of base vectors serves as pivots; every vector goes to the cell of
       its nearest pivot, turned so that its first dimensions hold most of the pivots' spread. A crowded cell is
       split into blocks of about ``block_rows``, so a cluster of copies spreads over many tasks.
    2. Each query searches one block of its own cell. Its k-th similarity there is a lower
       bound for the true one.
    3. The query is then sent to the other blocks of cells closer than that bound. Small cells travel as bundles of up
       to ``block_rows`` vectors, so a query comes once per bundle, with the cells it visits there. Inside, the first
       dimensions and the norm of the rest bound a similarity from above (Cauchy-Schwarz); only vectors that
       reach the bound of a query are multiplied in full, and only hits that reach it come back.

    Zero vectors are similar to nothing: as base they stand aside, and the k (or k + 1) of them with the
    smallest ids are offered to every query at similarity 0; a zero query gets the smallest ids of all.
    Without clusters little is ruled out, and every query meets every block: each vector then travels once
    per ``block_rows`` vectors of the other side. Equal similarities (9 digits) are ordered by neighbour id.
    """
    spark = base.sparkSession
    unit = lambda df, *more: df.select("vec_id", l2_normalise(F.col("v")).alias("v"), *more)
    is_zero = vector_norm(F.col("v")) == 0
    base_u, queries_u = unit(base, "label"), unit(queries)
    need = k + (1 if exclude_self else 0)
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "neighbour_id")
    best = lambda found: found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    aside = best(offered(queries_u.where(is_zero), base_u, need, exclude_self).unionByName(
        offered(queries_u.where(~is_zero), base_u.where(is_zero), need, exclude_self)
    ))

    base_u, queries_u = base_u.where(~is_zero), queries_u.where(~is_zero)
    n_base = base_u.count()
    n_pivots = max(1, min(max_pivots, math.isqrt(n_base)))
    sample = base_u.orderBy(seeded_hash(F.col("vec_id"), ":pivot"), "vec_id").limit(n_pivots).collect()
    if not sample:
        return aside
    pivots = np.array([r["v"] for r in sample], dtype=float)  # at most max_pivots rows
    turn = rotation(pivots)
    pivots = pivots @ turn

    cells = stored(in_cells(base_u, pivots, turn, "label string"), "cells")
    stats = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("r")).collect()
    count, radius = np.zeros(len(pivots), dtype=int), np.full(len(pivots), -1.0)
    for row in stats:
        count[row["cell"]], radius[row["cell"]] = row["n"], row["r"]
    parts = np.maximum(1, -(-count // block_rows))
    located = stored(in_cells(queries_u, pivots, turn), "located")
    crowd = located.groupBy("cell").agg(F.count("*").alias("n")).collect()
    waiting = np.zeros(len(pivots), dtype=int)
    for row in crowd:
        waiting[row["cell"]] = row["n"]

    lookup = lambda values: F.element_at(F.lit([int(x) for x in values]), F.col("cell") + 1)
    number = lambda column: F.xxhash64(column)
    blocks = cells.withColumn("part", F.pmod(number("vec_id"), lookup(parts)).cast("int"))
    bundle = bundled(count, parts, np.argsort(pivots[:, 0]), min(block_rows, -(-n_base // BUNDLES)))

    def search(visits: DataFrame, copies: np.ndarray, place: list[str], at: str) -> DataFrame:
        """Visits (query_id, q, worst, ...) meet the block of their ``place``; many visits share its copies, which
        ``copies`` has by the column ``at``."""
        n_copies = F.element_at(F.lit([int(x) for x in copies]), F.col(at) + 1)
        left = visits.withColumn("copy", F.pmod(number("query_id"), n_copies).cast("int"))
        right = blocks.withColumn("bundle", (lookup(bundle) + F.col("part")).cast("int"))
        right = right.withColumn("copy", F.explode(F.sequence(F.lit(0), n_copies - 1)))
        key = [*place, "copy"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
            lambda a, b: best_in_block(a, b, k, exclude_self), HIT
        )

    home = located.select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "cell",
        F.pmod(number("vec_id"), lookup(parts)).cast("int").alias("part"),
    )
    start = home.withColumn("worst", F.lit(-2.0))
    first = stored(search(start, np.maximum(1, -(-waiting // (parts * block_rows))), ["cell", "part"], "cell"), "first-round")
    bound = first.groupBy("query_id").agg(F.count("*").alias("found"), F.min("similarity").alias("least"))
    reached = F.when(F.col("found") >= k, F.col("least")).otherwise(F.lit(-2.0))
    plan = home.join(bound, "query_id", "left").withColumn("worst", F.coalesce(reached, F.lit(-2.0))).drop("found", "least")
    shared = spark.sparkContext.broadcast((pivots, count, radius, parts, bundle))

    def visits_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """For some queries at a time: queries, per cell to visit its number, and per visit the query's place, the
        bundle and where its cells begin."""
        pivot, n_in, reach, n_parts, first_bundle = shared.value
        for frame in batches:
            for start in range(0, len(frame), TOGETHER):
                some = frame.iloc[start : start + TOGETHER]
                gap = distances(np.vstack(some["q"].to_numpy()), pivot)
                worst = some["worst"].to_numpy()
                seen = np.where(worst >= -1, np.sqrt(np.maximum(0.0, 2 - 2 * worst)), np.inf)
                limit = np.sqrt(np.minimum(kth_upper_bound(gap, n_in, reach, need), seen) ** 2 + TIE) + SLACK
                row, cell = np.nonzero((gap - reach <= limit[:, None]) & (n_in > 0))
                n = n_parts[cell]
                place = np.repeat(row, n)
                part = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                cell = np.repeat(cell, n)
                done = (cell == some["cell"].to_numpy()[place]) & (part == some["part"].to_numpy()[place])
                place, cell, target = place[~done], cell[~done], (first_bundle[cell] + part)[~done]
                order = np.lexsort((cell, target, place))
                place, cell, target = place[order], cell[order], target[order]
                begin = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(target, prepend=-1) != 0))
                yield some, cell, place[begin], target[begin], begin

    def count_visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n_bundles, dtype="int64")
        for _, _, _, target, _ in visits_of(batches):
            np.add.at(total, target, 1)
        yield pd.DataFrame({"bundle": np.arange(len(total), dtype="int32"), "n": total})

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some, cell, place, target, begin in visits_of(batches):
            for start in range(0, len(place), 4096):
                at = slice(start, start + 4096)
                columns = {c: some[c].to_numpy()[place[at]] for c in ("query_id", "q", "worst", "cell")}
                cells_of = np.split(cell, begin[1:])[at] if len(begin) else []
                yield pd.DataFrame({**columns, "bundle": target[at].astype("int32"), "cells": cells_of})

    n_bundles = int((bundle + parts).max())
    load = plan.mapInPandas(count_visits, "bundle int, n long").groupBy("bundle").agg(F.sum("n").alias("n"))
    copies = np.ones(n_bundles, dtype=int)
    for row in load.collect():
        copies[row["bundle"]] = max(1, -(-row["n"] // block_rows))
    visits = plan.mapInPandas(route, "query_id long, q array<double>, worst double, cell int, bundle int, cells array<int>")
    return best(first.unionByName(search(visits, copies, ["bundle"], "bundle")).unionByName(aside.drop("place")))


def bundled(count: np.ndarray, parts: np.ndarray, order: np.ndarray, rows: int) -> np.ndarray:
    """Number of each cell's (first) bundle: neighbours in ``order`` share one of up to ``rows`` vectors; the parts of a
    cell that is split are bundles of their own, numbered on."""
    found, number, held = np.zeros(len(count), dtype=int), 0, 0
    for cell in order:
        if held and (parts[cell] > 1 or held + count[cell] > rows):
            number, held = number + 1, 0
        found[cell] = number
        if parts[cell] > 1:
            number += parts[cell]
        else:
            held += count[cell]
    return found


def offered(queries: DataFrame, base: DataFrame, need: int, exclude_self: bool) -> DataFrame:
    """HIT at similarity 0 of every query with the ``need`` smallest ids of ``base``."""
    few = base.orderBy("vec_id").limit(need).agg(F.collect_list(F.struct(F.col("vec_id").alias("neighbour_id"), "label")).alias("_few"))
    pairs = queries.select(F.col("vec_id").alias("query_id")).join(few).select("query_id", F.inline("_few"))  # one row on the right
    pairs = pairs.where("query_id <> neighbour_id") if exclude_self else pairs
    return pairs.withColumn("similarity", F.lit(0.0))


def rotation(pivots: np.ndarray) -> np.ndarray:
    """Orthogonal matrix whose first columns hold most of the pivots' spread."""
    _, directions = np.linalg.eigh(pivots.T @ pivots)
    return directions[:, ::-1]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances; rows are unit vectors."""
    square = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def in_cells(vectors: DataFrame, pivots: np.ndarray, turn: np.ndarray, more: str = "") -> DataFrame:
    """Turn the vectors; add the nearest pivot (cell) and the distance to it."""
    shared = vectors.sparkSession.sparkContext.broadcast((pivots, turn))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            if frame.empty:
                continue
            pivot, turned = shared.value
            rows = np.vstack(frame["v"].to_numpy()) @ turned
            gap = distances(rows, pivot)
            cell = gap.argmin(1)
            yield frame.assign(v=list(rows), cell=cell.astype("int32"), dist=gap[np.arange(len(rows)), cell])

    schema = "vec_id long, v array<double>" + (f", {more}" if more else "") + ", cell int, dist double"
    return vectors.mapInPandas(assign, schema)


def kth_upper_bound(gap: np.ndarray, n_in: np.ndarray, reach: np.ndarray, need: int) -> np.ndarray:
    """Distance within which at least ``need`` base vectors must lie, from cell sizes alone."""
    outer = np.where(n_in > 0, gap + reach, np.inf)
    order = outer.argsort(1)
    filled = np.cumsum(n_in[order], axis=1) >= need
    at = np.where(filled.any(1), filled.argmax(1), -1)
    picked = outer[np.arange(len(gap)), order[np.arange(len(gap)), at]]
    return np.where(at >= 0, picked, np.inf)


def best_in_block(
    visits: pd.DataFrame, block: pd.DataFrame, k: int, exclude_self: bool
) -> pd.DataFrame:
    """Top k of one block for every visiting query, as far as they reach its ``worst``. Visits with ``cells`` see only
    these cells of the block; they are taken by their own cell, so that those compared at once see much the same."""
    out = []
    if len(visits) and len(block):
        some_cells = "cells" in visits
        if some_cells:
            visits = visits.sort_values("cell", kind="stable")
            names, cell_of = np.unique(block["cell"].to_numpy(), return_inverse=True)
        ids, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
        matrix = np.vstack(block["v"].to_numpy())
        head = max(1, matrix.shape[1] // 4)
        heads, tail = np.ascontiguousarray(matrix[:, :head]), np.sqrt((matrix[:, head:] ** 2).sum(1))
        seen = np.arange(len(matrix))
        for start in range(0, len(visits), TOGETHER):
            part = visits.iloc[start : start + TOGETHER]
            query_ids, q, worst = part["query_id"].to_numpy(), np.vstack(part["q"].to_numpy()), part["worst"].to_numpy()[:, None]
            limit = worst - 10.0**-DIGITS
            if some_cells:
                lists = part["cells"].tolist()
                sees = np.zeros((len(part), len(names)), dtype=bool)
                sees[np.repeat(np.arange(len(part)), [len(x) for x in lists]), np.searchsorted(names, np.concatenate(lists))] = True
                seen = np.flatnonzero(sees.any(axis=0)[cell_of])
            bound = q[:, :head] @ heads[seen].T + np.sqrt((q[:, head:] ** 2).sum(1))[:, None] * tail[seen]
            near = seen[(bound >= limit).any(axis=0)]
            if not len(near):
                continue
            sims = np.round(q @ matrix[near].T, DIGITS)
            sims[sims < worst] = -np.inf
            if some_cells:
                sims[~sees[:, cell_of[near]]] = -np.inf
            own = ids[near]
            if exclude_self:
                sims[query_ids[:, None] == own[None, :]] = -np.inf
            last = max(0, len(own) - k)
            cut = np.partition(sims, last, axis=1)[:, last]
            row, col = np.nonzero((sims >= cut[:, None]) & np.isfinite(sims))
            order = np.lexsort((own[col], -sims[row, col], row))
            row, col = row[order], col[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, col = row[place < k], col[place < k]
            out.append(pd.DataFrame({
                "query_id": query_ids[row], "neighbour_id": own[col],
                "label": labels[near[col]], "similarity": sims[row, col] + 0.0,
            }))
    if not out:
        return pd.DataFrame({"query_id": [], "neighbour_id": [], "label": [], "similarity": []}).astype(
            {"query_id": "int64", "neighbour_id": "int64", "label": "object", "similarity": "float64"}
        )
    return pd.concat(out)


def majority_label(neighbours: DataFrame) -> DataFrame:
    """Most frequent label among a query's neighbours; the smallest label wins a tie."""
    votes = neighbours.groupBy("query_id", "label").agg(F.count("*").alias("n"))
    return votes.groupBy("query_id").agg(F.min(F.struct(-F.col("n"), "label")).alias("b")).select(
        F.col("query_id").alias("vec_id"), F.col("b.label").alias("majority")
    )


def knn_classify(train: DataFrame, test: DataFrame, k: int = 15) -> DataFrame:
    """(vec_id, y_pred) by uniform vote of the k most similar train vectors."""
    votes = majority_label(nearest(test.select("vec_id", "v"), train, k))
    return votes.select("vec_id", F.col("majority").alias("y_pred"))


def neighbour_majority(vectors: DataFrame, k: int = 10) -> DataFrame:
    """Each vector's label and the majority label of its k neighbours, itself left out."""
    found = nearest(vectors.select("vec_id", "v"), vectors, k, exclude_self=True)
    return vectors.select("vec_id", "label").join(majority_label(found), "vec_id")


def misfits(vectors: DataFrame, encoder: str, k: int = 10) -> DataFrame:
    """Rows surrounded by another class."""
    return neighbour_majority(vectors, k).where(F.col("majority") != F.col("label")).select(
        F.lit(encoder).alias("encoder"), "vec_id", "label", "majority"
    )


def repaired(all_misfits: DataFrame, before: str, after: str) -> DataFrame:
    """Rows that are misfits under ``before`` but no longer under ``after``."""
    late = all_misfits.where(F.col("encoder") == after)
    return all_misfits.where(F.col("encoder") == before).join(late, "vec_id", "left_anti")
