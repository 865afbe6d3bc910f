"""SuperMinHash near-duplicates: signatures, banding, exact check, grouping.

``near_duplicates`` reads whole texts. Words are runs of non-blank characters, A-Z lower-cased;
a document's set has its distinct ``width``-word shingles (with fewer words: the whole
sequence as one). Texts without words, empty and null texts have an empty set and are linked
with nothing. Shingles are 64-bit hashes, sets are told apart by 128 bits.

Steps: one pass makes a signature per text; equal sets collapse to their smallest id; reps
that share a band become candidates (star edges to the smallest id in each band bucket, whose
components contain every true link); the full sets of candidates are then checked exactly,
first against the pivot of their component, then block by block for what is left; union-find
over confirmed links gives the component.

Chance to miss a pair: (1 - J**rows)**bands, which is 8e-8 at J = 0.8 and 1e-10 at 0.85.

Rows with the same doc_id count as versions of one document and share a component; a row
with a null doc_id is kept and has a null component. Repeated rows come back as often as
they came in. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelscope.llm import graph, tokens
from labelscope.runtime import stored

BANDS, ROWS = 31, 4
ODD = tokens.mixed(np.arange(64, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: pa.Array, width: int):
    """Distinct shingles of each text: (row, shingle, offsets)."""
    words, rows = tokens.split_words(texts, lower=True), len(texts)
    at = tokens.segments(words.row, rows)
    count = np.diff(at)
    n = len(words.hash)
    full = max(n - width + 1, 0)
    value = np.zeros(full, np.uint64)
    for k in range(width):
        value += words.hash[k:k + full] * ODD[k]
    inside = words.row[:full] == words.row[n - full:]
    row, key = words.row[:full][inside], tokens.mixed(value[inside])
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = count[short] > k
            whole[has] += words.hash[at[short[has]] + k] * ODD[32 + k]
        row, key = np.concatenate([row, short]), np.concatenate([key, tokens.mixed(whole)])
        order = np.argsort(row, kind="stable")
        row, key = row[order], key[order]
    return tokens.sorted_sets(row, key, rows)


def _draw(key: np.ndarray, step: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank in [0, 1) and the swap partner of one step of each element's own shuffle."""
    x = tokens.mixed(key + np.uint64((2 * step + 1) * 0xD1342543DE82EF95 % 2**64))
    rank = (x >> np.uint64(11)).astype(np.float64) * 2.0**-53
    y = tokens.mixed(x ^ np.uint64(0xA0761D6478BD642F))
    return rank, step + ((y >> np.uint64(32)) * np.uint64(size - step) >> np.uint64(32)).astype(np.int64)


def superminhash(row: np.ndarray, key: np.ndarray, rows: int, size: int) -> np.ndarray:
    """Signatures (rows x size): minimum of rank + step over each element's random permutation.

    In step j every element gives one more register of its permutation the value rank + j.
    A text is finished as soon as all its registers are below j + 1: later steps can only
    give larger values. A text of some hundred shingles takes one or two steps.
    """
    table = np.full(rows * size, np.inf)
    rank, partner = _draw(key, 0, size)
    np.minimum.at(table, row * size + partner, rank)
    table = table.reshape(rows, size)
    present = np.zeros(rows, bool)
    present[row] = True
    open_rows = present & (table.max(axis=1) >= 1)
    left = open_rows[row]
    row, key, partner = row[left], key[left], partner[left]
    order = np.tile(np.arange(size, dtype=np.uint8), (len(row), 1))
    each = np.arange(len(row))
    order[each, partner], order[:, 0] = order[:, 0].copy(), partner
    for step in range(1, size):
        if not len(row):
            break
        rank, partner = _draw(key, step, size)
        each = np.arange(len(row))
        register = order[each, partner]
        order[each, partner] = order[:, step]
        order[:, step] = register
        np.minimum.at(table.reshape(-1), row * size + register, rank + step)
        open_rows &= table.max(axis=1) >= step + 1
        left = open_rows[row]
        if not left.all():
            row, key, order = row[left], key[left], order[left]
    return table


def band_keys(table: np.ndarray, bands: int, width: int) -> np.ndarray:
    bits = np.ascontiguousarray(table[:, :bands * width]).view(np.uint64).reshape(len(table), bands, width)
    value = (tokens.mixed(bits) * ODD[:width]).sum(axis=2, dtype=np.uint64)
    return tokens.mixed(value + ODD[0] * np.arange(bands, dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (128 bits of the set), bands (empty without words)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.text_slices(batch):
                n = part.num_rows
                row, key, at = shingle_sets(part.column("text"), width)
                keys = band_keys(superminhash(row, key, n, bands * rows), bands, rows)
                full = np.diff(at) > 0
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"),
                    "n_shingles": pa.array(np.diff(at)),
                    "set_a": pa.array(tokens.summed(key, at).view(np.int64)),
                    "set_b": pa.array(tokens.summed(tokens.mixed(key ^ ODD[7]), at).view(np.int64)),
                    "bands": tokens.lists(keys[full].reshape(-1), np.concatenate([[0], np.cumsum(full * bands)])),
                })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        task, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
    )


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """node, items: the shingle set of each text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.text_slices(batch):
                _, key, at = shingle_sets(part.column("text"), width)
                yield pa.RecordBatch.from_pydict(
                    {"node": part.column("doc_id"), "items": tokens.lists(key.view(np.int64), at)}
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "node long, items array<long>")


def near_duplicates(
    docs: DataFrame, percent: int = 80, width: int = 5, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; see the module."""
    signed = stored(signatures(docs, width, bands, rows), "signatures")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = stored(usable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep")), "set-classes")
    keys = (
        usable.join(classes.withColumnRenamed("rep", "doc_id"), ["set_a", "set_b", "doc_id"], "left_semi")
        .select(F.explode("bands").alias("key"), "doc_id").distinct()
    )
    buckets = keys.groupBy("key").agg(F.min("doc_id").alias("v"), F.max("doc_id").alias("_last")).where("v < _last")
    candidates = stored(
        graph.components(keys.join(buckets.drop("_last"), "key").select(F.col("doc_id").alias("u"), "v")), "candidates"
    )
    reps = docs.join(candidates.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    sets = full_sets(reps, width).join(candidates, "node")
    pivots = sets.where("node = component").select("component", F.col("items").alias("_pivot"))
    shared = F.size(F.array_intersect("items", "_pivot"))
    marked = stored(
        sets.join(pivots, "component")
        .withColumn("_shared", shared)
        .withColumn("matched", 100 * F.col("_shared") >= percent * (F.size("items") + F.size("_pivot") - F.col("_shared")))
        .drop("_pivot", "_shared")
        .withColumns({"rest": F.col("node") != F.col("component"), "unmatched": ~F.col("matched")}),
        "marked-sets",
    )
    direct = marked.where("matched and rest").select(F.col("node").alias("u"), F.col("component").alias("v"))
    others = graph.in_cells(marked, "rest", "unmatched", percent, graph.tree_links, "u long, v long")
    copies = usable.join(classes, ["set_a", "set_b"]).where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    labelled = graph.components(direct.union(others).union(copies)).toDF("doc_id", "component_id")
    return (
        signed.select("doc_id", "n_shingles").join(labelled, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
