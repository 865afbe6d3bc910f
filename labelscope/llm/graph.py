"""Connected components, and exact checks of sets inside candidate components."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelscope.runtime import stored

#: Members of a block; a task of the exact check holds two blocks.
BLOCK = 256
#: Side of a row that is both left and right in its cell.
BOTH = 2
#: Hits of items that a check expands at once.
MATCHES = 1 << 21


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 24))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected edges (u, v); component is the smallest node.

    Alternates the large-star and small-star steps. Every step aggregates and joins, so a
    hub is no single group; each round is written to the shared folder. Self-loops and
    rows with a null are left out; nodes without an edge are not in the result.
    """
    edges = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # stored, so that the join reads two plain tables and a hub's rows can be split
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        edges = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("u").agg(F.min("v").alias("component"))
    return roots.union(roots.select("component", "component").distinct()).toDF("node", "component")


def overlap_counts(flat: np.ndarray, at: np.ndarray, other: np.ndarray) -> np.ndarray:
    """|row ∩ other| for each row of ``flat`` (sets), with ``other`` sorted."""
    if not len(other):
        return np.zeros(len(at) - 1, np.int64)
    place = np.minimum(np.searchsorted(other, flat), len(other) - 1)
    hits = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(other[place] == flat, out=hits[1:])
    return hits[at[1:]] - hits[at[:-1]]


def block_numbers(members: DataFrame, left: str, right: str, block: int | None = None) -> DataFrame:
    """component, _lefts, _rights: blocks of about ``block`` rows (BLOCK) of each component that has rows on both sides."""
    block = block or BLOCK
    return members.groupBy("component").agg(
        F.ceil(F.count_if(F.col(left)) / F.lit(block)).cast("int").alias("_lefts"),
        F.ceil(F.count_if(F.col(right)) / F.lit(block)).cast("int").alias("_rights"),
    ).where("_lefts > 0 and _rights > 0")


def in_cells(sets: DataFrame, left: str, right: str, percent: int, check, schema: str) -> DataFrame:
    """Runs ``check`` on every cell (block of ``left`` rows x block of ``right`` rows) of a component.

    ``sets`` has component, node, items (array<bigint>) and boolean columns ``left`` and
    ``right``. A block holds about BLOCK rows whatever the size of the component, so a
    task holds two blocks at a time. ``check`` gets a Cell with the rows of both. Where left and
    right are the same rows, a block travels once to the cell that compares it with itself.
    Sets that come with ``block_numbers`` save a join.
    """
    same = left == right
    dealt = sets if "_lefts" in sets.columns else sets.join(block_numbers(sets, left, right), "component")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    lefts = dealt.where(left).withColumns({"_a": block("_lefts"), "_b": others("_rights")}).withColumn(
        "side", F.when(F.lit(same) & (F.col("_a") == F.col("_b")), F.lit(BOTH)).otherwise(F.lit(0))
    )
    rights = dealt.where(right).withColumns({"_b": block("_rights"), "side": F.lit(1)}).withColumn("_a", others("_lefts"))
    if same:
        rights = rights.where("_a <> _b")
    both = lefts.unionByName(rights).drop("_lefts", "_rights")
    dealt = both.repartition("component", "_a", "_b").sortWithinPartitions("component", "_a", "_b", "side")
    return dealt.mapInArrow(lambda batches: cell_results(batches, percent, check), schema)


class Cell(NamedTuple):
    """Left rows, then right rows: nodes, sizes and items of both, and ``mark`` (the column that the check needs)."""

    lefts: int
    node: np.ndarray
    items: np.ndarray
    at: np.ndarray
    mark: list

    def left(self) -> tuple[np.ndarray, np.ndarray]:
        ends = self.at[:self.lefts + 1]
        return self.items[ends[0]:ends[-1]], ends - ends[0]

    def right(self, k: int) -> np.ndarray:
        k += self.lefts
        return np.sort(self.items[self.at[k]:self.at[k + 1]])


def cell_results(batches: Iterator[pa.RecordBatch], percent: int, check) -> Iterator[pa.RecordBatch]:
    """Runs ``check`` on each cell of sorted rows; the rows of one cell are held until the next one begins."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        starts = cell_starts(table)
        yield results_of(table.slice(0, starts[-1]), starts, percent, check)
        held = table.slice(starts[-1])
    if held is not None and held.num_rows:
        yield results_of(held, np.array([0, held.num_rows]), percent, check)


def cell_starts(table: pa.Table) -> np.ndarray:
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for name in ("component", "_a", "_b"):
        values = table[name].to_numpy()
        change |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1])


def results_of(table: pa.Table, starts: np.ndarray, percent: int, check) -> pa.RecordBatch:
    lists = table["items"].combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks or [pa.array([], pa.list_(pa.int64()))])
    at, items = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
    node, side, mark = table["node"].to_numpy(), table["side"].to_numpy(), table[check.mark].to_pylist()
    found = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if side[a] == BOTH:
            own, ends = np.tile(items[at[a]:at[b]], 2), at[a:b + 1] - at[a]
            cell = Cell(b - a, np.tile(node[a:b], 2), own, np.concatenate([ends, ends[1:] + ends[-1]]), mark[a:b])
        else:
            cell = Cell(b - a - int(side[a:b].sum()), node[a:b], items, at[a:b + 1], mark[a:b])
        found += check(cell, percent)
    columns = list(zip(*found)) or [()] * len(check.names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, check.types)], check.names)


def tree_links(cell: Cell, percent: int) -> list[tuple[int, int]]:
    """Links (u, v) that join the nodes of a cell into trees; pairs already joined are skipped.

    ``matched`` left nodes are joined to begin with (all are linked with their pivot).
    """
    nodes, rights = cell.node[:cell.lefts], cell.node[cell.lefts:].tolist()
    flat, at = cell.left()
    group = np.arange(cell.lefts)
    matched = np.array(cell.mark[:cell.lefts], bool)
    if matched.any():
        group[matched] = group[np.argmax(matched)]
    place = {node: k for k, node in enumerate(nodes.tolist())}
    sizes, found = np.diff(at), []
    for k, node in enumerate(rights):
        # a right node that is not among the left ones starts as a group of its own
        own = group[place[node]] if node in place else cell.lefts + k
        todo = np.flatnonzero(group != own)
        if not len(todo):
            continue
        mine = cell.right(k)
        shared = overlap_counts(flat, at, mine)
        linked = todo[100 * shared[todo] >= percent * (sizes[todo] + len(mine) - shared[todo])]
        for other in linked[sizes[linked] > 0].tolist():
            if group[other] != own:
                found.append((node, int(nodes[other])))
                group[group == group[other]] = own
    return found


tree_links.mark, tree_links.names, tree_links.types = "matched", ["u", "v"], [pa.int64(), pa.int64()]


def shared_counts(cell: Cell) -> Iterator[tuple[int, np.ndarray]]:
    """|left ∩ right| of a cell in blocks: (first right row, rights x lefts).

    Left items are sorted once; each right item is looked up and adds one to the left rows
    that hold it. A block expands at most MATCHES hits and counts, or those of one right row.
    """
    flat, at = cell.left()
    by = np.argsort(flat, kind="stable")
    held, owner = flat[by], np.repeat(np.arange(cell.lefts), np.diff(at))[by]
    ends = cell.at[cell.lefts:] - cell.at[cell.lefts]
    items = cell.items[cell.at[cell.lefts]:cell.at[-1]]
    low, high = np.searchsorted(held, items), np.searchsorted(held, items, "right")
    hits = np.concatenate([[0], np.cumsum(high - low)])
    bounds, start = hits[ends], 0
    while start < len(ends) - 1:
        stop = min(int(np.searchsorted(bounds, bounds[start] + MATCHES, "right")) - 1, start + MATCHES // max(1, cell.lefts), len(ends) - 1)
        stop = max(start + 1, stop)
        a, b = ends[start], ends[stop]
        n = high[a:b] - low[a:b]
        left = owner[np.repeat(low[a:b] - hits[a:b], n) + np.arange(hits[a], hits[b])]
        right = np.repeat(np.repeat(np.arange(stop - start), np.diff(ends[start:stop + 1])), n)
        yield start, np.bincount(right * cell.lefts + left, minlength=(stop - start) * cell.lefts).reshape(-1, cell.lefts)
        start = stop


def link_counts(cell: Cell, percent: int) -> list[tuple]:
    """Per right node of a cell: number of linked left nodes, and the smallest ``rank`` of them."""
    nodes, rights = cell.node[:cell.lefts], cell.node[cell.lefts:]
    sizes = np.diff(cell.at)
    left, right = sizes[:cell.lefts], sizes[cell.lefts:]
    by = sorted(range(cell.lefts), key=cell.mark.__getitem__)
    place = np.empty(cell.lefts, np.int64)
    place[by] = np.arange(cell.lefts)
    found = []
    for start, shared in shared_counts(cell):
        rows = slice(start, start + len(shared))
        linked = 100 * shared >= percent * (left + right[rows, None] - shared)
        linked &= (nodes != rights[rows, None]) & (left > 0)
        first = np.where(linked, place, cell.lefts).min(axis=1, initial=cell.lefts).tolist()
        ranks = [cell.mark[by[x]] if x < cell.lefts else None for x in first]
        found += zip(rights[rows].tolist(), linked.sum(axis=1).tolist(), ranks)
    return found


link_counts.mark, link_counts.names = "rank", ["node", "links", "first"]
link_counts.types = [pa.int64(), pa.int64(), pa.binary()]
