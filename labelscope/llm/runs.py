"""Periodic runs of words: tiles per period octave, boundary extension, stitched intervals.

A run is a stretch of consecutive words with smallest period q (words q apart are identical)
and at least max(SHORTEST, EXPONENT * q) words that no neighbouring word extends.

Octave P covers the periods P to 2P - 1. A run of such a period holds two neighbouring anchors
(multiples of P) whose blocks of P words come again p words later. So an octave compares the
fingerprint of each anchor's block with those of the P places that follow the block, n comparisons
for n words. Anchors that hit one after the other at one p make an interval; where the next
anchor misses, at most P words on either side are compared one by one. Texts too short for an
octave leave it, so the work is n log n.

The words of an octave are dealt into tiles of at least TILE words that overlap by 8P; every tile is
solved for itself. A run that crosses a border has a piece of at least EXPONENT periods in each of its
tiles or lies in one, and two pieces overlap by a period or more. The pieces go by (text, period)
through a shuffle that joins them again. A piece whose period has a divisor that is a period too is left out;
inside a known run of period q that holds at every multiple of q, so these are not even extended.

Words are told apart by 64-bit hashes. A null or empty text has no words and no runs. Repeated
rows come back as often as they came in; a null doc_id is no decimal number, so its text is not
rewritten. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelscope.llm import tokens
from labelscope.runtime import stored

SHORTEST, EXPONENT = 6, 4
#: Words of a tile, at least; words that an extension compares at once.
TILE, COMPARED = 1 << 17, 1 << 20
FACTOR = tokens.mixed(np.arange(64, dtype=np.uint64) + np.uint64(1 << 20)) | np.uint64(1)
FOUND = "doc_id long, n long, plain string, body string, fragments array<struct<period: int, start: int, end: int>>"


def matching(codes: np.ndarray, at: np.ndarray, step: int, period: np.ndarray, width: int) -> np.ndarray:
    """How many places in a row from ``at`` (forwards, or backwards for step -1) equal the one a period later; at most ``width``."""
    found = np.empty(len(at), np.int64)
    each = max(1, COMPARED // width)
    for a in range(0, len(at), each):
        place = at[a:a + each, None] + step * np.arange(width)
        later = place + period[a:a + each, None]
        inside = (place >= 0) & (later < len(codes))
        same = inside & (codes[np.where(inside, place, 0)] == codes[np.where(inside, later, 0)])
        found[a:a + each] = np.where(same.all(axis=1), width, same.argmin(axis=1))
    return found


class Cover:
    """For each word the end and the period of a known run that holds it."""

    def __init__(self, n: int):
        self.end, self.period = np.zeros(n, np.int64), np.ones(n, np.int64)

    def add(self, period: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Takes the pieces of one octave; those of one run count as joined."""
        joined = []
        for k in np.lexsort((start, period)).tolist():
            if joined and joined[-1][0] == period[k] and start[k] <= joined[-1][2] - period[k]:
                joined[-1][2] = max(joined[-1][2], end[k])
            else:
                joined.append([period[k], start[k], end[k]])
        for p, a, b in sorted(joined, key=lambda x: x[2] - x[1]):
            self.end[a:b], self.period[a:b] = b, p


def tile_intervals(codes: np.ndarray, prints: np.ndarray, width: int, end: np.ndarray, period: np.ndarray):
    """(period, start, end) of the runs in one tile with periods ``width`` to 2 * width - 1; ``end`` and ``period`` are
    those of a known run at each word, in places of the tile."""
    rows = len(codes) // width
    none = (np.zeros(0, np.int64),) * 3
    if rows < 3:
        return none
    table = prints[:rows * width].reshape(rows, width)
    hit = table[1:] == table[:-1, :1]
    anchors = np.arange(rows - 2) * width
    row, shift = np.nonzero((hit[:-1] & hit[1:]) & (end[anchors] < anchors + 4 * width)[:, None])
    if not len(row):
        return none
    order = np.lexsort((row, shift))
    row, shift = row[order], shift[order]
    head = np.ones(len(row), bool)
    head[1:] = (shift[1:] != shift[:-1]) | (row[1:] != row[:-1] + 1)
    tail = np.append(head[1:], True)
    p = width + shift[head]
    start, stop = row[head] * width, np.minimum((row[tail] + 2) * width + p, len(codes))
    new = (stop > end[start]) | (p % period[start] != 0)
    p, start, stop = p[new], start[new], stop[new]
    start = start - matching(codes, start - 1, -1, p, width)
    stop = stop + matching(codes, stop - p, 1, p, width)
    full = stop - start >= np.maximum(SHORTEST, EXPONENT * p)
    p, start, stop = p[full], start[full], stop[full]
    smallest = np.array([primitive(codes[a:a + 2 * q], q) for q, a in zip(p.tolist(), start.tolist())], bool)
    return p[smallest], start[smallest], stop[smallest]


def primitive(codes: np.ndarray, p: int) -> bool:
    """Whether no divisor of ``p`` is a period of the stretch of period ``p`` that begins with ``codes`` (2p words)."""
    rest, k = p, 2
    while rest > 1:
        k = k if k * k <= rest else rest
        if rest % k == 0:
            if np.array_equal(codes[:p], codes[p // k:p // k + p]):
                return False
            while rest % k == 0:
                rest //= k
        k += 1
    return True


def fragments(codes: np.ndarray, at: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, start, end) of the pieces of runs in ``codes``, the words of texts with offsets ``at``; words of
    different texts must differ."""
    n = np.diff(at)
    size = np.repeat(n, n)
    place = np.flatnonzero(size >= SHORTEST)
    cover, found, width = Cover(len(codes)), [], 1
    codes, prints = codes[place], codes[place]
    while len(place):
        length = max(tile // width, 64) * width
        known = len(found)
        for a in range(0, max(1, len(place) - 8 * width), length - 8 * width):
            here = place[a:a + length]
            shift = here - np.arange(len(here))  # texts that left the octave make jumps; runs have none
            p, start, end = tile_intervals(codes[a:a + length], prints[a:a + length], width, cover.end[here] - shift, cover.period[here])
            found.append((p, here[start], here[end - 1] + 1))
        cover.add(*(np.concatenate(x) for x in zip(*found[known:])))
        doubled = prints * FACTOR[width.bit_length()]
        doubled[:-width or None] += prints[width:]
        width *= 2
        left = size[place] >= EXPONENT * width
        place, codes, prints = place[left], codes[left], doubled[left]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers of a text of ``n`` words after the contract's rewriting; None where it stays as it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def slice_rows(part: pa.RecordBatch, rewrite) -> pa.RecordBatch:
    texts = part.column("text")
    words, rows = tokens.split_words(texts, lower=False), part.num_rows
    at = tokens.segments(words.row, rows)
    ids, n = part.column("doc_id").to_pylist(), np.diff(at).tolist()
    source, changed = np.arange(len(words.row)), {}
    for k in range(rows):
        order = rewrite(ids[k], n[k])
        if order is not None:
            changed[k] = order
            source[at[k]:at[k + 1]] = at[k] + order
    codes = tokens.mixed(words.hash[source] + words.row.astype(np.uint64) * FACTOR[0])
    period, start, end = fragments(codes, at)
    order = np.argsort(start, kind="stable")
    period, start, end = period[order], start[order], end[order]
    row = words.row[start]
    bounds = tokens.segments(row, rows)
    plain, body = [None] * rows, [None] * rows
    for k, text in enumerate(texts):
        cut = text.as_buffer().to_pybytes().split()
        if k in changed:
            cut = [cut[x] for x in changed[k].tolist()]
        joined = b" ".join(cut)
        if bounds[k] < bounds[k + 1]:
            body[k] = joined.decode()
        else:
            plain[k] = hashlib.sha256(joined).hexdigest()
    values = [pa.array((x - y).astype(np.int32)) for x, y in ((period, 0), (start, at[row]), (end, at[row]))]
    pieces = pa.StructArray.from_arrays(values, ["period", "start", "end"])
    return pa.RecordBatch.from_pydict({
        "doc_id": part.column("doc_id"), "n": pa.array(n, pa.int64()), "plain": pa.array(plain, pa.string()), "body": pa.array(body, pa.string()),
        "fragments": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pieces),
    })


def found_fragments(docs: DataFrame, rewrite) -> DataFrame:
    """FOUND for every row: ``plain`` is the digest of the words joined by a space, or, where there are fragments, ``body`` those words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.text_slices(batch):
                yield slice_rows(part, rewrite)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, FOUND)


def stitched(pieces: DataFrame) -> DataFrame:
    """(row, start, end, period): pieces of one row and period that overlap by a period or more, joined."""
    by_start = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    cut = pieces.withColumn("_new", F.coalesce((F.col("start") > before - F.col("period")).cast("int"), F.lit(1)))
    joined = cut.withColumn("_run", F.sum("_new").over(by_start)).groupBy("row", "period", "_run")
    return joined.agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")


def collapsed(rows: DataFrame) -> DataFrame:
    """row, collapsed: digest of the words of ``body`` that no run holds after its first period."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for body, runs in zip(batch.column("body"), batch.column("runs").to_pylist()):
                cut = body.as_buffer().to_pybytes().split(b" ")
                gone = np.zeros(len(cut) + 1, np.int64)
                for run in runs or ():
                    gone[run["start"] + run["period"]] += 1
                    gone[run["start"] + run["length"]] -= 1
                left = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                digests.append(hashlib.sha256(b" ".join([cut[x] for x in left])).hexdigest())
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "collapsed": pa.array(digests, pa.string())})

    return rows.select("row", "body", "runs").mapInArrow(task, "row long, collapsed string")


def runs_by_text(docs: DataFrame, rewrite=lambda doc_id, n: None) -> DataFrame:
    """doc_id, n, runs (array of start, period, length by start, then period), collapsed (SHA-256 of the words that are
    left when every run keeps its first period, joined by a space) for every row of ``docs``.

    ``rewrite(doc_id, n)`` may give other word numbers to a text of n words.
    """
    found = stored(found_fragments(docs, rewrite).withColumn("row", F.monotonically_increasing_id()), "run-fragments")
    some = found.where("body is not null")
    runs = stitched(some.select("row", F.explode("fragments").alias("_piece")).select("row", "_piece.*"))
    run = F.struct("start", "period", (F.col("end") - F.col("start")).alias("length"))
    runs = stored(runs.groupBy("row").agg(F.array_sort(F.collect_list(run)).alias("runs")), "runs")
    digests = collapsed(some.select("row", "body").join(runs, "row"))
    with_runs = some.select("row", "doc_id", "n").join(runs, "row").join(digests, "row").select("doc_id", "n", "runs", "collapsed")
    empty = F.array().cast("array<struct<start: int, period: int, length: int>>")
    return with_runs.union(found.where("body is null").select("doc_id", "n", empty, "plain"))


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the longest run, and both digests."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("a"), (-r["period"]).alias("b"))))
    number = lambda c: c.cast("string")
    line = lambda r: F.concat(number(r["start"]), F.lit(","), number(r["length"]), F.lit(","), number(r["period"]), F.lit("\n"))
    whole = lambda c: c.cast("long")
    cut: Column = F.floor(1000 * whole(F.col("_best.length")) / -F.col("_best.b"))
    return found.withColumn("_best", best).select(
        "doc_id", whole(F.size("runs")).alias("n_runs"), whole(-F.col("_best.a")).alias("start"), whole(F.col("_best.length")).alias("length"),
        whole(-F.col("_best.b")).alias("period"), whole(cut).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )
