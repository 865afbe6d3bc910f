"""Words of an Arrow text column as flat numpy arrays.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return. All helpers work on whole texts; long inputs are taken in slices of
whole rows, so that memory follows the slice and the longest text only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
FULL = np.ones(256, bool)
FULL[[32, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The low 0 to 8 bytes of a number; bytes from which a word is digested alone.
LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LONG = 256


class Words(NamedTuple):
    """Per word: row of the slice, first byte, end byte, 64-bit hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, taken eight bytes at a time over all words together."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each place on
    size = end - start
    hashes = mixed((eight[start] & LOW[np.minimum(size, 8)]) + size.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    more, at = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(more):
        part = eight[start[more] + at] & LOW[np.minimum(size[more] - at, 8)]
        hashes[more] = mixed((hashes[more] ^ part) + np.uint64(at))
        at += 8
        more = more[size[more] > at]
    for k in np.flatnonzero(size > LONG).tolist():
        hashes[k] = int.from_bytes(hashlib.blake2b(data[start[k]:end[k]], digest_size=8).digest(), "little")
    return hashes


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Whole rows of ``batch`` in slices of about SLICE_BYTES of text; nulls become ''."""
    where = batch.schema.get_field_index(column)
    texts = pc.fill_null(batch.column(where).cast(pa.large_string()), "")
    batch = batch.set_column(where, column, texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else None
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1
        to = max(to, at + 1)
        yield batch.slice(at, to - at)
        at = to


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a large_string array without nulls."""
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def split_words(texts: pa.Array, lower: bool, line_breaks: bool = False) -> Words:
    """All words of a large_string array. ``lower`` folds A-Z; with ``line_breaks`` the rows
    are the lines of the texts, counted through the whole slice."""
    data, ends = raw_bytes(texts)
    n = len(data)
    if not n:
        return Words(*(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64))
    full = FULL[data]
    first = full.copy()
    first[1:] &= ~full[:-1]
    heads = ends[:-1][ends[:-1] < n]
    first[heads] = full[heads]
    last = full.copy()
    last[:-1] &= ~full[1:]
    tails = ends[1:][ends[1:] > 0] - 1
    last[tails] = full[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = word_hashes(LOWER[data] if lower else data, start, end)
    bounds = line_starts(data, ends) if line_breaks else ends[:-1]
    held = np.diff(np.append(np.searchsorted(start, bounds), len(start)))
    return Words(np.repeat(np.arange(len(bounds)), held), start, end, hashes)


def line_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First byte of each line; every text has at least one line."""
    breaks = np.flatnonzero(data == 10) + 1
    return np.sort(np.concatenate([ends[:-1], breaks]), kind="stable")


def segments(row: np.ndarray, rows: int) -> np.ndarray:
    """Offsets of each row in the sorted array ``row``."""
    return np.searchsorted(row, np.arange(rows + 1))


def sorted_sets(row: np.ndarray, key: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of each row in ascending order: (row, key, offsets)."""
    key = key.copy()
    at = segments(row, rows)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a > 1:
            key[a:b].sort()
    keep = np.ones(len(key), bool)
    keep[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    row, key = row[keep], key[keep]
    return row, key, segments(row, rows)


def summed(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring offsets; 0 for empty rows."""
    sums = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def lists(flat: np.ndarray, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat))
