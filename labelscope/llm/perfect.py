"""Minimal perfect hashing of 64-bit keys, built bucket by bucket.

A bucket hashes its keys into about GAMMA places a key; a key alone at its place is settled there,
the others go on to the next level with another hash, until none is left. The settled places of all
buckets and levels, numbered in order, are the indexes 0 to n - 1. A lookup tries a key's place on
each level. The keys themselves lie in index order, so that a foreign key is told apart.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from labelscope.llm import tokens

GAMMA = 1.5
SEED = tokens.mixed(np.arange(256, dtype=np.uint64) + np.uint64(1 << 30))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (tokens.mixed(keys.view(np.uint64) ^ SEED[255]) % np.uint64(buckets)).astype(np.int64)


def places(keys: np.ndarray, level: int, size) -> np.ndarray:
    return (tokens.mixed(keys.view(np.uint64) + SEED[level % 255] + np.uint64(level)) % np.asarray(size).astype(np.uint64)).astype(np.int64)


def settle(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one bucket of distinct keys: sizes of the levels, whether a key is settled at each place, keys in index order."""
    sizes, used, ordered, level = [], [], [], 0
    while len(keys):
        size = max(8, int(GAMMA * len(keys)))
        place = places(keys, level, size)
        alone = np.bincount(place, minlength=size) == 1
        mine = alone[place]
        sizes.append(size)
        used.append(alone)
        ordered.append(keys[mine][np.argsort(place[mine])])
        keys, level = keys[~mine], level + 1
    if not sizes:
        return np.zeros(0, np.int64), np.zeros(0, bool), keys
    return np.array(sizes, np.int64), np.concatenate(used), np.concatenate(ordered)


class PerfectHash(NamedTuple):
    """``first``: first place of each (level, bucket), ``size``: places there (0: no such level), ``index``: index of
    the key settled at a place, -1 for none; ``keys``: in index order."""

    buckets: int
    first: np.ndarray
    size: np.ndarray
    index: np.ndarray
    keys: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 for keys outside."""
        found = np.full(len(keys), -1, np.int64)
        if not len(self.keys) or not len(keys):
            return found
        bucket, open_keys = bucket_of(keys, self.buckets), np.arange(len(keys))
        for level in range(len(self.size)):
            size = self.size[level][bucket]
            if not size.all():
                has = size > 0
                open_keys, bucket, keys, size = open_keys[has], bucket[has], keys[has], size[has]
            at = self.index[self.first[level][bucket] + places(keys, level, size)]
            hit = at >= 0
            found[open_keys[hit]] = at[hit]
            left = ~hit
            open_keys, bucket, keys = open_keys[left], bucket[left], keys[left]
            if not len(keys):
                break
        return found

    def verified(self, keys: np.ndarray) -> np.ndarray:
        """As ``find``, with the stored keys compared."""
        found = self.find(keys)
        if len(self.keys):
            found[self.keys[found] != keys] = -1
        return found


def joined(buckets: int, parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> PerfectHash:
    """The hash over buckets settled one by one: (bucket, sizes, used, keys)."""
    levels = max((len(sizes) for _, sizes, _, _ in parts), default=0)
    first, size = np.zeros((levels, buckets), np.int64), np.zeros((levels, buckets), np.int64)
    at, used, keys = 0, [np.zeros(0, bool)], [np.zeros(0, np.int64)]
    for bucket, sizes, places_used, own in parts:
        ends = at + np.cumsum(sizes)
        first[:len(sizes), bucket], size[:len(sizes), bucket] = ends - sizes, sizes
        at += len(places_used)
        used.append(places_used)
        keys.append(own)
    settled = np.concatenate(used)
    index = np.where(settled, np.cumsum(settled) - 1, -1).astype(np.int32)
    return PerfectHash(buckets, first, size, index, np.concatenate(keys))
