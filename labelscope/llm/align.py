"""Alignment of two tokenizations, and counts of the id pairs that meet.

Every text is encoded twice, by a byte-level BPE (A, with a space in front) and by a piece model with
byte fallback (B, which adds that space itself); strings of special tokens are plain text. The tokens of
both tile the same bytes, so each stretch between neighbouring ends of either side lies in one A and
one B token: these stretches are the links. Ends that both sides share cut the tokens into groups.

1. One pass encodes the texts; the ids are stored, two bytes each for vocabularies up to 65,536.
2. The distinct pairs are dealt by hash into buckets of about BUCKET, and each bucket gets a minimal
   perfect hash (``perfect``). At most SLICE pairs are held at once: beyond that, the buckets form several slices,
   each counted and looked up for itself.
3. Tasks align the stored ids again and add up their links in a dense vector indexed by the hash, keys
   verified; the vectors meet in pieces, first by groups of tasks, then all (a tree of two levels).
4. A last pass aligns once more and looks each link up: its pair's count, and whether it is the highest of its B id.

What is broadcast or comes to the driver is bounded by SLICE pairs and the vocabularies, not by the
corpus. A text that is null or empty, or whose A or B tokens do not give back its bytes, has no
tokens: zeros and an empty digest. Repeated rows count and come back as often as they came in.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelscope.llm import perfect, tokens
from labelscope.runtime import stored

#: Keys of a bucket, about; keys of a slice, about; counts of a piece of a vector; tasks whose vectors are added first.
BUCKET, SLICE, PIECE, BRANCH = 1 << 16, 1 << 21, 1 << 15, 16
#: Tokens that are aligned at once, and distinct pairs that a task holds before it hands them on.
TOKENS, HELD = 1 << 20, 1 << 22
#: Fixed value: how the byte-level BPE cuts a text before it merges.
CUT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Models(NamedTuple):
    """Contents of both model files."""

    byte_bpe: str
    pieces: bytes


def load(byte_file: str, piece_file: str) -> Models:
    with open(byte_file, encoding="utf-8") as a, open(piece_file, "rb") as b:
        return Models(a.read(), b.read())


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 signs for themselves, the
    other bytes for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Tokenizers(NamedTuple):
    """``encode_a``, ``encode_b``: text to ids; ``bytes_a``, ``bytes_b``: bytes of each id; ``kind``: type of stored ids."""

    encode_a: Callable
    encode_b: Callable
    bytes_a: pa.Array
    bytes_b: pa.Array
    kind: np.dtype


@lru_cache(maxsize=2)
def tokenizers_of(models: Models) -> Tokenizers:
    import sentencepiece
    import tiktoken

    found = json.loads(models.byte_bpe)
    special = {t["content"] for t in found["added_tokens"]}
    sign = byte_of_sign()
    vocabulary = {word: k for word, k in found["model"]["vocab"].items() if word not in special}
    merged = [vocabulary["".join(pair) if isinstance(pair, list) else pair.replace(" ", "")] for pair in found["model"]["merges"]]
    if merged != sorted(merged):
        raise ValueError("the vocabulary is not in the order of its merges")
    ranks = {bytes(sign[c] for c in word): k for word, k in vocabulary.items()}
    a = tiktoken.Encoding("byte-bpe", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_proto=models.pieces)
    bytes_a = [b""] * (max(ranks.values()) + 1)
    for word, k in ranks.items():
        bytes_a[k] = word
    name = [b.id_to_piece(k) for k in range(len(b))]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(name)]
    kind = np.dtype("<u2") if max(len(bytes_a), len(bytes_b)) <= 1 << 16 else np.dtype("<u4")
    encode_a = lambda text: a.encode_to_numpy(text, disallowed_special=())
    return Tokenizers(encode_a, b.encode, pa.array(bytes_a, pa.large_binary()), pa.array(bytes_b, pa.large_binary()), kind)


def joined_bytes(pieces: pa.Array, ids: np.ndarray, at: np.ndarray) -> tuple[bytes, list[int]]:
    """Bytes of all tokens, and where each text's begin and end; ``at``: offsets of the texts in ``ids``."""
    taken = pc.take(pieces, pa.array(ids.astype(np.int64)))
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8)
    data = taken.buffers()[2]
    return data.to_pybytes() if data is not None else b"", ends[at].tolist()


def flat(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int64)
    return (np.concatenate(arrays) if arrays else np.zeros(0, np.int64)).astype(np.int64), at


def encoded(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, a, b: ids of both sides as bytes, empty for texts without tokens."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers_of(models)
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            for part in tokens.text_slices(batch):
                texts = part.column("text").to_pylist()
                a, a_at = flat([both.encode_a(" " + x) if x else nothing for x in texts])
                b, b_at = flat([np.array(both.encode_b(x), np.int64) if x else nothing for x in texts])
                a_bytes, a_ends = joined_bytes(both.bytes_a, a, a_at)
                b_bytes, b_ends = joined_bytes(both.bytes_b, b, b_at)
                a, b, columns = a.astype(both.kind), b.astype(both.kind), ([], [])
                for k, text in enumerate(texts):
                    whole = (" " + text).encode() if text else None
                    same = a_bytes[a_ends[k]:a_ends[k + 1]] == whole and b_bytes[b_ends[k]:b_ends[k + 1]] == whole
                    for column, ids, at in zip(columns, (a, b), (a_at, b_at)):
                        column.append(ids[at[k]:at[k + 1]].tobytes() if same else b"")
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "a": pa.array(columns[0], pa.binary()), "b": pa.array(columns[1], pa.binary())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, a binary, b binary")


class Aligned(NamedTuple):
    """Of some texts, one after the other: ``a``, ``b``: ids with offsets ``a_at``, ``b_at`` of the texts; ``links``: pair
    keys with offsets ``at``; ``a_ends``, ``b_ends``: whether a token ends a group."""

    a: np.ndarray
    a_at: np.ndarray
    b: np.ndarray
    b_at: np.ndarray
    links: np.ndarray
    at: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray


def align(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> Aligned:
    stop_a, stop_b = np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b])
    stops = np.concatenate([stop_a, stop_b])
    order = np.argsort(stops, kind="stable")  # two sorted runs are merged; of equal ends A comes first
    stops, is_a = stops[order], order < len(a)
    last = np.ones(len(stops), bool)
    last[:-1] = stops[1:] != stops[:-1]
    shared = np.zeros(len(stops), bool)
    shared[1:] = ~last[:-1]
    n_a = np.cumsum(is_a)
    has_a, has_b = (is_a | shared)[last], (~is_a)[last]
    in_a = n_a[last] - has_a
    in_b = (np.arange(1, len(stops) + 1) - n_a)[last] - has_b
    common = shared[last]
    ends = stops[last]
    bound = np.concatenate([[0], stop_a])[a_at]
    a_ends, b_ends = np.zeros(len(a), bool), np.zeros(len(b), bool)
    a_ends[in_a[common]] = True
    b_ends[in_b[common]] = True
    return Aligned(a, a_at, b, b_at, a[in_a] * len(sizes_b) + b[in_b], np.searchsorted(ends, bound, side="right"), a_ends, b_ends)


def aligned_parts(batches: Iterator[pa.RecordBatch], models: Models) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Rows of ``encoded`` with their alignment, about TOKENS tokens at a time, whole texts."""
    both = tokenizers_of(models)
    sizes = [pc.binary_length(x).to_numpy() for x in (both.bytes_a, both.bytes_b)]
    for batch in batches:
        width = both.kind.itemsize
        held = [pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) // width for c in ("a", "b")]
        total = np.concatenate([[0], np.cumsum(held[0] + held[1])])
        k = 0
        while k < batch.num_rows:
            to = max(k + 1, int(np.searchsorted(total, total[k] + TOKENS, side="right")) - 1)
            part = batch.slice(k, to - k)
            ids = [np.frombuffer(b"".join(part.column(c).to_pylist()), both.kind).astype(np.int64) for c in ("a", "b")]
            at = [np.concatenate([[0], np.cumsum(x[k:to])]) for x in held]
            yield part, align(ids[0], at[0], ids[1], at[1], *sizes)
            k = to


def distinct_pairs(rows: DataFrame, models: Models) -> DataFrame:
    """key: the id pairs that are linked anywhere."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for _, part in aligned_parts(batches, models):
            held = np.union1d(held, part.links)
            if len(held) > HELD:
                yield pa.RecordBatch.from_pydict({"key": pa.array(held)})
                held = held[:0]
        yield pa.RecordBatch.from_pydict({"key": pa.array(held)})

    return rows.select("a", "b").mapInArrow(task, "key long").distinct()


def settled_buckets(keys: DataFrame, buckets: int) -> DataFrame:
    """bucket, sizes, used, keys: the perfect hash of each bucket."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(perfect.bucket_of(batch.column("key").to_numpy(), buckets)), "key": batch.column("key")})

    def task(group: pa.Table) -> pa.Table:
        sizes, used, own = perfect.settle(np.sort(group["key"].to_numpy()))
        return pa.table({
            "bucket": group["bucket"].slice(0, 1).cast(pa.int64()), "sizes": pa.array([sizes.tobytes()], pa.binary()),
            "used": pa.array([np.packbits(used).tobytes()], pa.binary()), "keys": pa.array([own.tobytes()], pa.binary()),
        })

    dealt = keys.mapInArrow(numbered, "bucket long, key long")
    return dealt.groupBy("bucket").applyInArrow(task, "bucket long, sizes binary, used binary, keys binary")


def hash_of(settled: DataFrame, buckets: int, low: int, high: int) -> perfect.PerfectHash:
    """The perfect hash over buckets low to high - 1."""
    parts = []
    for row in settled.where((F.col("bucket") >= low) & (F.col("bucket") < high)).orderBy("bucket").toArrow().to_pylist():
        sizes = np.frombuffer(row["sizes"], np.int64)
        used = np.unpackbits(np.frombuffer(row["used"], np.uint8), count=int(sizes.sum())).astype(bool)
        parts.append((row["bucket"], sizes, used, np.frombuffer(row["keys"], np.int64)))
    return perfect.joined(buckets, parts)


def added(vectors: DataFrame, *by: str) -> DataFrame:
    """``counts`` of the rows with equal ``by`` added up, one vector held at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        out = lambda: pa.RecordBatch.from_pylist([dict(zip(by, held)) | {"counts": total.tobytes()}], schema)
        for batch in batches:
            for row in batch.to_pylist():
                at, counts = tuple(row[c] for c in by), np.frombuffer(row["counts"], np.int64)
                if at != held:
                    if held is not None:
                        yield out()
                    held, total = at, counts.copy()
                else:
                    total += counts
        if held is not None:
            yield out()

    schema = pa.schema([(c, pa.int64()) for c in by] + [("counts", pa.binary())])
    dealt = vectors.select(*by, "counts").repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(task, ", ".join(f"{c} long" for c in by) + ", counts binary")


def pair_counts(rows: DataFrame, models: Models, hashed) -> np.ndarray:
    """Links of each pair of the broadcast hash, in its order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own: perfect.PerfectHash = hashed.value
        total = np.zeros(len(own.keys) + 1, np.int64)  # the last place takes pairs of other slices
        for _, part in aligned_parts(batches, models):
            keys, n = np.unique(part.links, return_counts=True)  # a pair is hashed once per part
            place = own.verified(keys)
            total[place[place >= 0]] += n[place >= 0]
            total[-1] += n[place < 0].sum()
        branch = TaskContext.get().partitionId() // BRANCH
        for piece, at in enumerate(range(0, len(total) - 1, PIECE)):
            counts = total[at:min(at + PIECE, len(total) - 1)]
            if counts.any():
                yield pa.RecordBatch.from_pydict({"piece": [piece], "branch": [branch], "counts": [counts.tobytes()]})

    vectors = rows.select("a", "b").mapInArrow(task, "piece long, branch long, counts binary")
    summed = added(added(vectors, "piece", "branch"), "piece").toArrow()
    counts = np.zeros(len(hashed.value.keys), np.int64)
    for row in summed.to_pylist():
        part = np.frombuffer(row["counts"], np.int64)
        counts[row["piece"] * PIECE:][:len(part)] = part
    return counts


def decimal_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(digits, number of digits) of 0 to n - 1."""
    names = np.arange(n).astype(f"S{len(str(max(n - 1, 1)))}")
    return names.view(np.uint8).reshape(n, -1), np.char.str_len(names).astype(np.int64)


def group_digests(part: Aligned, table: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """SHA-256 of each text's groups, written a1,a2|b1;a3|b2,b3; '' for texts without tokens."""
    n_a, n_b = len(part.a), len(part.b)
    group_a = np.cumsum(part.a_ends) - part.a_ends
    group_b = np.cumsum(part.b_ends) - part.b_ends
    groups = int(part.a_ends.sum())
    first_a, first_b = np.searchsorted(group_a, np.arange(groups + 1)), np.searchsorted(group_b, np.arange(groups + 1))
    place_a, place_b = np.arange(n_a) + first_b[group_a], np.arange(n_b) + first_a[group_b + 1]
    ids, sign = np.empty(n_a + n_b, np.int64), np.empty(n_a + n_b, np.uint8)
    ids[place_a], ids[place_b] = part.a, part.b
    sign[place_a], sign[place_b] = np.where(part.a_ends, ord("|"), ord(",")), np.where(part.b_ends, ord(";"), ord(","))
    bounds = part.a_at + part.b_at
    sign[bounds[1:][np.diff(bounds) > 0] - 1] = 0
    digits, length = table
    size = length[ids]
    start = np.concatenate([[0], np.cumsum(size + (sign > 0))])
    out = np.empty(start[-1], np.uint8)
    for k in range(digits.shape[1]):
        has = size > k
        out[start[:-1][has] + k] = digits[ids[has], k]
    has = sign > 0
    out[(start[:-1] + size)[has]] = sign[has]
    ends = start[bounds].tolist()
    return [hashlib.sha256(out[x:y]).hexdigest() if x < y else "" for x, y in zip(ends[:-1], ends[1:])]


def looked_up(rows: DataFrame, models: Models, tables) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and n_best, count_sum over the links whose pairs are in
    the broadcast ``tables`` (hash, counts, whether a count is the highest of its B id)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, best = tables.value
        counts, best = np.append(counts, 0), np.append(best, False)
        both = tokenizers_of(models)
        table = decimal_table(max(len(both.bytes_a), len(both.bytes_b)))
        for batch, part in aligned_parts(batches, models):
            keys, again = np.unique(part.links, return_inverse=True)
            place = own.verified(keys)[again]
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_a": pa.array(np.diff(part.a_at)), "n_b": pa.array(np.diff(part.b_at)),
                "n_groups": pa.array(tokens.summed(part.a_ends.astype(np.int64), part.a_at)), "n_links": pa.array(np.diff(part.at)),
                "n_best": pa.array(tokens.summed(best[place].astype(np.int64), part.at)), "count_sum": pa.array(tokens.summed(counts[place], part.at)),
                "groups_sha256": pa.array(group_digests(part, table), pa.string()),
            })

    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.select("row", "doc_id", "a", "b").mapInArrow(task, schema)


def alignments(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``."""
    context = docs.sparkSession.sparkContext
    rows = stored(encoded(docs, models).withColumn("row", F.monotonically_increasing_id()), "encoded")
    keys = stored(distinct_pairs(rows, models), "pairs")
    total = keys.count()
    buckets = max(1, -(-total // BUCKET))
    settled = stored(settled_buckets(keys, buckets), "pair-hash")
    each = max(1, SLICE // BUCKET)
    spans = [(low, min(low + each, buckets)) for low in range(0, buckets, each)]
    n_b = len(tokenizers_of(models).bytes_b)
    highest = np.zeros(n_b, np.int64)
    counted = []
    for low, high in spans:
        hashed = context.broadcast(hash_of(settled, buckets, low, high))
        counts = pair_counts(rows, models, hashed)
        np.maximum.at(highest, hashed.value.keys % n_b, counts)
        counted.append(counts)
        hashed.destroy()
    found = []
    for (low, high), counts in zip(spans, counted):
        hashed = hash_of(settled, buckets, low, high)
        tables = context.broadcast((hashed, counts, counts == highest[hashed.keys % n_b]))
        found.append(stored(looked_up(rows, models, tables), "alignments"))
        tables.destroy()
    first = found[0]
    for other in found[1:]:
        first = first.unionByName(other)
    if len(found) > 1:
        same = [F.first(c).alias(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        sums = [F.sum(c).alias(c) for c in ("n_best", "count_sum")]
        first = first.groupBy("row").agg(*same, *sums, F.first("groups_sha256").alias("groups_sha256"))
    return first.drop("row")
