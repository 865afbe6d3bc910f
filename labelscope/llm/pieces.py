"""Encoding to the pieces of a SentencePiece model, and decoding.

Each word of a text gets a lattice: its substrings that the piece table holds are edges, looked up as
soon as the two symbols they go over are there. The model in use is a BPE model, whose own rule is not the
path of the best score sum but the merge of the best edge over two neighbouring symbols, again
and again, so that is how edges are folded here (see the README for the figures). Characters
that no piece covers become byte pieces.

A word is a run of spaces with what follows up to the next space or line feed; no piece goes over such
a border, so words are independent. A text gets one space in front, as the model asks for. Words
of any length are folded whole with a heap, which takes n log n steps for n code points. A U+2581 that a text itself holds is
encoded as bytes, so that decoding gives back every text.

Words repeat: a task keeps the ids of the short words it has seen, at most KEPT of them. Nothing is
shuffled. A null text counts as empty and has no ids. Rows come back as often as they came in;
``encode`` passes the columns named in ``keep`` through. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelscope.llm import tokens

SPACE = "▁"
#: Code points of a word up to which its ids are kept.
SHORT = 64
KEPT = 400_000
PREFIX = -1.0
WORD = re.compile(" +[^ \n]*|[^ \n]+|\n")


class PieceTable(NamedTuple):
    """``ids`` by piece, with spaces for the model's space sign; ``rank``: place of a piece, 1 and up, best
    first, and PREFIX for text that only begins one; ``bytes_of``: the bytes a piece stands for, by id;
    ``longest``: code points of the longest piece."""

    ids: dict[str, int]
    rank: dict[str, float]
    byte_ids: list[int]
    bytes_of: list[bytes]
    longest: int


def load(model_file: str) -> PieceTable:
    """Piece table of a SentencePiece file; read on the driver, it has a row per piece of the vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids, rank, byte_ids, bytes_of = {}, {}, [0] * 256, []
    for k in range(model.vocab_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            byte_ids[int(piece[3:5], 16)] = k
            bytes_of.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(k) or model.is_unknown(k):
            bytes_of.append(b"")
        else:
            text = piece.replace(SPACE, " ")
            ids[text], rank[text] = k, 1 - model.get_score(k)
            bytes_of.append(text.encode())
    for text in ids:
        for end in range(2, len(text)):
            rank.setdefault(text[:end], PREFIX)
    return PieceTable(ids, rank, byte_ids, bytes_of, max(map(len, ids), default=1))


def fold(word: str, table: PieceTable) -> list[int]:
    """Ids of a word: the best edge over two neighbouring symbols is merged until there is none."""
    n = len(word)
    ends = list(range(1, n + 1)) + [0]  # end of the symbol that starts here; 0 inside a symbol
    merge(word, table, ends)
    ids, at = [], 0
    while at < n:
        symbol = word[at:ends[at]]
        k = table.ids.get(symbol)
        if k is None:
            ids.extend(table.byte_ids[b] for b in symbol.encode())
        else:
            ids.append(k)
        at = ends[at]
    return ids


def merge(word: str, table: PieceTable, ends: list[int]) -> None:
    """Merges the symbols in ``ends``, best edge first. An edge is looked up when both its symbols are there; a heap holds them."""
    n, rank = len(word), table.rank.get
    heads = list(range(-1, n))  # start of the symbol that ends here, for ends of symbols
    # a piece is at most ``longest`` long, so longer substrings have no rank
    found = [(place, start, start + 2) for start in range(n - 1) if (place := rank(word[start:start + 2], PREFIX)) > 0]
    heapq.heapify(found)
    pop, push = heapq.heappop, heapq.heappush
    while found:
        _, start, end = pop(found)
        middle = ends[start]
        if middle and middle < end and ends[middle] == end:
            ends[start], ends[middle], heads[end] = end, 0, start
            if start and (place := rank(word[heads[start]:end], PREFIX)) > 0:
                push(found, (place, heads[start], end))
            if end < n and (place := rank(word[start:ends[end]], PREFIX)) > 0:
                push(found, (place, start, ends[end]))


def encode_text(text: str, table: PieceTable, known: dict[str, bytes]) -> bytes:
    """Ids of a text as 32-bit numbers in a row."""
    found = []
    for word in WORD.findall(" " + text if text else ""):
        if len(word) > SHORT:
            found.append(np.array(fold(word, table), np.int32).tobytes())
            continue
        ids = known.get(word)
        if ids is None:
            if len(known) >= KEPT:
                known.clear()
            ids = known[word] = np.array(fold(word, table), np.int32).tobytes()
        found.append(ids)
    return b"".join(found)


def encode(docs: DataFrame, table: PieceTable, keep: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """``keep`` columns and ids (array<int>) of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # as large as the vocabulary
    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = T.StructType([*rows.drop("_text").schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bytes] = {}
        for batch in batches:
            kept = batch.schema.names[:-1]
            for part in tokens.text_slices(batch, "_text"):
                each = [encode_text(text, shared.value, known) for text in part.column("_text").to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in each], dtype=np.int64)])
                flat = np.frombuffer(b"".join(each), np.int32)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in range(len(kept))), tokens.lists(flat, ends)], [*kept, "ids"])

    return rows.mapInArrow(task, schema)


def decode(encoded: DataFrame, table: PieceTable) -> DataFrame:
    """``encoded`` with ``decoded``: the text its ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(table)  # as large as the vocabulary
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    where = encoded.columns.index("ids")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_of = shared.value.bytes_of
        for batch in batches:
            ids = pc.fill_null(batch.column(where), [])
            flat, ends = pc.list_flatten(ids).to_numpy(), np.cumsum(pc.list_value_length(ids).to_numpy())
            each = np.split(flat, ends[:-1]) if len(ends) else []
            texts = [b"".join([part_of[k] for k in part.tolist()])[1:].decode() for part in each]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(task, schema)
