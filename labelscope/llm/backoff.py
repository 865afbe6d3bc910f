"""Language-model scoring with a weighted backoff automaton.

Tokens are the words of a text with A-Z lower-cased, then one end mark. The model is learned
from all training texts: p1(w) = (c + 0.5) / (N + 0.5 (V + 1)) over single tokens, and for a
previous token v, p(w | v) = (c(v, w) + MU p1(w)) / (c(v) + MU); both sum to one. Every pair is kept.

As an automaton: a state is the previous token (or the start of a text). An arc (v, w) that training has seen leads
to state w; all others take the failure arc of v, of weight MU / (c(v) + MU), to the root, and the root's arc
to w, of weight p1(w). A text is traversed once from left to right. With log p(w | v) = log p1(w) + the failure
weight of v + log(1 + c(v, w) / (MU p1(w))) the steps of a traversal add up in any order, so they are taken where
their arcs are:

1. One count of single tokens gives N, V, and the words that make up 1 / HOT of all tokens or more.
2. Tasks walk the texts, some CHUNK tokens at a time, and hand out each chunk's distinct arcs with their training counts.
   Arcs are dealt by their word, so that one fragment has all arcs into a word and with them its count; those into a
   hot word are dealt by pair and get its count from the table of hot words (HOT entries at most). Each fragment adds
   up the counts and answers every chunk with the counts of its words and arcs, in the order they came.
3. Which texts take which arc stays with the chunk, in the same order. Where the answers meet it, arcs are weighed and
   every text adds up the steps of its traversal. A frequent word or pair is an entry per chunk anywhere, and
   what moves grows with the tokens.

Words are known by 64-bit hashes, of which 48 bits travel besides the fragment.

A null text is empty: it has the end mark alone. A null doc_id counts as the empty text for the
split, so it trains. Repeated rows are counted and scored as often as they occur. Without
training texts N and V are 0 and every token is unknown. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelscope.llm import tokens
from labelscope.runtime import stored

MU = 1000.0
#: Tokens that are walked at once; tokens whose arcs make up a fragment, about; inverse share of a hot word.
CHUNK, FRAGMENT, HOT = 1 << 20, 1 << 21, 1 << 12
#: Rows of a chunk, numbered in two bytes.
ROWS = 1 << 16
END, START = np.uint64(0xE4D), np.uint64(0x57A)
BITS = np.uint64((1 << 48) - 1)


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


def with_ends(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all tokens, an end mark after each text."""
    words, rows = tokens.split_words(texts, lower=True), np.arange(len(texts))
    row = np.concatenate([words.row, rows])
    order = np.argsort(row, kind="stable")
    return row[order], np.concatenate([words.hash, np.full(len(rows), END)])[order]


def before(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The token before each one; START at the first of a text."""
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    return np.where(first, START, np.concatenate([[START], hashes[:-1]]))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """(slices, row, hash) of about CHUNK tokens and at most ROWS rows at a time."""
    parts, held, size, rows = [], [], 0, 0

    def joined():
        return parts, np.concatenate([r for r, _ in held]), np.concatenate([h for _, h in held])

    for batch in batches:
        for whole in tokens.text_slices(batch):
            for start in range(0, whole.num_rows, ROWS):
                part = whole.slice(start, ROWS)
                if rows and (size >= CHUNK or rows + part.num_rows > ROWS):
                    yield joined()
                    parts, held, size, rows = [], [], 0, 0
                row, hashes = with_ends(part.column("text"))
                parts.append(part)
                held.append((row + rows, hashes))
                size, rows = size + len(row), rows + part.num_rows
    if rows:
        yield joined()


def token_counts(texts: DataFrame) -> DataFrame:
    """word (hash), c: count of each token in ``texts``."""

    def task(batches):
        for _, _, hashes in chunks(batches):
            found, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_pydict({"word": pa.array(found.view(np.int64)), "n": pa.array(n)})

    return texts.select("text").mapInArrow(task, "word long, n long").groupBy("word").agg(F.sum("n").alias("c"))


def packed(hashes: np.ndarray) -> bytes:
    """The low 48 bits of each hash, six bytes each."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    whole = np.zeros((len(data) // 6, 8), np.uint8)
    whole[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return whole.view("<u8").ravel().astype(np.uint64)


def heads(*columns: np.ndarray) -> np.ndarray:
    """Whether any of the columns differs from the row before."""
    found = np.ones(len(columns[0]), bool)
    found[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return found


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


STEPS = ("fragment long, chunk long, words binary, pairs binary, prevs binary, counts binary, takers binary, rows binary, times binary, "
         "ends binary, doc_ids array<long>, held array<boolean>, lengths array<long>")


def dealt_steps(docs: DataFrame, fragments: int, hot) -> DataFrame:
    """STEPS of all texts: a row per chunk and fragment with its arcs, and one per chunk (with a negative fragment) with its texts.

    ``words``: distinct words, 6 bytes each; ``pairs``: arcs into each; ``prevs``, ``counts``: the arcs' previous word and
    training count. With the texts, over the arcs of all fragments in order: ``takers``, rows that take an arc; ``rows``,
    ``times``: which ones and how often; ``ends``: places of the end mark among the words.
    """
    schema = arrow_schema(STEPS)

    def cut(fragment, chunk, word, prev, count) -> Iterator[dict]:
        used, first = np.unique(fragment, return_index=True)
        for f, a, b in zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(fragment)]):
            head = np.flatnonzero(heads(word[a:b]))
            yield {
                "fragment": f, "chunk": chunk, "words": packed(word[a:b][head]), "pairs": np.diff(np.append(head, b - a)).astype("<u4").tobytes(),
                "prevs": packed(prev[a:b]), "counts": count[a:b].astype("<u4").tobytes(),
            }

    def steps(chunk: int, parts: list[pa.RecordBatch], row: np.ndarray, word: np.ndarray) -> pa.RecordBatch:
        held = np.concatenate([p.column("held_out").to_numpy(zero_copy_only=False) for p in parts]).astype(bool)
        prev = before(row, word)
        word, prev, lengths = word & BITS, prev & BITS, np.bincount(row, minlength=len(held))
        fragment = tokens.mixed(word)
        frequent = np.isin(word, hot.value[0])
        fragment[frequent] = tokens.mixed(fragment[frequent] + tokens.mixed(prev[frequent]))
        fragment = (fragment % np.uint64(fragments)).astype(np.int64)
        order = np.lexsort((row, prev, word, fragment))
        fragment, word, prev, row = fragment[order], word[order], prev[order], row[order]
        # steps of one row along one arc, then arcs
        head = np.flatnonzero(heads(fragment, word, prev, row))
        times = np.diff(np.append(head, len(row)))
        fragment, word, prev, row = fragment[head], word[head], prev[head], row[head]
        arc = np.flatnonzero(heads(fragment, word, prev))
        bounds = np.append(arc, len(row))
        count = np.diff(np.concatenate([[0], np.cumsum(times * ~held[row])])[bounds])
        fragment, word, prev = fragment[arc], word[arc], prev[arc]
        own = {
            "fragment": -1 - chunk, "chunk": chunk, "takers": np.diff(bounds).astype("<u4").tobytes(),
            "rows": row.astype("<u2").tobytes(), "times": times.astype("<u4").tobytes(),
            "ends": np.flatnonzero(word[heads(fragment, word)] == END).astype("<u4").tobytes(),
            "doc_ids": sum((p.column("doc_id").to_pylist() for p in parts), []), "held": held.tolist(), "lengths": lengths.tolist(),
        }
        return pa.RecordBatch.from_pylist([own, *cut(fragment, chunk, word, prev, count)], schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for k, (parts, row, hashes) in enumerate(chunks(batches)):
            yield steps(at + k, parts, row, hashes)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out")).mapInArrow(task, STEPS)


ANSWERS = ("fragment long, chunk long, counts binary, pairs binary, together binary, takers binary, rows binary, times binary, ends binary, "
           "doc_ids array<long>, held array<boolean>, lengths array<long>")


def answered(group: pa.Table, hot: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    """ANSWERS of one fragment to each chunk: the counts of its words (``counts``), the arcs into each (``pairs``), and the
    counts of its arcs (``together``); the texts of a chunk pass."""
    schema = arrow_schema(ANSWERS)
    if group["fragment"][0].as_py() < 0:
        return pa.table({f.name: group[f.name] if f.name in group.column_names and f.name not in ("counts", "pairs") else pa.nulls(group.num_rows, f.type) for f in schema})
    joined = lambda name: b"".join(group[name].to_pylist())
    words, prev = unpacked(joined("words")), unpacked(joined("prevs"))
    count, pairs = np.frombuffer(joined("counts"), "<u4"), np.frombuffer(joined("pairs"), "<u4").astype(np.int64)
    found, place = np.unique(words, return_inverse=True)
    word = np.repeat(place, pairs)
    total = np.bincount(word, weights=count, minlength=len(found))
    names, known = hot
    if len(names):
        at = np.minimum(np.searchsorted(names, found), len(names) - 1)
        total = np.where(names[at] == found, known[at], total)
    total = total.astype("<u8")[place]
    _, arc = np.unique(tokens.mixed(prev ^ tokens.mixed(word.astype(np.uint64))), return_inverse=True)
    together = np.bincount(arc, weights=count).astype("<u8")[arc]
    n_words = np.cumsum([0, *(len(x) // 6 for x in group["words"].to_pylist())]).tolist()
    n_pairs = np.cumsum([0, *(len(x) // 6 for x in group["prevs"].to_pylist())]).tolist()
    rows = [
        {"fragment": f, "chunk": c, "counts": total[a:b].tobytes(), "pairs": p, "together": together[x:y].tobytes()}
        for f, c, p, a, b, x, y in zip(
            group["fragment"].to_pylist(), group["chunk"].to_pylist(), group["pairs"].to_pylist(), n_words, n_words[1:], n_pairs, n_pairs[1:])
    ]
    return pa.Table.from_pylist(rows, schema)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def traversed(group: pa.Table, total: int, distinct: int, documents: int) -> pa.Table:
    """SCORES of the texts of one chunk: its arcs weighed, and added up along each text."""
    group = group.sort_by("fragment")  # the texts first, then the answers in the order of the arcs
    texts = group.slice(0, 1).to_pylist()[0]
    joined = lambda name, kind: np.frombuffer(b"".join(group[name].slice(1).to_pylist()), kind)
    c, n = joined("counts", "<u8").astype(float), joined("together", "<u8").astype(float)
    word = np.repeat(np.arange(len(c)), joined("pairs", "<u4"))
    mass = total + 0.5 * (distinct + 1)
    root, failure = np.log10((c + 0.5) / mass), np.log10(MU / (c + MU))
    failure[np.frombuffer(texts["ends"], "<u4")] = 0.0  # nothing follows the end
    arc = root[word] + failure[word] + np.log10(1 + n * mass / (MU * (c[word] + 0.5)))
    own = np.repeat(np.arange(len(n)), np.frombuffer(texts["takers"], "<u4"))
    row, times = np.frombuffer(texts["rows"], "<u2"), np.frombuffer(texts["times"], "<u4")
    summed = lambda values: np.bincount(row, weights=times * values[own], minlength=len(texts["lengths"]))
    return pa.table({
        "doc_id": pa.array(texts["doc_ids"], pa.int64()), "held_out": pa.array(texts["held"], pa.bool_()), "n_tokens": pa.array(texts["lengths"], pa.int64()),
        "n_known": pa.array(np.rint(summed((c > 0)[word].astype(float))).astype(np.int64)), "base_score": pa.array(summed(root[word])),
        "score": pa.array(summed(arc) + np.log10(MU / (documents + MU))),
    })


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    counts = stored(token_counts(docs.where(~held_out())), "token-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = counts.where(F.col("word") == int(END)).select("c").first()
    documents = ends[0] if ends else 0
    often = counts.where(F.col("c") * HOT >= total).toArrow()  # HOT rows at most
    names = often["word"].to_numpy().view(np.uint64) & BITS
    order = np.argsort(names)
    hot = docs.sparkSession.sparkContext.broadcast((names[order], often["c"].to_numpy()[order].astype(float)))
    # held-out texts have arcs too: a quarter as many again, about
    fragments = max(1, -(-5 * total // (4 * FRAGMENT)))
    steps = dealt_steps(docs, fragments, hot).groupBy("fragment")
    answers = steps.applyInArrow(lambda group: answered(group, hot.value), ANSWERS)
    found = answers.groupBy("chunk").applyInArrow(lambda group: traversed(group, total, distinct, documents), SCORES)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
