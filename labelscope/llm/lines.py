"""Line dedup by an exact set-similarity join.

A line's set has its distinct words. Two lines are linked when the Jaccard similarity of their
sets reaches the threshold (80 percent); a line goes when a linked line, or one with an equal
set, comes before it. Lines come in order of doc_id (null last), then a hash of the text, then
line number. Every line that has a word is compared; ``min_words`` leaves out lines with fewer distinct words.

Method: words are ordered by rarity (counts of 65,536 hash classes over the whole corpus; the
order is total, so the class count affects speed only). Lines with equal sets collapse: only the first one of
a class is indexed, told by two bit maps of fixed size (a fuller one lets more lines through, never fewer). A line's
prefix, the rarest words that any partner must share one of, is indexed: 1 - 2t/(1+t) of the
words as the shorter side, 1 - t as the longer one. Rows that meet on a word pass the length
filter, the positional filter and a 128-bit parity sketch (its Hamming distance never exceeds
the sets' difference, so none of the filters loses a link). What passes is joined into
candidate components, and every pair inside one is verified on full sets, block by block.
Words in over one percent of the corpus are dealt over an 8 x 8 grid of cells.

Rows repeated with the same id and text are one document and keep the same lines. Null and empty
texts have no lines to remove. Extra columns pass through ``dedup_lines``. Empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelscope.functions.bind import bind
from labelscope.llm import graph, tokens
from labelscope.runtime import stored

PERCENT, MIN_WORDS = 80, 1
CLASSES = 1 << 16
GRID = 8
#: Share of the corpus's words from which a word is dealt over the grid.
HOT = 0.01
LAST = 2**63 - 1
#: Postings of a fragment, about; slices of texts whose postings go out together; lines of a block.
FRAGMENT, SLICES, BLOCK = 1 << 20, 64, 4096
#: Size of the filter that picks the lines of candidate components; a fuller one lets more through.
FILTER_BITS = 1 << 26


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.coalesce("text", F.lit("")).alias("text")
    )


def rarity(counted: DataFrame) -> tuple["Order", int]:
    """Order of the hash classes from the rarest to the most frequent, and the first hot rank."""
    found = counted.groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CLASSES, np.int64)  # CLASSES numbers at most
    counts[found["class"].to_numpy()] = found["n"].to_numpy()
    order = np.argsort(counts, kind="stable").astype(np.uint64)
    rank = np.empty(CLASSES, np.uint64)
    rank[order.astype(np.int64)] = np.arange(CLASSES, dtype=np.uint64)
    return Order(rank, order), int(np.searchsorted(counts[order.astype(np.int64)], max(1, HOT * counts.sum())))


class Order(NamedTuple):
    """Rank of each hash class, and the class of each rank."""

    rank: np.ndarray
    classes: np.ndarray

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Word keys in this order; one to one with the hashes."""
        return (self.rank[(hashes & np.uint64(CLASSES - 1)).astype(np.int64)] << np.uint64(48)) | (hashes >> np.uint64(16))

    def by_class(self, keys: np.ndarray) -> np.ndarray:
        """The same words' keys in the order of the class numbers, which needs no counts."""
        return (self.classes[(keys >> np.uint64(48)).astype(np.int64)] << np.uint64(48)) | (keys & np.uint64((1 << 48) - 1))


#: The order before anything is counted.
BY_CLASS = Order(np.arange(CLASSES, dtype=np.uint64), np.arange(CLASSES, dtype=np.uint64))


def line_words(texts: pa.Array, order: Order):
    """Distinct words of each line, rarest first: (line, key, offsets, text of line, number in text), and all words' hashes."""
    data, ends = tokens.raw_bytes(texts)
    heads = tokens.line_starts(data, ends)
    words = tokens.split_words(texts, lower=False, line_breaks=True)
    line, key, at = tokens.sorted_sets(words.row, order.keys(words.hash), len(heads))
    owner = np.repeat(np.arange(len(texts)), 1 + np.diff(np.searchsorted(np.flatnonzero(data == 10), ends)))
    number = np.arange(len(heads)) - np.searchsorted(owner, owner)
    return line, key, at, owner, number, words.hash


def needed(a, b, percent: int):
    """Smallest overlap of sets of a and b words that are linked."""
    return -(-percent * (a + b) // (100 + percent))


def parity(line: np.ndarray, key: np.ndarray, lines: int) -> np.ndarray:
    """128-bit parity sketch of each line as two signed columns."""
    bit = (tokens.mixed(key) & np.uint64(127)).astype(np.int64)
    odd = np.bincount(line * 128 + bit, minlength=lines * 128).astype(np.uint8) & 1
    return np.packbits(odd.reshape(lines, 128), axis=1).view(np.int64).reshape(lines, 2)


class Compared(NamedTuple):
    """Lines of a slice of texts: word keys with offsets; of the ``chosen`` ones text, number and 128 bits of the set."""

    line: np.ndarray
    key: np.ndarray
    at: np.ndarray
    chosen: np.ndarray
    owner: np.ndarray
    number: np.ndarray
    node: np.ndarray
    check: np.ndarray
    hashes: np.ndarray


def compared(part: pa.RecordBatch, order: Order, min_words: int) -> Compared:
    """Chooses the lines with ``min_words`` distinct words. The bits of a set are the same in every order."""
    line, key, at, owner, number, hashes = line_words(part.column("text"), order)
    chosen = np.flatnonzero(np.diff(at) >= min_words)
    plain = order.by_class(key)
    set_a, set_b = tokens.summed(tokens.mixed(plain), at), tokens.summed(tokens.mixed(~plain), at)
    return Compared(
        line, key, at, chosen, owner[chosen], number[chosen], set_a[chosen].view(np.int64), set_b[chosen].view(np.int64), hashes
    )


def scanned(docs: DataFrame, min_words: int) -> DataFrame:
    """One pass over the texts: a row per compared line, and rows that count the words of a hash class.

    Line rows have doc_id, text_key, line, leads (first compared line of its text), node, check,
    where (node, check) are the bits of the line's set; count rows have class and n, null in the others.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for part in tokens.text_slices(batch):
                found = compared(part, BY_CLASS, min_words)
                total += np.bincount((found.hashes & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES)
                owner, none = pa.array(found.owner), pa.nulls(len(found.owner), pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(owner), "text_key": part.column("text_key").take(owner),
                    "line": pa.array(found.number.astype(np.int32)), "leads": pa.array(np.diff(found.owner, prepend=-1) != 0),
                    "node": pa.array(found.node), "check": pa.array(found.check), "class": none, "n": none,
                })
        seen = np.flatnonzero(total)
        none = pa.nulls(len(seen), pa.int64())
        yield pa.RecordBatch.from_pydict({
            "doc_id": none, "text_key": none, "line": none.cast(pa.int32()), "leads": none.cast(pa.bool_()), "node": none, "check": none,
            "class": pa.array(seen), "n": pa.array(total[seen]),
        })

    return docs.mapInArrow(task, "doc_id long, text_key long, line int, leads boolean, node long, check long, class long, n long")


FIELDS = ("cell", "place", "node", "sketch_a", "sketch_b")
INDEXED, PROBING = 1, 2


def first_lines(lines: Compared, part: pa.RecordBatch, seconds) -> np.ndarray:
    """Places among the compared lines of those that may be the first of their class; ``seconds``: the filter of the
    classes with several lines, and that of the first line of each."""
    repeated, first = seconds
    text_key = part.column("text_key").to_numpy()[lines.owner]
    mine = np.flatnonzero(~is_set(repeated, lines.node) | is_set(first, lines.node ^ text_key ^ lines.number))
    _, once = np.unique(lines.node[mine], return_index=True)
    return mine[once]


def slice_postings(part: pa.RecordBatch, order: Order, hot_rank: int, percent: int, min_words: int, seconds) -> list[np.ndarray]:
    """FIELDS of the prefix words of the lines that may be the first of their class."""
    lines = compared(part, order, min_words)
    line, key, at = lines.line, lines.key, lines.at
    first = first_lines(lines, part, seconds)
    n = np.diff(at)
    # a smaller set can only be linked with an equal one, which needs no prefix
    able = 100 * n[lines.chosen[first]] >= percent * (n[lines.chosen[first]] + 1)
    node, chosen = lines.node[first][able], lines.chosen[first][able]
    sketch = parity(line, key, len(n))[chosen]
    n = n[chosen]
    size = n - (-(-percent * n // 100)) + 1
    ends = np.concatenate([[0], np.cumsum(size)])
    own = np.repeat(np.arange(len(chosen)), size)
    place = np.arange(ends[-1]) - ends[own]
    cell = key[at[chosen][own] + place]
    role = np.where(place <= n[own] - needed(n, n, percent)[own], INDEXED | PROBING, PROBING)
    hot = (cell >> np.uint64(48)) >= np.uint64(hot_rank)
    if hot.any():
        own, place, cell, role = on_grid(own, place, cell, role, hot, node)
    return [cell.view(np.int64), n[own] << 32 | place << 2 | role, node[own], sketch[own, 0], sketch[own, 1]]


def postings(docs: DataFrame, order, hot_rank: int, percent: int, min_words: int, seconds, fragments: int) -> DataFrame:
    """A posting per word of each line's prefix: the cell it is compared in, (words, place, role), set and sketch.

    Postings are dealt by cell into fragments; those of some slices of texts for one fragment are one row of lists.
    """

    def packed(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*held)]
        fragment = (tokens.mixed(columns[0].view(np.uint64)) % np.uint64(fragments)).astype(np.int64)
        by = np.argsort(fragment.astype(np.uint16) if fragments <= 1 << 16 else fragment, kind="stable")
        used, at = np.unique(fragment[by], return_index=True)
        at = np.append(at, len(by))
        return pa.RecordBatch.from_pydict({"fragment": pa.array(used)} | {x: tokens.lists(values[by], at) for x, values in zip(FIELDS, columns)})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for part in tokens.text_slices(batch):
                held.append(slice_postings(part, order.value, hot_rank, percent, min_words, seconds.value))
                if len(held) == SLICES:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    return docs.select("text_key", "text").mapInArrow(task, "fragment long, " + ", ".join(f"{name} array<long>" for name in FIELDS))


def on_grid(own, place, cell, role, hot, node):
    """Hot words dealt over GRID x GRID cells: an index row to a row of them, a probe row to a column."""
    cold = ~hot
    parts = [(own[cold], place[cold], cell[cold], role[cold])]
    for kind in (INDEXED, PROBING):
        rows = np.repeat(np.flatnonzero(hot & (role & kind > 0)), GRID)
        mine, other = node[own[rows]] & (GRID - 1), np.arange(len(rows)) % GRID
        square = (mine * GRID + other if kind == INDEXED else other * GRID + mine).astype(np.uint64)
        parts.append((own[rows], place[rows], tokens.mixed(cell[rows] + tokens.mixed(square)), np.full(len(rows), kind)))
    return (np.concatenate(x) for x in zip(*parts))


def close_rows(group: pa.Table, percent: int) -> pa.Table:
    """Edges (u, v) between postings of one cell that pass all filters, for the cells of one fragment.

    In order of cell and length, every probing posting is compared with the indexed ones before it, the last one first, for as
    long as these are in its cell and long enough; all move on together. What edges have joined gives no further edge.
    """
    rows = {name: pc.list_flatten(group[name].combine_chunks()).to_numpy(zero_copy_only=False) for name in FIELDS}
    by = np.lexsort([rows[name] for name in ("node", "place", "cell")])
    rows = {name: values[by] for name, values in rows.items()}
    again = np.zeros(len(by), bool)  # equal sets of different slices stand side by side
    again[1:] = np.logical_and.reduce([rows[x][1:] == rows[x][:-1] for x in ("cell", "node", "place")])
    rows = {name: values[~again] for name, values in rows.items()}
    cell, packed, node = rows["cell"], rows["place"], rows["node"]
    n = packed >> 32
    after, role, size = n - ((packed >> 2) & ((1 << 30) - 1)), packed & 3, len(node)
    change = np.ones(size, bool)
    change[1:] = cell[1:] != cell[:-1]
    indexed = np.flatnonzero(role & INDEXED)
    n_indexed, after_indexed = n[indexed], after[indexed]
    number = np.searchsorted(indexed, np.arange(size))  # indexed postings before each one
    first = number[np.maximum.accumulate(np.where(change, np.arange(size), 0))]
    top, found = np.arange(size), [(node[:0], node[:0])]
    late = np.flatnonzero((role & PROBING > 0) & (number > first))
    early, first, n_late, after_late = number[late] - 1, first[late], n[late], after[late]
    while len(late):
        n_early = n_indexed[early]
        ok = np.minimum(after_indexed[early], after_late) * (100 + percent) >= percent * (n_early + n_late)
        a, b = indexed[early[ok]], late[ok]
        apart_from = top[a] != top[b]
        a, b = a[apart_from], b[apart_from]
        if len(a):
            apart = sum(np.bitwise_count((rows[x][a] ^ rows[x][b]).view(np.uint64)).astype(np.int64) for x in ("sketch_a", "sketch_b"))
            close = apart <= n[a] + n[b] - 2 * needed(n[a], n[b], percent)
            a, b = a[close], b[close]
        if len(a):
            found.append((node[a], node[b]))
            np.minimum.at(top, np.maximum(top[a], top[b]), np.minimum(top[a], top[b]))
            while (top[top] != top).any():
                top = top[top]
        early = early - 1
        more = np.flatnonzero((early >= first) & (100 * n_indexed[early] >= percent * n_late))
        late, early, first, n_late, after_late = (x[more] for x in (late, early, first, n_late, after_late))
    u, v = (np.concatenate(x) for x in zip(*found))
    return pa.table({"u": pa.array(u), "v": pa.array(v)})


def first_places(repeated: DataFrame) -> DataFrame:
    """node: the number that marks the first line of each class (set, hash of the text and line, put together)."""
    digits = F.hex("own")
    text_key = F.conv(F.substring(digits, 17, 16), 16, -10).cast("long").bitwiseXOR(F.lit(-(2**63)))
    line = F.conv(F.substring(digits, 33, 8), 16, 10).cast("long")
    return repeated.select(F.col("node").bitwiseXOR(text_key).bitwiseXOR(line).alias("node"))


def filter_bits(nodes: DataFrame) -> np.ndarray:
    """One bit per hash class of ``nodes``, set if any is there: FILTER_BITS / 8 bytes."""
    place = F.pmod(F.col("node"), F.lit(FILTER_BITS)) + 1
    maps = nodes.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    found = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in maps.toLocalIterator():
        part = np.frombuffer(row["bits"], np.uint8)
        found[(row["b"] - 1) * len(part):row["b"] * len(part)] = part
    return found


def is_set(bits: np.ndarray, node: np.ndarray) -> np.ndarray:
    bit = node & (FILTER_BITS - 1)
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def asked_sets(docs: DataFrame, order, min_words: int, bits, seconds) -> DataFrame:
    """node, items, doc, text_key, line of the lines whose bit is set and that may be the first of their class, once per
    slice of texts with their first place in it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.text_slices(batch):
                lines = compared(part, order.value, min_words)
                key, at = lines.key, lines.at
                doc = pc.fill_null(part.column("doc_id"), LAST).to_numpy()[lines.owner]
                text_key = part.column("text_key").to_numpy()[lines.owner]
                repeated, first = seconds.value
                wanted = is_set(bits.value, lines.node)
                wanted &= ~is_set(repeated, lines.node) | is_set(first, lines.node ^ part.column("text_key").to_numpy()[lines.owner] ^ lines.number)
                wanted = np.flatnonzero(wanted)
                wanted = wanted[np.lexsort((lines.number[wanted], text_key[wanted], doc[wanted], lines.node[wanted]))]
                node, first = np.unique(lines.node[wanted], return_index=True)
                asked = wanted[first]
                rows = lines.chosen[asked]
                size = np.diff(at)[rows]
                ends = np.concatenate([[0], np.cumsum(size)])
                flat = np.arange(ends[-1]) - np.repeat(ends[:-1] - at[rows], size)
                yield pa.RecordBatch.from_pydict({
                    "node": pa.array(node), "items": tokens.lists(key[flat].view(np.int64), ends),
                    "doc": pa.array(doc[asked]), "text_key": pa.array(text_key[asked]), "line": pa.array(lines.number[asked].astype(np.int32)),
                })

    return docs.select("doc_id", "text_key", "text").mapInArrow(task, "node long, items array<long>, doc long, text_key long, line int")


def rank(doc: str):
    """Place of a line in the whole corpus (document, hash of the text, line) as 20 bytes in the same order."""
    # the flipped sign bit puts negative numbers first
    digits = lambda number: F.lpad(F.hex(number.bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    place = F.concat(digits(F.coalesce(doc, F.lit(LAST))), digits(F.col("text_key")), F.lpad(F.hex("line"), 8, "0"))
    return F.unhex(place)


def shared_lines(lines: DataFrame, bits) -> DataFrame:
    """The rows of ``lines`` whose bit is set."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(is_set(bits.value, batch.column("node").to_numpy())))

    return lines.select("doc_id", "text_key", "line", "node", "check").mapInArrow(task, "doc_id long, text_key long, line int, node long, check long")


def compared_and_shared(docs: DataFrame, percent: int, min_words: int) -> tuple[DataFrame, DataFrame]:
    """(lines, shared): every compared line (doc_id, text_key, line, leads, node, check), and what holds
    for those with a link or an equal line: doc_id, text_key, line, links, removed.

    A line that no other equals or is linked with needs no join: a bit per hash class of the
    others' sets keeps it out.
    """
    texts = keyed(docs)
    both = stored(scanned(texts, min_words), "lines")
    order, hot_rank = rarity(both.where("class is not null"))
    share = docs.sparkSession.sparkContext.broadcast  # filters have FILTER_BITS / 8 bytes each
    order = share(order)  # twice CLASSES numbers
    found = both.where("class is null").drop("class", "n")
    repeated = found.groupBy("node", "check").agg(F.min(rank("doc_id")).alias("own"), F.count("*").alias("n"))
    repeated = stored(repeated.where("n > 1").drop("n"), "line-classes")
    seconds = share((filter_bits(repeated), filter_bits(first_places(repeated))))
    # a line has about five prefix words; the number of fragments follows the lines
    fragments = max(1, -(-5 * both.count() // FRAGMENT))
    dealt = postings(texts, order, hot_rank, percent, min_words, seconds, fragments).groupBy("fragment")
    groups = stored(graph.components(dealt.applyInArrow(lambda group: close_rows(group, percent), "u long, v long")), "line-groups")
    linkable = filter_bits(groups)
    members = groups.withColumn("all", F.lit(True))
    members = members.join(graph.block_numbers(members, "all", "all", BLOCK), "component")
    asked = asked_sets(texts, order, min_words, share(linkable), seconds).select("node", "items", rank("doc").alias("rank"))
    sets = stored(  # both sides of the cells read it
        asked.join(members, "node").groupBy("node", "component", "all", "_lefts", "_rights").agg(
            F.min_by("items", "rank").alias("items"), F.min("rank").alias("rank")
        ),
        "line-sets",
    )
    links = graph.in_cells(sets, "all", "all", percent, graph.link_counts, "node long, links long, first binary")
    links = links.groupBy("node").agg(F.sum("links").alias("links"), F.min("first").alias("first")).where("links > 0")
    rows = shared_lines(found, share(linkable | seconds.value[0])).withColumn("rank", rank("doc_id"))
    # classes first, so that lines move once; a class without an equal line has no check here
    classes = repeated.join(links, "node", "full_outer").withColumnsRenamed({"node": "_node", "check": "_check"})
    same = (F.col("node") == F.col("_node")) & (F.col("_check").isNull() | (F.col("check") == F.col("_check")))
    judged = rows.join(classes, same).select(
        "doc_id", "text_key", "line", F.coalesce("links", F.lit(0)).alias("links"),
        ((F.col("rank") > F.col("own")) | (F.col("first") < F.coalesce("own", "rank"))).alias("removed"),
    )
    return found, judged.withColumn("removed", F.coalesce("removed", F.lit(False))).where("links > 0 or removed")


def line_verdicts(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per compared line: doc_id, text_key, line, node (its class), links, removed.

    ``links`` counts the other sets that the line's set is linked with.
    """
    found, shared = compared_and_shared(docs, percent, min_words)
    both = found.select("doc_id", "text_key", "line", "node", F.lit(0).alias("links"), F.lit(False).alias("removed")).unionByName(
        shared.withColumn("node", F.lit(None).cast("long"))
    )
    return both.groupBy("doc_id", "text_key", "line").agg(
        F.max("node").alias("node"), F.max("links").alias("links"), F.max("removed").alias("removed")
    )


def removed_lines(shared: DataFrame) -> DataFrame:
    """doc_id, text_key, n_links, removed (numbers of the lines that go, ascending); repeats of a document count once."""
    once = shared.repartition("doc_id", "text_key").dropDuplicates(["doc_id", "text_key", "line"])  # one exchange for both
    return once.groupBy("doc_id", "text_key").agg(
        F.sum("links").alias("n_links"), F.sort_array(F.collect_list(F.when(F.col("removed"), F.col("line")))).alias("removed")
    )


def by_document(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_key, n_lines, n_links, removed (numbers of the lines that go, ascending) of documents with compared lines."""
    found, shared = compared_and_shared(docs, percent, min_words)
    counted = found.groupBy("doc_id", "text_key").agg((F.count("*") / F.count_if("leads")).cast("long").alias("n_lines"))
    marked = removed_lines(shared).toDF("_id", "_key", "n_links", "removed")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return counted.join(marked, same, "left").select(
        "doc_id", "text_key", "n_lines", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def dedup_lines(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the removed lines; a document that has lost all its words goes."""
    _, shared = compared_and_shared(docs, percent, min_words)
    gone = removed_lines(shared.where("removed")).drop("n_links").toDF("_id", "_key", "_removed")
    rows = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_key")), "left")
    numbers = F.array_except(F.sequence(F.lit(0), F.size(F.split("text", "\n")) - 1), F.col("_removed"))
    lines = F.split("text", "\n")
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(
        bind(lines, lambda each: F.array_join(F.transform(numbers, lambda k: F.get(each, k)), "\n"))
    )
    lost = F.col("_removed").isNotNull() & ~text.rlike("[^\\x20\\x09-\\x0D]")
    return rows.where(~F.coalesce(lost, F.lit(False))).select(*(text.alias("text") if c == "text" else F.col(c) for c in docs.columns))
