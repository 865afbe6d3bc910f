import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from labelscope.llm import queries, runs, tokens

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words):
    """(start, length, period) of all runs, from the definition."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p) and j > i:
                found.setdefault((i, j + p - i), p)
            i = max(j, i) + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def rewritten(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n or doc_id is None:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = rewritten(doc_id, WORD.findall(text or ""))
    found = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {k for s, length, p in found for k in range(s + p, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(found), best[0], best[1], best[2], best[1] and 1000 * best[1] // best[2],
        sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
    )


def made(r):
    """Words with periodic stretches in them."""
    words = []
    for _ in range(r.randint(0, 5)):
        words += [r.choice("abcdefgh") for _ in range(r.randint(0, 12))]
        root = [r.choice("abc") for _ in range(r.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33]))]
        length = int(len(root) * r.uniform(1, 9))
        words += [root[k % len(root)] for k in range(length)]
    return words


@pytest.mark.parametrize("tile", [1, 64, 1 << 17])
def test_fragments_against_the_definition(tile):
    r = random.Random(tile)
    for _ in range(60):
        texts = [made(r) for _ in range(r.randint(1, 6))]
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        flat = np.array([hash((k, w)) & 0x7FFFFFFFFFFFFFFF for k, t in enumerate(texts) for w in t], np.int64).astype(np.uint64)
        pieces = sorted(zip(*(x.tolist() for x in runs.fragments(flat, at, tile))), key=lambda x: (x[0], x[1], x[2]))
        joined = []
        for p, s, e in pieces:
            if joined and joined[-1][0] == p and s <= joined[-1][2] - p:
                joined[-1][2] = max(joined[-1][2], e)
            else:
                joined.append([p, s, e])
        found = sorted((s, e, p) for p, s, e in joined)
        wanted = sorted((int(at[k]) + s, int(at[k]) + s + length, p) for k, t in enumerate(texts) for s, length, p in brute_runs(t))
        assert found == wanted


@pytest.mark.parametrize("tile", [1, 1 << 17])
def test_query_against_the_definition(frame, tile, monkeypatch):
    real = runs.fragments
    monkeypatch.setattr(runs, "fragments", lambda codes, at: real(codes, at, tile))
    r = random.Random(3)
    rows = [(k, r.choice([" ", "\n", " \t"]).join(made(r))) for k in range(150)]
    rows += [(k, " ".join("w%d" % x for x in range(r.randint(1, 90)))) for k in range(200, 320)]  # a tenth of them gets a periodic end
    rows += [(None, "a a a a a a a"), (None, None), (7, ""), (8, " \n "), (5, rows[5][1]), (5, rows[5][1]), (9, "é É " * 9 + "\x0b\x0c" + "\xa0x " * 7)]
    found = runs.digest_columns(runs.runs_by_text(frame(rows, "doc_id long, text string"), runs.planted))
    key = lambda x: repr(tuple(x))
    assert sorted(map(tuple, found.collect()), key=key) == sorted((expected(*x) for x in rows), key=key)


def test_long_texts_take_no_quadratic_time(frame):
    one, two = "x " * 300_000, " ".join("w%d" % (k % 7_919) for k in range(300_000))
    found = runs.runs_by_text(frame([(1, one), (2, two), (3, "y" * 3_000_000)], "doc_id long, text string")).collect()
    assert {x.doc_id: [tuple(y) for y in x.runs] for x in found} == {1: [(0, 1, 300_000)], 2: [(0, 7_919, 300_000)], 3: []}


def test_empty_table_and_clashing_names(frame):
    ddl = "row string, doc_id int, period string, text string, body int, runs int"
    assert runs.runs_by_text(frame([], ddl)).collect() == []
    found = runs.digest_columns(runs.runs_by_text(frame([("r", 1, "p", "b b b b b b c", 0, 0)], ddl))).collect()
    assert [(x.n_runs, x.start, x.length, x.period, x.exponent_milli) for x in found] == [(1, 0, 6, 1, 6000)]


def test_registered_query_against_the_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 6000").select("doc_id", "text").collect()
    found = {x.doc_id: tuple(x) for x in queries.QUERIES["op12_runs"](spark, "/root/testdata/sf0.001").collect()}
    assert len(docs) > 100 and [found[x.doc_id] for x in docs] == [expected(*x) for x in docs]


def test_word_hashes_of_texts_differ():
    assert len(set((tokens.mixed(np.arange(9, dtype=np.uint64) * runs.FACTOR[0])).tolist())) == 9
