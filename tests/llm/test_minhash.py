import random
import re

import numpy as np
import pytest

from labelscope.llm import minhash, tokens
from labelscope.llm.queries import QUERIES

BLANK = re.compile("[\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [w for w in BLANK.split((text or "").translate(UPPER)) if w]
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent):
    sets = [shingles(text) for _, text in rows]
    group = {i: i for i, _ in rows if i is not None}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            same = rows[a][0] == rows[b][0] or both and 100 * both >= percent * len(sets[a] | sets[b])
            if same and rows[a][0] is not None and rows[b][0] is not None:
                x, y = sorted((top(rows[a][0]), top(rows[b][0])))
                group[y] = x
    return sorted((i, len(s), top(i) if i is not None else None, i is None or top(i) == i) for (i, _), s in zip(rows, sets))


def changed(text, share, seed):
    r = random.Random(seed)
    return " ".join("zz%d" % r.randrange(10**6) if r.random() < share else w for w in text.split())


@pytest.mark.parametrize("percent", [80, 85])
def test_against_brute_force(frame, prose, percent, monkeypatch):
    monkeypatch.setattr("labelscope.llm.graph.BLOCK", 16)
    texts = [prose(k, 3 + 17 * k % 90) for k in range(40)]
    texts += [changed(texts[k % 12], (k % 7) / 300, k) for k in range(60)]
    long = prose(999, 1500)
    texts += [changed(long, 0.012 + 0.006 * (k % 4), 50 + k) for k in range(50)]
    texts += [None, "", " \t\n", "one two", "One TWO", "É two", "é two", texts[0].upper(), texts[3].replace(" ", "\n\t ")]
    order = random.Random(5).sample(range(len(texts)), len(texts))
    rows = [(7 * k + 3, texts[i]) for k, i in enumerate(order)]
    found = minhash.near_duplicates(frame(rows, "doc_id long, text string"), percent)
    assert sorted(map(tuple, found.collect())) == brute(rows, percent)


def test_empty_nulls_and_clashing_names(frame, prose):
    ddl = "doc_id long, text string, bands string, component long, u int, key int"
    assert minhash.near_duplicates(frame([], ddl)).collect() == []
    a, b = prose(1, 30), prose(2, 30)
    rows = [(5, a, "x", 1, 1, 1), (3, a, None, 2, 2, 2), (3, a, None, 2, 2, 2), (None, a, "y", 0, 0, 0), (3, b, "z", 0, 0, 0), (9, b, "", 0, 0, 0)]
    found = sorted(minhash.near_duplicates(frame(rows, ddl)).collect(), key=repr)
    assert [(r.doc_id, r.component_id, r.kept) for r in found if r.doc_id] == [(3, 3, True)] * 3 + [(5, 3, False), (9, 3, False)]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)]


def test_signature_estimates_similarity():
    r = np.random.default_rng(3)
    for similarity in (0.3, 0.6, 0.9):
        estimates = []
        for _ in range(60):
            n = 200
            shared = r.integers(1, 2**63, int(2 * n * similarity / (1 + similarity))).astype(np.uint64)
            sets = [np.concatenate([shared, r.integers(1, 2**63, n - len(shared)).astype(np.uint64)]) for _ in range(2)]
            table = minhash.superminhash(np.repeat([0, 1], n), np.concatenate(sets), 2, 124)
            assert np.isfinite(table).all()
            # every element meets each register once: the values of a one-element set are a permutation plus ranks
            estimates.append((table[0] == table[1]).mean())
        assert abs(np.mean(estimates) - similarity) < 0.02
    single = minhash.superminhash(np.array([0]), np.array([12345], np.uint64), 1, 124)[0]
    assert sorted(np.floor(single)) == list(range(124))


def test_word_splitting():
    import pyarrow as pa

    texts = ["a  b\tc", "", "é x\x0b y", " \n", "z"]
    words = tokens.split_words(pa.array(texts, pa.large_string()), lower=False)
    cut = [w for t in texts for w in BLANK.split(t) if w]
    assert len(words.hash) == len(cut) == len(set(words.hash.tolist()))
    assert words.row.tolist() == [0, 0, 0, 2, 2, 4]


def test_registered_query_against_brute_force(spark):
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op5_minhash"](spark, "/root/testdata/sf0.001").collect())) == brute(rows, 85)
