import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from labelscope.llm import backoff
from labelscope.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "doc_id long, text string, word int, row string"


def toks(text):
    return [*WORD.findall((text or "").translate(UPPER)), "\n"]


def out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def brute(rows, mu=1000.0):
    """The model written out as probabilities, without automaton, sums or exchange."""
    train = [toks(t) for i, t, *_ in rows if not out(i)]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    p1 = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    two = Counter((a, b) for t in train for a, b in zip(["", *t], t))
    before = c | {"": len(train)}
    p = lambda a, w: (two[a, w] + mu * p1(w)) / (before.get(a, 0) + mu)
    found = []
    for i, t, *_ in rows:
        words = toks(t)
        found.append((i, out(i), len(words), sum(c[w] > 0 for w in words), n, sum(math.log10(p1(w)) for w in words),
                      sum(math.log10(p(a, w)) for a, w in zip(["", *words], words))))
    for a in [*sorted(c)[:20], "", "zz"]:  # the model is a distribution over known tokens and one unknown
        if a != "\n":
            assert sum(p(a, w) for w in c) + p(a, "unseen") == pytest.approx(1)
    return found


def rows_of(prose):
    rows = [(k, f"The {prose(k % 30, 3 + k % 40)} of the {prose(k, 20)} of THE end", 0, "") for k in range(200)]
    return rows + [(900, None, 0, ""), (901, "", 0, ""), (902, "É x É", 0, ""), (5, rows[5][1], 0, ""), (None, "the of the", 0, ""), (903, "the " * 4000, 0, "")]


@pytest.mark.parametrize(("chunk", "fragment", "hot", "width"), [
    (1 << 20, 1 << 21, 1 << 12, 1 << 16), (300, 200, 50, 1 << 16), (1, 50, 5, 7), (5000, 900, 1 << 30, 11)])
def test_against_brute_force(frame, prose, chunk, fragment, hot, width, monkeypatch):
    for name, value in (("CHUNK", chunk), ("FRAGMENT", fragment), ("HOT", hot), ("ROWS", width)):
        monkeypatch.setattr(backoff, name, value)
    rows = rows_of(prose)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    found, wanted = sorted(map(tuple, backoff.score(frame(rows, DDL)).collect()), key=key), sorted(brute(rows), key=key)
    assert [f[:5] for f in found] == [w[:5] for w in wanted]
    for f, w in zip(found, wanted):
        assert f[5:] == pytest.approx(w[5:], rel=1e-9)


def test_registered_query_against_brute_force(spark):
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    found = {x.doc_id: tuple(x) for x in QUERIES["op7_backoff"](spark, "/root/testdata/sf0.001").collect()}
    for w in brute(rows):
        assert found[w[0]][:5] == w[:5] and found[w[0]][5:] == pytest.approx(w[5:], rel=1e-9)


def test_words_travel_whole():
    hashes = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    assert (backoff.unpacked(backoff.packed(hashes)) == hashes & backoff.BITS).all()


def test_held_out_texts_gain_from_context(frame, prose):
    rows = [(k, " ".join(f"go {prose(j % 6, 1)} then {prose(j % 9 + 50, 2)} stop" for j in range(k, k + 60)), 0, "") for k in range(300)]
    held = backoff.score(frame(rows, DDL)).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > 0.8 * held["sum(base_score)"]


def test_empty(frame):
    assert backoff.score(frame([], DDL)).collect() == []
    only = next(k for k in range(50) if out(k))
    found = backoff.score(frame([(only, "a b", 0, "")], DDL)).first()
    assert (found.n_tokens, found.n_known, found.train_tokens) == (3, 0, 0)
    assert found.base_score == found.score == 0.0
