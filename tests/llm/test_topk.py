import math
import random

import pytest
from labelscope.llm import topk

DDL = "vec_id long, embedding array<float>, score int, v string"


def brute(rows, k):
    ok = sorted((i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
                if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v))
    out = []
    for q, w in ok:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("size", [1 << 23, 8 * 6 * 3])
def test_against_brute_force(frame, size, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", size)
    r = random.Random(4)
    half = lambda: r.randrange(-64, 64) / 64
    rows = [(k, [half() for _ in range(6)]) for k in range(400)]
    rows += [(k, [0.5, 0.25, 0.0, 0.0, 0.0, 0.125]) for k in range(500, 700)]  # many ties
    rows += [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 6), (1150, [float("inf")] * 6), (None, [1.0] * 6),
             (1200, []), (1250, [1.0, 1.0]), (3, rows[3][1]), (3, rows[4][1]), (50, rows[50][1]), (100, [0.5] * 6), (650, [0.5, 0.25, 0.0, 0.0, 0.0, 0.125]), (-50, [1.0] * 6), (1300, [0.0] * 6)]
    found = topk.search(frame([(i, v, 0, "") for i, v in rows], DDL), (topk.F.col("vec_id") % 50) == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5)


def test_few_and_none(frame):
    query = (topk.F.col("vec_id") % 50) == 0
    assert topk.search(frame([], DDL), query).collect() == []
    assert topk.search(frame([(50, [1.0], 0, "")], DDL), query).collect() == []
    found = topk.search(frame([(50, [1.0], 0, ""), (51, [-0.001], 0, "")], DDL), query).collect()
    assert [tuple(r) for r in found] == [(50, 1, 51, -256)]


def test_rows_that_share_an_id(frame):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.5]), (5, [0.25, 0.25])]
    found = topk.search(frame([(i, v, 0, "") for i, v in rows], DDL), (topk.F.col("vec_id") % 50) == 0).collect()
    lists = sorted([(r.rank, r.vec_id) for r in found], key=lambda x: x)
    assert len(found) == 10 and lists == sorted([(1, 1), (2, 1), (3, 2), (4, 5), (5, 3), (1, 3), (2, 4), (3, 5), (4, 1), (5, 1)])
