import hashlib
import re
from collections import defaultdict

import pytest
from labelscope.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")
DDL = "doc_id long, text string, source string, size int, slot string"


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, target, rest = set(names), {}, sum(sizes.values())
    while left:  # the excess is handed on until none is above
        level = rest / sum(weight[s] for s in left)
        full = {s for s in left if level * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in left}
        for s in full:
            target[s] = most * sizes[s]
            rest -= target[s]
        left -= full
    return target


def test_against_brute_force(frame, prose):
    rows = []
    for k in range(300):
        source = ["src%d" % (k % 5), "Z", None, "ä", "tiny", "void"][0 if k % 3 == 0 else k % 6]
        rows.append((k, prose(k, 1 + 13 * k % 80) if source != "void" else [None, "", " \n"][k % 3], source, 0, ""))
    rows += [(7, rows[7][1], rows[7][2], 0, ""), (None, "a b c", "Z", 0, "")] + [(1000, "x " * 5000, "src0", 0, "")]
    found = [r.asDict() for r in mixing.assign(frame(rows, DDL)).collect()]
    again = [r.asDict() for r in mixing.assign(frame(rows[::-1], DDL)).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    sizes, by_source = defaultdict(int), defaultdict(list)
    for i, text, source, _, _ in rows:
        n = len(WORD.findall(text or ""))
        sizes[source] += n
        digest = hashlib.md5((text or "").encode()).hexdigest()
        key = "%s:%s" % (i if i is not None else "", digest)
        by_source[source].append((int(hashlib.md5(key.encode()).hexdigest()[:8], 16), i if i is not None else -1, n))
    wanted, goal = [], targets(sizes)
    for source, items in by_source.items():
        due, seen = round(goal[source]), 0
        for _, i, n in sorted(items):
            full = due // sizes[source] if sizes[source] else 0
            extra = max(0, min(n, due - full * sizes[source] - seen))
            wanted.append((i if i >= 0 else None, n, sizes[source], round(float(goal[source]), 6), full * n + extra))
            seen += n
    assert sorted(map(repr, ((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in found))) == sorted(map(repr, wanted))
    for source in sizes:
        assert sum(r["taken"] for r in found if r["source"] == source) == round(goal[source])
    assert all(r["taken"] <= 3 * r["size"] for r in found)


def test_positions_follow_the_schedules(frame, prose):
    rows = [(k, prose(k, 20), f"s{k % 3}", 0, "") for k in range(600)]
    placed = mixing.placements(mixing.assign(frame(rows, DDL))).collect()
    assert [r.position for r in placed] == sorted(r.position for r in placed)
    assert all(0 <= r.position <= 1 for r in placed)
    assert sum(r.words for r in placed) == 12000
    early = {s: sum(r.words for r in placed if r.source == s and r.position < 0.5) / sum(r.words for r in placed if r.source == s) for s in ("s0", "s1", "s2")}
    # halves of the integrals of the three schedules
    assert early["s0"] == pytest.approx(0.625, abs=0.02)
    assert early["s1"] == pytest.approx(0.5, abs=0.02)
    assert early["s2"] == pytest.approx(0.375, abs=0.02)


@pytest.mark.parametrize("per_cell", [1 << 12, 5])
def test_a_third_without_ids(frame, prose, per_cell, monkeypatch):
    monkeypatch.setattr(mixing, "PER_CELL", per_cell)
    rows = [(None if k % 3 == 0 else 5 if k % 3 == 1 else k, prose(k, 4), "s%d" % (k % 2), 0, "") for k in range(300)]
    ordered = mixing.in_training_order(mixing.assign(frame(rows, DDL), keep=("text",))).collect()
    again = mixing.in_training_order(mixing.assign(frame(rows[::-1], DDL), keep=("text",))).collect()
    key = lambda r: repr((r.text, r.taken, r.readings, r.position))
    assert sorted(map(key, ordered)) == sorted(map(key, again))  # reruns agree on which text is cut
    assert [r.position for r in ordered] == sorted((r.position for r in ordered), key=lambda x: (x is None, x))
    assert len({r.before for r in ordered if r.source == "s0"}) == 150  # every row has words of its own
    cells = mixing.sized(frame(rows, DDL)).select("_order").distinct().count()
    assert cells == 300


def test_empty(frame):
    assert mixing.assign(frame([], DDL)).collect() == []
    assert [r.taken for r in mixing.assign(frame([(1, None, None, 0, "")], DDL)).collect()] == [0]
