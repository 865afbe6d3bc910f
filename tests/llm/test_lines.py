import random
import re

import numpy as np
import pytest
from labelscope.llm import lines
from labelscope.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")
DDL = "doc_id long, text string, node string, line int"


def brute(rows, percent=80, min_words=1):
    """(doc_id, text) -> (lines compared, links, removed line numbers), by comparing all sets."""
    docs = sorted({(i is None, i or 0, t or "") for i, t, *_ in rows})
    found = [(d, k, frozenset(WORD.findall(line))) for d in docs for k, line in enumerate(d[2].split("\n"))]
    found = [f for f in found if len(f[2]) >= min_words]
    linked = lambda a, b: 100 * len(a & b) >= percent * len(a | b)
    sets = {s for _, _, s in found}
    links = {s: sum(linked(s, o) for o in sets if o != s) for s in sets}
    return docs, found, links, linked


@pytest.mark.parametrize("grid", [False, True])
def test_against_brute_force(frame, prose, grid, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 8)
    monkeypatch.setattr(lines, "FRAGMENT", 300)
    monkeypatch.setattr(lines, "SLICES", 2)
    if grid:
        monkeypatch.setattr(lines, "HOT", 0.0)
    r = random.Random(8)
    pool = [prose(k, r.randint(3, 40)) for k in range(40)] + ["of the in a to and", "of the in a to", "a b c d e f g h i j", ""]

    def noisy(line):
        return " ".join(w for w in line.split() if r.random() > 0.04) + r.choice(["", " extra", "  "])

    rows = [(k, "\n".join(noisy(r.choice(pool)) if r.random() < 0.7 else prose(1000 + 9 * k + j, 12) for j in range(r.randint(1, 9))), "", 0) for k in range(120)]
    rows += [(500, None, "", 0), (501, "", "", 0), (502, "\n \n", "", 0), (None, pool[3] + "\n" + pool[4], "", 0), (7, rows[7][1], "", 0), (7, pool[9], "", 0),
             (503, "w " * 9000, "", 0), (504, " ".join(map(str, range(3000))), "", 0), (505, " ".join(map(str, range(3100))), "", 0)]
    docs, found, links, linked = brute(rows)
    got = {(x.doc_id, x.text_key, x.line): x for x in lines.line_verdicts(frame(rows, DDL)).collect()}
    assert len(got) == len(found)
    key_of = {}
    for x in lines.keyed(frame(rows, DDL)).collect():
        key_of[x.doc_id is None, x.doc_id or 0, x.text] = x.doc_id, x.text_key
    both = 0
    for d, k, words in found:
        x = got[(*key_of[d], k)]
        seen = [o for e, j, o in found if (e[0], e[1], j) < (d[0], d[1], k)]
        gone = any(linked(words, o) for o in seen)
        assert (x.links, x.removed) == (links[words], gone), (d[1], k)
        both += gone and words not in seen
    assert both > 20  # some go for a line that is near but not equal
    if not grid:
        texts = {(x.doc_id, x.text_key): x for x in lines.by_document(frame(rows + rows[:9], DDL)).collect()}
        for doc in {k[:2] for k in got}:
            own = [x for k, x in sorted(got.items(), key=lambda i: i[0][2]) if k[:2] == doc]
            x = texts.pop(doc)  # repeated rows change nothing
            assert (x.n_lines, x.n_links, x.removed) == (len(own), sum(y.links for y in own), [y.line for y in own if y.removed])
        assert not texts


def test_texts_after_removal(frame):
    one, two = "a b c d e f g", "h i j k l m n"
    rows = [(1, f"{one}\n\nx y\n{two}", "s", 1), (2, f"new words of its own\nx z\n{one} \n{two}", "t", 2), (3, one, "u", 3), (4, "x  y", "v", 4), (5, None, "w", 5), (6, "", "z", 6)]
    kept = {r.doc_id: r for r in lines.dedup_lines(frame(rows, DDL)).collect()}
    assert sorted(kept) == [1, 2, 5, 6]
    assert kept[1].text == rows[0][1] and kept[2].text == "new words of its own\nx z" and kept[5].text is None
    long = {r.doc_id: r for r in lines.dedup_lines(frame(rows, DDL), min_words=5).collect()}
    assert sorted(long) == [1, 2, 4, 5, 6] and long[4].text == "x  y"
    assert lines.dedup_lines(frame(rows, DDL)).columns == ["doc_id", "text", "node", "line"]
    assert lines.dedup_lines(frame([], DDL)).collect() == []


def test_short_lines_of_the_query(spark, frame, tmp_path):
    short = ["Read more", "top", "a b c d", "a b c d e", "p q r", "p q", "Read  more "]
    rows = [(k, "\n".join([line, "", f"{k} own{k} words{k} of{k} it{k} {k}x"]), "", 0) for k, line in enumerate(short + short[:2])]
    frame(rows, DDL).write.parquet(f"{tmp_path}/documents.parquet")
    found = {x.doc_id: x for x in QUERIES["op3_lines"](spark, str(tmp_path)).collect()}
    docs, compared, links, linked = brute(rows, min_words=1)
    for d in docs:
        gone = [k for e, k, s in compared if e == d and any(linked(s, o) for f, j, o in compared if (f[1], j) < (e[1], k))]
        own = [s for e, _, s in compared if e == d]
        assert (found[d[1]].removed, found[d[1]].n_links, found[d[1]].n_lines) == (gone, sum(links[s] for s in own), len(own))
    assert found[3].removed == found[6].removed == found[7].removed == [0] and found[4].removed == []


def test_equal_lines_at_one_place(frame):
    head, near = "a b c d e f g h i j", "a b c d e f g h i k"
    rows = [(None, f"{head}\none own line of words here", "", 0), (None, f"{head}\ntwo other words in this line", "", 0), (None, f"{near}\nthe third of the three texts", "", 0),
            (-7, "p q r s t\nfirst text of an id", "", 0), (-7, "p q r s t\nsecond one of that same id", "", 0)]
    texts = {x.text: x.text_key for x in lines.keyed(frame(rows, DDL)).collect()}
    removed = {x.text_key: x.removed for x in lines.by_document(frame(rows, DDL)).collect()}
    for group in (rows[:3], rows[3:]):
        first, *others = sorted(texts[t] for _, t, *_ in group)
        assert removed[first] == [] and all(removed[k] == [0] for k in others)


def test_overlap_bound():
    for a in range(1, 40):
        for b in range(1, 40):
            ok = [o for o in range(min(a, b) + 1) if 100 * o >= 80 * (a + b - o)]
            assert lines.needed(a, b, 80) == (ok[0] if ok else lines.needed(a, b, 80)) and (ok or lines.needed(a, b, 80) > min(a, b))
    keys = np.array([1, 1 << 50, 7], np.uint64)
    assert (lines.parity(np.array([0, 0, 1]), keys, 2) != 0).any()
