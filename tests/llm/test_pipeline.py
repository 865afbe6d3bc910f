"""Each stage of the pipeline against plain Python on what the stage before it kept."""

import re
from collections import defaultdict

import corpus_pipeline
import pytest
from labelscope.llm import pieces
from labelscope.llm.queries import PIECE_MODEL

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def steps(spark):
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    found.append(docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name.split()[0])
        found.append(docs.collect())
    return found


def shingles(text):
    words = [w for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))]
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return len(a & b) * 100 >= 80 * len(a | b) and bool(a & b)


def test_columns(steps):
    for rows in steps[:-1]:
        assert list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(steps):
    kept = {r.doc_id for r in steps[1]}
    assert kept < {r.doc_id for r in steps[0]}
    assert not [r for r in steps[1] if len(WORD.findall(r.text)) < 10]
    clean = [r for r in steps[0] if len(WORD.findall(r.text)) >= 20 and not re.search("[|%&$#*!]", r.text)]
    assert sum(r.doc_id in kept for r in clean) >= 0.95 * len(clean)


def test_lines(steps):
    order = sorted(steps[1], key=lambda r: r.doc_id)
    after = {r.doc_id: r.text for r in steps[2]}
    seen = []
    for r in order:
        lines = r.text.split("\n")
        sets = [frozenset(WORD.findall(x)) for x in lines]
        wanted = []
        for line, words in zip(lines, sets):
            if not words or not any(alike(words, o) for o in seen):
                wanted.append(line)
            if words:
                seen.append(words)
        text = "\n".join(wanted)
        assert after.get(r.doc_id, "") == (text if WORD.search(text) else ""), r.doc_id


def test_near_duplicates(steps):
    rows = sorted(steps[2], key=lambda r: r.doc_id)
    sets, group = [shingles(r.text) for r in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if alike(sets[a], sets[b]):
                x, y = sorted((group[a], group[b]))
                group = [x if g == y else g for g in group]
    assert sorted(r.doc_id for r in steps[3]) == [r.doc_id for k, r in enumerate(rows) if group[k] == k]


def test_mix(steps):
    from test_mixing import targets

    size, taken = defaultdict(int), defaultdict(int)
    for r in steps[3]:
        size[r.source] += len(WORD.findall(r.text))
    for r in steps[4]:
        taken[r.source] += len(WORD.findall(r.text))
    largest = max(len(WORD.findall(r.text)) for r in steps[3])
    for source, goal in targets(size).items():
        assert abs(taken[source] - goal) <= largest


def test_encoding(steps):
    table = pieces.load(PIECE_MODEL)
    decoded = lambda ids: b"".join(table.bytes_of[k] for k in ids)[1:].decode()
    assert sorted((r.doc_id, decoded(r.ids)) for r in steps[5]) == sorted((r.doc_id, r.text) for r in steps[4])
    assert all(r.n_pieces == len(r.ids) for r in steps[5])


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "component_id long, _key string, size int, position double, row int, removed int, u long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels for the quality stage."""
    path = str(tmp_path_factory.mktemp("labels"))
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def made(frame, rows):
    return frame([(i, t, "en", s, len(t or ""), 1, "k", 2, 3.0, 4, 5, 6) for i, t, s in rows], f"{COLUMNS}, {EXTRA}")


def test_empty_tables_and_extra_columns(spark, frame, folder):
    for name, stage in corpus_pipeline.STAGES:
        empty = made(frame, [])
        found = stage(spark, empty, folder)
        assert found.collect() == [] and (name == corpus_pipeline.STAGES[-1][0] or found.columns == empty.columns)


def test_null_and_repeated_ids(spark, frame, folder, prose):
    one, two, three = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(None, one, "a"), (None, two, "a"), (None, one, "b"), (7, two, "a"), (7, three, "a"), (7, three, "a"), (9, prose(4, 60), None), (None, None, "a"), (8, "", None)]
    kept = corpus_pipeline.one_of_each_group(spark, made(frame, rows), folder).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(
        [(None, one), (7, two), (7, three), (9, rows[6][1]), (None, None), (8, "")], key=repr)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, made(frame, rows), folder).collect()


def test_short_lines_that_repeat_go(spark, frame, folder, prose):
    rows = [(k, f"Read more\n{prose(k, 20)}\nTop", "a") for k in range(6)]
    kept = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_lines(spark, made(frame, rows), folder).collect()}
    assert kept == {k: t if k == 0 else t.split("\n")[1] for k, t, _ in rows}
