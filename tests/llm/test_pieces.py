import random

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from labelscope.llm import pieces
from labelscope.llm.queries import PIECE_MODEL

TABLE = pieces.load(PIECE_MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def encoded(text):
    return np.frombuffer(pieces.encode_text(text, TABLE, {}), np.int32).tolist()


def decoded(ids):
    return b"".join(TABLE.bytes_of[k] for k in ids)[1:].decode()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abcdefghijklmnopqrstuvwxyzeeaattoo  \n\t.,'-AÉéüß中😀0123%$\x00", max_size=60))
def test_ids_are_those_of_the_library(text):
    ids = encoded(text)
    assert ids == LIBRARY.encode(text)
    assert decoded(ids) == text


def test_corpus_words(spark):
    text = "\n".join(r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect())
    assert encoded(text) == LIBRARY.encode(text)


def test_long_words():
    r = random.Random(3)
    letters = ["abcdefghijklmnopqrstuvwxyz", "etaoinshr", "abc-/._%0123456789ABCDEF", "中国日本語テストの文字", "é😀a ▁"[:3] + "b", " ", "e"]
    for k, size in enumerate([65, 66, 100, 128, 129, 200, 700, 1500, 5000] * 8):
        word = "".join(r.choices(letters[k % len(letters)], k=size))
        assert encoded(f"a {word} b") == LIBRARY.encode(f"a {word} b"), word
    assert encoded(" " * 700 + "x") == LIBRARY.encode(" " * 700 + "x")


def test_operator(frame, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT", 5)
    r = random.Random(1)
    texts = [None, "", " ", "\n\n", "a▁b", "x" * 5000, " " * 700, " ".join("the of and".split() * 3000), "Hello  world \n", "".join(map(chr, r.choices(range(1, 0xD7FF), k=300)))]
    rows = [(k, t, "s", 1) for k, t in enumerate(texts)] + [(8, texts[8], None, None), (None, "x y", "s", 1)]
    found = pieces.decode(pieces.encode(frame(rows, "doc_id long, text string, ids string, decoded int"), TABLE), TABLE).collect()
    assert len(found) == len(rows)
    assert all(x.decoded == (x.text or "") for x in found)
    assert [len(x.ids) for x in found if x.doc_id in (0, 1)] == [0, 0]
    assert pieces.encode(frame([], "doc_id long, text string"), TABLE).collect() == []


def test_only_edges_over_present_symbols_are_looked_up():
    # every run of 2 to 15 letters is a piece: looking up all substrings takes some 300 steps
    lengths = range(2, 16)
    looked = []

    class Ranks(dict):
        def get(self, key, default=None):
            looked.append(key)
            return super().get(key, default)

    names = ["a", *("a" * n for n in lengths)]
    table = pieces.PieceTable({p: k for k, p in enumerate(names)}, Ranks({"a" * n: float(n) for n in lengths}), [0] * 256, [p.encode() for p in names], 15)
    assert "".join(names[k] for k in pieces.fold("a" * 30, table)) == "a" * 30
    assert len(looked) <= 90
