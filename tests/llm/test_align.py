import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from labelscope.llm import align, perfect
from labelscope.llm.queries import BYTE_MODEL, PIECE_MODEL, QUERIES

A = Tokenizer.from_file(BYTE_MODEL)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
SIGNS = align.byte_of_sign()
MODELS = align.load(BYTE_MODEL, PIECE_MODEL)


def cut(text):
    """[(id, bytes)] of both sides, by the libraries; two empty lists for texts without tokens."""
    if not text:
        return [], []
    a = [(k, bytes(SIGNS[c] for c in A.id_to_token(k))) for k in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(k, bytes([int(B.id_to_piece(k)[3:5], 16)]) if B.is_byte(k) else B.id_to_piece(k).replace("▁", " ").encode()) for k in B.encode(text)]
    whole = (" " + text).encode()
    return (a, b) if all(b"".join(x for _, x in side) == whole for side in (a, b)) else ([], [])


def spans(side):
    at, found = 0, []
    for k, x in side:
        found.append((k, at, at + len(x)))
        at += len(x)
    return found


def brute(rows):
    both = [tuple(map(spans, cut(text))) for _, text in rows]
    links = [[(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] for a, b in both]
    count = Counter(pair for x in links for pair in x)
    highest = Counter()
    for (_, j), n in count.items():
        highest[j] = max(highest[j], n)
    result = []
    for (doc_id, _), (a, b), own in zip(rows, both, links):
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = ["%s|%s" % tuple(",".join(str(k) for k, _, e in side if low < e <= high) for side in (a, b)) for low, high in zip([0, *ends], ends)]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        result.append((doc_id, len(a), len(b), len(ends), len(own), sum(count[x] == highest[x[1]] for x in own), sum(count[x] for x in own), digest))
    return result


WORDS = ["the", "over", "Überraschung", "naïve", "日本語", "😀", "don't", "<|endoftext|>", "<s>", "</s>", "<0x41>", "1234567", "https://a.b/c?d", "\n\n", "\t", "  ", "zzqqxx", "é"]


def rows_of(seed, n):
    r = random.Random(seed)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 12))) for _ in range(n)]
    extra = [None, "", " ", "a▁b", "\x00", "x" * 300, "　", "a  b", texts[0], texts[0]]
    return [(k % (n - 3), t) for k, t in enumerate(texts)] + [(None, t) for t in extra]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(frame, small, monkeypatch):
    if small:  # many buckets in several slices, short pieces, few tokens at once
        for name, value in (("BUCKET", 8), ("SLICE", 64), ("PIECE", 5), ("TOKENS", 30), ("HELD", 20), ("BRANCH", 2)):
            monkeypatch.setattr(align, name, value)
    rows = rows_of(1, 60)
    found = align.alignments(frame(rows, "doc_id long, text string"), MODELS).collect()
    key = lambda x: repr(tuple(x))
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def test_empty_table_and_clashing_names(frame):
    ddl = "row string, a int, key int, doc_id int, text string, b string"
    assert align.alignments(frame([], ddl), MODELS).collect() == []
    assert list(map(tuple, align.alignments(frame([("x", 1, 2, 3, None, "y")], ddl), MODELS).collect())) == [(3, 0, 0, 0, 0, 0, 0, "")]
    assert list(map(tuple, align.alignments(frame([("x", 1, 2, 3, "hello there", "y")], ddl), MODELS).collect())) == brute([(3, "hello there")])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_ids_are_those_of_the_library(text):
    both = align.tokenizers_of(MODELS)
    assert both.encode_a(" " + text).tolist() == A.encode(" " + text, add_special_tokens=False).ids


def test_long_word():
    both, text = align.tokenizers_of(MODELS), " " + "".join(random.Random(2).choices("abcdeABC0é日", k=20_000))
    assert both.encode_a(text).tolist() == A.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n, buckets", [(0, 1), (1, 1), (5_000, 1), (5_000, 7), (300, 100)])
def test_perfect_hash_is_minimal_and_knows_foreign_keys(n, buckets):
    r = np.random.default_rng(n)
    keys = np.unique(r.integers(0, 2**31, 2 * n))
    own, foreign = keys[::2], keys[1::2]
    bucket = perfect.bucket_of(own, buckets)
    hashed = perfect.joined(buckets, [(k, *perfect.settle(own[bucket == k])) for k in range(buckets)])
    assert sorted(hashed.find(own)) == list(range(len(own)))
    assert (hashed.verified(own) == hashed.find(own)).all() and (hashed.keys[hashed.find(own)] == own).all()
    assert (hashed.verified(foreign) == -1).all()


def test_registered_query_against_brute_force(spark):
    docs = list(map(tuple, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()))
    short = [k for k, (_, text) in enumerate(docs) if len(text or "") < 1500]
    found = {x.doc_id: tuple(x) for x in QUERIES["op13_alignment"](spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(docs) and len(short) > 50
    for x, y in ((found[docs[k][0]], brute([docs[k]])[0]) for k in short):
        assert x[:5] == y[:5] and x[7] == y[7]
    assert sum(x[4] for x in found.values()) > 10_000 and all(0 < x[5] <= x[4] for x in found.values() if x[4])
