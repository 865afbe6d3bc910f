"""Chunks of long texts, pooled vectors."""

import random

import numpy as np
import pytest

from labelscope.operators import chunks as ck
from labelscope.operators import features as ft
from labelscope.runtime import new_path

SCHEMA = "row_id bigint, text string"


def windows(words, size, stride):
    found, start = [], 0
    while True:
        found.append((len(found), start, min(start + size, len(words)), " ".join(words[start:start + size])))
        if start + size >= len(words):
            return found
        start += stride


@pytest.mark.parametrize("size, stride", [(5, 3), (4, 4), (128, 96), (1, 1)])
def test_windows_of_every_length(spark, size, stride):
    texts = {k: ("\n" if k % 2 else "  ").join(f"w{j}" for j in range(k)) for k in range(14)} | {99: " " + " x" * 700}
    df = spark.createDataFrame([*texts.items(), (100, None)], SCHEMA)
    got = {}
    for r in ck.chunks(df, size, stride).orderBy("row_id", "chunk").collect():
        got.setdefault(r["row_id"], []).append((r["chunk"], r["start"], r["end"], r["text"]))
    assert got == {k: windows((t or "").split(), size, stride) for k, t in [*texts.items(), (100, None)]}
    with pytest.raises(ValueError):
        ck.chunks(df, 3, 4)


def test_pools_by_dimension(spark, monkeypatch):
    r = random.Random(4)
    rows = [(k, c, [r.uniform(-1, 1) for _ in range(5)]) for k, n in ((1, 1), (2, 64), (3, 200)) for c in range(n)]
    df = spark.createDataFrame(rows, "row_id bigint, chunk bigint, v array<double>").repartition(4)
    for group in (1, 3, 64):
        monkeypatch.setattr(ck, "GROUP", group)
        for found in ck.pool(df).collect():
            mine = np.array([v for k, _, v in rows if k == found["row_id"]])
            assert found["n_chunks"] == len(mine)
            assert np.allclose(found["mean"], mine.mean(0)) and found["largest"] == mine.max(0).tolist()
    assert ck.pool(df.where("false")).count() == 0


def test_whole_texts_through_a_cached_encoder(spark):
    long = " ".join(f"word{chr(97 + k % 26)}" for k in range(40_000))
    df = spark.createDataFrame([(1, "alpha beta"), (2, long), (3, ""), (4, None), (5, "alpha beta")], SCHEMA)
    path, calls = new_path(spark, "chunk-cache"), []
    hashed = ft.hashed_encoder(8)

    def counted(rows):
        calls.append(rows.count())
        return hashed(rows)

    counted.on_frames = True
    encode = lambda rows: ft.embed_corpus_cached(rows, path, counted, "hashed-8")
    got = {r["row_id"]: r for r in ck.chunk_and_pool(df, encode, 100, 50).collect()}
    assert {k: r["n_chunks"] for k, r in got.items()} == {1: 1, 2: 799, 3: 1, 4: 1, 5: 1}
    assert got[1]["mean"] == got[5]["mean"] == got[1]["largest"] and got[3]["mean"] == [0.0] * 8
    assert calls[0] < 50  # the windows repeat every 13 of them, and equal chunks are encoded once
    assert np.linalg.norm(got[1]["mean"]) == pytest.approx(1.0)


def test_encoder_on_frames_counts_every_token(spark):
    import hashlib

    texts = [(1, "a a b"), (2, ""), (3, "One, two; ONE!")]
    found = {r["key"]: r["v"] for r in ft.hashed_encoder(4)(spark.createDataFrame(texts, "key bigint, text string")).collect()}
    for k, text in texts:
        wanted = [0.0] * 4
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            number = int(hashlib.md5(word.encode()).hexdigest()[:8], 16)
            wanted[number % 4] += 1.0 if number // 4 % 2 == 0 else -1.0
        assert found[k] == wanted
