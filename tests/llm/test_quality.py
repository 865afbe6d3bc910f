import math
import re
from collections import Counter

import xxhash
from labelscope.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def spark_hash(*parts):
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part.encode(), seed)
    return seed - 2**64 if seed >= 2**63 else seed


def buckets(text, n):
    words = WORD.findall(text or "")
    return [spark_hash(w) % n for w in words] + [spark_hash(a, b) % n for a, b in zip(words, words[1:])]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_against_brute_force(frame, prose):
    texts = [prose(k, 5 + 9 * k) for k in range(12)]
    texts += [None, "", "  \n\t", prose(1, 12) + "\n" + prose(1, 12), "a b c d e " * 4, "a a a a a a a", "#a|b <>\n\n \nx\nx\nx &",
              "é ü\xa0ß 😀 x", prose(3, 40) + "\x0b" + prose(3, 40), prose(5, 9) * 300]
    texts += [" ".join(f"junk{k % 7}%%%" for k in range(60)), prose(2, 10)]
    rows = [(k, t, k) for k, t in enumerate(texts)] + [(3, texts[3], 0), (None, texts[4], 0)]
    labels = [(k, 1 if k < 12 else 0, 0) for k in range(0, len(texts), 2)] + [(0, 1, 0), (None, 1, 0), (7, None, 1)]
    n, threshold = 512, -0.05
    found = quality.judge(frame(rows, "doc_id long, text string, words int"), frame(labels, "doc_id long, quality int, toxic int"),
                          threshold=threshold, buckets=n)
    raw = Counter(b for _, t, _ in rows for b in buckets(t, n))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    target = Counter(b for i, t, _ in rows if i in good for b in buckets(t, n))
    part = sum(target.values()) / sum(raw.values())
    ratio = {b: round(math.log((target[b] + 10 * part) / ((raw[b] + 10) * part)) * 1e6) for b in raw}
    wanted = []
    for i, t, _ in rows:
        words, chars, symbols, lines, repeat = base(t)
        grams = buckets(t, n)
        failed = words < 10 or 100 * repeat > 20 * words
        score = sum(ratio[b] for b in grams)
        wanted.append((i, words, chars, symbols, lines, repeat, failed, not failed and score >= round(threshold * 1e6) * len(grams)))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted(map(repr, map(tuple, found.select(columns).collect()))) == sorted(map(repr, wanted))
    assert {w[-1] for w in wanted} == {True, False}


def test_empty_tables_and_no_trusted_documents(frame, prose):
    none = frame([], "doc_id long, quality int, toxic int")
    assert quality.judge(frame([], "doc_id long, text string"), none).collect() == []
    kept = quality.judge(frame([(1, prose(1, 20)), (2, "a b")], "doc_id long, text string"), none)
    assert {r.doc_id: r.kept for r in kept.collect()} == {1: True, 2: False}


def test_main_path_has_no_python(spark, frame, prose):
    found = quality.judge(frame([(1, prose(1, 20))], "doc_id long, text string"), frame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_accuracy_on_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where("doc_id % 2 = 1")  # the other half is the trusted side
    found = quality.judge(docs, labels.where("doc_id % 2 = 0")).join(held, "doc_id").where("n_words >= 20 and not base_failed").collect()
    good, bad = ([r.kept for r in found if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.2 * len(bad)
