"""Importance resampling against plain Python, word by word."""

import hashlib
import math
import re
import zlib

import pyarrow as pa
import pytest

from stratalake.llm import resampling
from stratalake.llm.common import translated

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    None, "", "  ", " a", "ABC d'e  ÀÉ É\nx\n\ny z", "w" * 200 + " b " + "é" * 90 + " c", "\x00a\x1fb", "日本 語", "it's  It's",
    "İstanbul ΣΑΣ ς", "a", "word " * 25, "The cat sat on the mat, the cat. " * 3, "x" * 40_000, "lorem Ipsum " * 9000,
]


def words(text):
    return re.findall(resampling.WORD, (text or "").translate(LOWER))


def runs(text, most):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) for k in range(1, most + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("most,buckets,memory", [(2, 10_000, 500_000), (3, 70_001, 4), (1, 7, 1)])
def test_buckets_of_every_text(most, buckets, memory):
    cut = resampling.cutter(most, buckets, memory)
    for texts in (TEXTS, TEXTS[::-1], [], [None], TEXTS[4:9]):
        n_words, n_features, got = cut(translated(pa.array(texts, pa.string()), resampling.LOWER))
        at = 0
        for t, n, m in zip(texts, n_words.tolist(), n_features.tolist()):
            want = sorted(c % buckets for c in runs(t, most))
            assert (len(words(t)), len(want), want) == (n, m, sorted(got[at : at + m].tolist()))
            at += m
        assert at == len(got)


def test_words_have_their_offsets():
    text = "ABC d'e  ÀÉ É\nx".translate(LOWER)
    found = resampling.splitter()(text)
    assert [w for w, _ in found] == words(text) and all(text[s:e] == w for w, (s, e) in found)


def plain(docs, target, buckets, least, percent):
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for c in runs(text, 2):
            s[c % buckets] += 1
    for text in target:
        for c in runs(text, 2):
            t[c % buckets] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        f = runs(text, 2)
        weight = sum(gain[c % buckets] for c in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], r[1]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return rows


KEY = lambda r: tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("least,percent", [(20, 25), (0, 100), (1, 60)])
def test_against_plain_python(spark, least, percent):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b c"), (None, "a b c"), (3, TEXTS[12]), (3, TEXTS[12]), (-7, TEXTS[12])]
    target = ["the cat sat", None, "", "ABC lorem"]
    # columns with the names that the operator uses itself
    d = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in docs], "doc_id long, text string, score string, rank int, n_words int, features int").repartition(3)
    b = spark.createDataFrame([(k, t, "y") for k, t in enumerate(target)], "item_id long, text string, _no_id string")
    got = resampling.resample(d, b, buckets=97, least_words=least, percent=percent).collect()
    assert sorted(map(tuple, got), key=KEY) == sorted(map(tuple, plain(docs, target, 97, least, percent)), key=KEY)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    full = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resampling.resample(docs, full).collect() == []
    got = resampling.resample(full, docs, buckets=11, least_words=0, percent=50).collect()
    assert sorted(map(tuple, got), key=KEY) == sorted(map(tuple, plain([(1, "a b"), (2, None)], [], 11, 0, 50)), key=KEY)


def test_many_rows_of_one_score(spark):
    docs = [(5, "a b")] * 40 + [(6, "c")] * 3
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = resampling.resample(d, d, least_words=1, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 22))
