"""The queries op1 and op7 against plain versions: one text, one chunk, one window at a time."""

import math
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
import zstandard

from stratalake.llm import langid, quality
from stratalake.llm.queries import QUERIES

ODD = [None, "", " \t\n", "12 34 !!", "é", "a", "ab\x00ab\x00ab", "word " * 900, "ÀÉÎ õü " * 400]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("plain"))
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text", "lang", "source"]).to_pylist()
    docs = [r for r in docs if r["text"] is None or len(r["text"]) <= 6000][:90]
    last = max(r["doc_id"] for r in docs)
    docs += [{"doc_id": last + 1 + i, "text": t, "lang": "en" if i % 2 else None, "source": "s"} for i, t in enumerate(ODD)]
    pq.write_table(pa.Table.from_pylist(docs), os.path.join(d, "documents.parquet"))
    labels = [{"doc_id": r["doc_id"], "quality": int(r["doc_id"] % 3 > 0), "toxic": 0} for r in docs]
    pq.write_table(pa.Table.from_pylist(labels), os.path.join(d, "labels.parquet"))
    return d, docs


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


# --- language ---------------------------------------------------------------
def plain_dictionaries(docs):
    found = {}
    for r in docs:
        if r["text"] is None or r["lang"] is None or fold(r["doc_id"]) == 0:
            continue
        seed = xxhash.xxh64(struct.pack("<q", r["doc_id"]), seed=42).intdigest()
        h = xxhash.xxh64(r["text"].encode(), seed=seed).intdigest()
        h = h - 2**64 if h >= 2**63 else h
        at = h % max(len(r["text"]) - langid.SLICE_CHARS, 1)
        found.setdefault(r["lang"], []).append((h, r["text"][at : at + langid.SLICE_CHARS]))
    out = {}
    for lang, pieces in found.items():
        best = [p for _, p in sorted(pieces)[: langid.SAMPLE_TEXTS]]
        out[lang] = " ".join(re.sub(r"[\W\d_]+", " ", p.lower()).strip() for p in reversed(best)).encode()
    return {k: v for k, v in out.items() if len(v) >= 8}


def plain_language(text, dictionaries):
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    raw = re.sub(r"[\W\d_]+", " ", text.lower()).strip().encode()
    params = zstandard.ZstdCompressionParameters(
        window_log=langid.WINDOW_LOG, chain_log=langid.WINDOW_LOG - 1, hash_log=langid.WINDOW_LOG - 2, search_log=langid.SEARCH_LOG,
        min_match=langid.MIN_MATCH, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    totals = {}
    for lang, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        totals[lang] = 0
        for at in range(0, max(len(raw), 1), langid.CHUNK):
            totals[lang] += len(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress(raw[at : at + langid.CHUNK]))
    best = min(totals.values())
    odds = sum(math.exp(-langid.SHARPNESS * (n - best) / best) for n in totals.values())
    return min(k for k, n in totals.items() if n == best), 1 / odds


def test_language_query_is_the_plain_one(spark, tables):
    d, docs = tables
    known = plain_dictionaries(docs)
    assert len(known) >= 3
    got = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, d).collect()}
    assert len(got) == len(docs)
    for r in docs:
        lang, score = plain_language(r["text"], known)
        g = got[r["doc_id"]]
        assert (g["lang_pred"], g["held_out"]) == (lang, fold(r["doc_id"]) == 0)
        assert math.isclose(g["score"], score, rel_tol=1e-12)


# --- quality ----------------------------------------------------------------
def plain_echo(b):
    out = [0.0] * len(b)
    hits = []
    for j in range(len(b) - 3):
        run = b[j : j + 4]
        hits.append(any(run == b[j - lag : j - lag + 4] for lag in range(2, quality.ECHO_LAG + 1) if j - lag >= 0))
        out[j + 3] = sum(hits[-quality.ECHO_SPAN :]) / quality.ECHO_SPAN
    return out


def plain_quality(text, w):
    b = (text or "").encode()
    echo = plain_echo(b)
    filters = w["filters"].astype(float)
    best = np.full(quality.FILTERS, -np.inf)
    for at in range(0, max(len(b), 1), quality.STEP):
        window = np.zeros((quality.WIDTH, quality.EMBED + 1))
        for i in range(quality.WIDTH):
            if at + i < len(b):
                window[i, : quality.EMBED] = w["embed"][b[at + i]] if b[at + i] else 0
                window[i, quality.EMBED] = echo[at + i]
        best = np.maximum(best, window.ravel() @ filters)
    z = float(np.maximum(best + w["bias"], 0) @ w["out"].astype(float) + w["base"][0] + w["shift"])
    return 1 / (1 + math.exp(-min(max(z, -30), 30)))


def test_quality_query_is_the_plain_one(spark, tables):
    d, docs = tables
    frames = [spark.read.parquet(f"{d}/{n}.parquet") for n in ("documents", "labels")]
    w = quality.learn(*frames)
    got = {r["doc_id"]: r for r in QUERIES["op7_quality"](spark, d).collect()}
    assert len(got) == len(docs)
    for r in docs:
        p = plain_quality(r["text"], w)
        g = got[r["doc_id"]]
        assert math.isclose(g["score"], p, abs_tol=2e-4)
        assert g["held_out"] == (fold(r["doc_id"]) == 0)
        assert g["predicted"] == int(g["score"] >= 0.3)


def test_training_lowers_the_loss():
    r = np.random.default_rng(3)
    texts = [bytes(r.integers(97, 105, size=n).tolist()) for n in (5, 40, 90, 17, 64)]
    y = np.array([0, 1, 1, 0, 1], np.float32)
    net = quality.Network()

    def loss():
        z = net.logits(texts).astype(float)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    before = loss()
    net.train(texts, y, epochs=8)
    assert loss() < before
