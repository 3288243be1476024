"""Packing: an exact round trip of every id, and little padding."""

import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stratalake.llm import packing
from stratalake.llm.common import read_table

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", "  ", "the cat\nsat", "<|endoftext|> a b<|startoftext|>c", "it's we'll  x\x1c\x85 á b", "ΣΑΣ ς İ", "a ́b",
    "😀!! ÀÉ,, don't ABC's--x a_b [x]", "x" * 50_000, "lorem ipsum " * 9000, "THE,!! Ing.) 12$$ a1b2",
]


def check(spark, rows, window=packing.WINDOW, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, length string").repartition(3)
    got = packing.pack(df, PATH, window=window, keep_ids=True, **kw).collect()
    t = Tokenizer.from_file(PATH)
    want = sorted([(str(i), [*t.encode(x or "", add_special_tokens=False).ids, 1]) for i, x in rows])
    pieces: dict = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
    ids = []
    for d, parts in pieces.items():  # repeated ids share their pieces: compare as multisets of texts
        at: dict = {}
        for p in sorted(parts, key=lambda p: p["start"]):
            raw = bytes(p["ids"])
            assert len(raw) == 4 * p["length"] and zlib.crc32(raw) == p["ids_crc32"]
            at.setdefault(p["doc_tokens"], []).append(p)
        for total, ps in at.items():
            body = [int.from_bytes(bytes(p["ids"])[k : k + 4], "little") for p in ps for k in range(0, 4 * p["length"], 4)]
            ids.append((str(d), total, body))
    for d, total, body in ids:
        same = [w for i, w in want if i == d and len(w) == total]
        assert len(body) == total * len(same)
        if len(same) == 1:
            assert body == same[0]
    assert sum(len(b) for *_, b in ids) == sum(len(w) for _, w in want)
    seqs: dict = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / max(1, sum(len(w) for _, w in want)), len(got)


def test_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (3, "the cat\nsat"), (3, "the cat\nsat")]
    check(spark, rows)
    check(spark, rows, window=64, open_windows=2, max_pad=0)


def test_little_padding(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    padding, _ = check(spark, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert padding < 0.01


def test_empty_table(spark):
    assert check(spark, [])[1] == 0


def test_forgotten_words_change_nothing():
    full, small = packing.tokenizer(PATH), packing.tokenizer(PATH, cache_words=5)
    texts = [t or "" for t in TEXTS]
    assert full(texts) == [x for t in texts for x in small([t])]


@pytest.mark.parametrize("sizes,most", [([1500, 600, 500, 48, 1400], 2), ([2048, 1, 2047], 1)])
def test_best_fit(sizes, most):
    out = []
    p = packing.Packer(out.append, 2048, most, 2048)
    for i, n in enumerate(sizes):
        p.add(i, n, 0, bytes(4 * n))
    for w in [*out, *p.left()]:
        assert sum(len(x[3]) for x in w) // 4 <= 2048
    assert len(p.open) == 0
    if most == 2:
        # 500 goes beside 1500 (best fit), 48 fills it up; no window is cut as padding is allowed
        assert [x[0] for x in out[0]] == [0, 2, 3]


@pytest.mark.parametrize("cache_words", [1_000_000, 40])
def test_any_text_is_encoded_as_the_tokenizer_does(cache_words):
    import random

    rng = random.Random(5)
    signs = [*"abcXYZ  \n'!,.-é日ÀßİΣς́0189_[]{}@#\t\x1c\x85<|>😀ŐñÑ", "<|endoftext|>", "'s", "'ll", "the", "ing"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(4000)]
    encode, model = packing.tokenizer(PATH, cache_words), Tokenizer.from_file(PATH)
    got = [raw for at in range(0, len(texts), 300) for raw in encode(texts[at : at + 300])]
    for text, raw in zip(texts, got):
        assert memoryview(raw).cast("I").tolist() == model.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_met_again_are_remembered():
    from stratalake.llm.common import Remembered

    made: list = []

    def make(words):
        import numpy as np

        made.extend(words)
        return np.array([len(w) for w in words]), np.array([ord(c) for w in words for c in w], np.uint32)

    r = Remembered(make, 8)
    for k in range(40):
        words = ["often", "x", *(f"once{k}-{i}" for i in range(3))]
        places, many = r.expand(r.rows(words))
        assert "".join(map(chr, r.columns[0][places])) == "".join(words) and many.tolist() == [len(w) for w in words]
        assert len(r.row) <= 8
    assert made.count("often") == 1 and made.count("x") == 1
