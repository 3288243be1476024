"""Sets and keys made by array: the work a text takes, and the same sets as plain Python's."""

import random
import sys

import numpy as np
import pyarrow as pa
import pytest

from stratalake.llm import jaccard

from .test_jaccard import shingles

PARTS = ["a", "B", "Z", "É", "İ", "K", "中" * 30, "😀", "\x00", "\x1c", "\x85", "\xa0", " ", "@", "[", "x" * 64, "x" * 65, "X" * 65]
GAPS = [" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r\n", " " * 99]


def odd_texts(n: int) -> list:
    r = random.Random(11)

    def text():
        words = ("".join(r.choices(PARTS, k=r.choice([1, 1, 2]))) for _ in range(r.choice([0, 1, 2, 3, 4, 5, 30])))
        return r.choice(["", " "]) + "".join(w + r.choice(GAPS) for w in words) + r.choice(["", "end"])

    return [None, "", " \n"] + [text() for _ in range(n)]


@pytest.mark.parametrize("chunk", [1, 200, 2**18])
def test_sets_are_those_of_plain_python(monkeypatch, chunk):
    texts = odd_texts(1500)
    whole = jaccard.shingle_sets(4)(texts)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    for k in (1, 2, 4, 6):
        names: dict = {}
        found = jaccard.shingle_sets(k)(texts)
        for text, s in zip(texts, found, strict=True):
            want = frozenset(shingles(text, k))
            assert len(s) == len(want) and (s[1:] > s[:-1]).all()
            assert names.setdefault(s.tobytes(), want) == want
        assert len(names) == len(set(names.values()))
        if k == 4:  # wherever the texts are cut
            assert [s.tolist() for s in found] == [s.tolist() for s in whole]
    assert jaccard.shingle_sets(4)([]) == []


def test_keys_of_several_sets_are_those_of_each():
    r = random.Random(12)
    sets = [np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64)) for n in (1, 2, 5, 6, 7, 30, 31, 90, 400, 1500) * 3]
    common = np.sort(np.concatenate(sets)[::3])
    bands = jaccard.Bands(85)
    for c in ((), common):
        k, of, many = bands.keys_of(sets, c)
        assert np.array_equal(np.repeat(of, many), np.sort(np.repeat(of, many)))
        for i, s in enumerate(sets):
            assert np.array_equal(np.concatenate(bands.keys(s, c)), k[np.repeat(of, many) == i])
    assert [len(x) for x in bands.keys_of([])] == [0, 0, 0]


def test_few_calls_a_text():
    """A text took about 290 calls (and look-ups of all its words) when its set and keys were made alone."""
    r = random.Random(13)
    texts = [" ".join(f"w{r.randrange(20_000)}" for _ in range(100)) for _ in range(2000)]
    given = pa.table({"doc": np.arange(len(texts)), "text": texts}).to_batches()
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        for _ in jaccard._sketch(4, 85)(iter(given)):
            pass
    finally:
        sys.setprofile(None)
    assert calls < 60 * len(texts)
