"""What Python tasks of the pipeline hold, and what their worker keeps afterwards."""

import random
import tracemalloc
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from stratalake.llm import common, jaccard, packing


def batches(n: int, words: int) -> list:
    r = random.Random(5)
    texts = [" ".join(f"w{r.randrange(9000)}" for _ in range(words)) for _ in range(n)]
    table = pa.table({"doc": np.arange(n), "text": texts})
    return table.to_batches(max_chunksize=100)


def rows(found: list) -> list:
    return sorted(tuple(r.values()) for b in found for r in b.to_pylist())


def test_keys_are_settled_in_parts():
    """All keys sorted and handed over at once took 117 bytes a key here, not 42."""
    given = batches(300, 3000)
    tracemalloc.start()
    most, keys = 0, 0
    for out in jaccard._sketch(5, 80)(iter(given)):
        most = max(most, out.num_rows)
        keys += int((out.column(4).to_numpy() == jaccard.KEY).sum())
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert keys > 4 * jaccard.PART_KEYS and most <= jaccard.PART_KEYS
    assert peak < 70 * keys


def test_parts_give_the_same_rows(monkeypatch):
    given = batches(20, 60)
    copies = pa.table({"doc": np.arange(20, 60), "text": [given[0].column(1)[i % 20].as_py() + " end" * (i % 3) for i in range(40)]})
    given = [*given, *copies.to_batches()]
    whole = rows(jaccard._sketch(5, 80)(iter(given)))
    monkeypatch.setattr(jaccard, "PART_KEYS", 7)
    parts = rows(jaccard._sketch(5, 80)(iter(given)))
    assert parts == whole and {r[4] for r in whole} == {jaccard.DOC, jaccard.SAME, jaccard.NEAR, jaccard.KEY, jaccard.SET}


@pytest.mark.parametrize("end", ["all read", "left early", "failed"])
def test_worker_hands_memory_back(monkeypatch, end):
    class Held:
        pass

    own, calls = [], []

    def run(given):
        held = Held()
        own.append(weakref.ref(held))
        for x in given:
            if end == "failed":
                raise ValueError(x)
            yield x

    common.per_worker("words", Held)
    kept = weakref.ref(common.per_worker("words", None))
    # whether anything is left of what another operator remembered, and of the task's own
    monkeypatch.setattr(common, "hand_back", lambda: calls.append((kept() is not None, [r() is not None for r in own])))
    task = common.tidy(run)(iter([1, 2]))
    if end == "failed":
        with pytest.raises(ValueError):
            list(task)
    elif end == "left early":
        next(task)
        task.close()
    else:
        assert list(task) == [1, 2]
    # an error that is on its way holds what the task had
    assert calls == [(False, []), (False, [end == "failed"])]


def test_words_are_remembered_once():
    """Words kept among the parts of words, too, took 342 bytes a word here, not 171."""
    r = random.Random(7)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(40_000)]
    encode = packing.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    encode(["a"])  # imports
    tracemalloc.start()
    for at in range(0, len(words), 1000):
        encode([" ".join(words[at : at + 1000])])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 260 * len(words)


@pytest.mark.parametrize("kept", [{}, {"cache_words": 50, "cache_stems": 10}])
def test_known_words_serve_others(kept):
    """A part is taken from the words known, the new words or the other parts, whichever has it."""
    path = public_tokenizers.path("word_bpe_49k.json")
    encode, model = packing.tokenizer(path, **kept), Tokenizer.from_file(path)
    r = random.Random(8)
    stems = ["".join(r.choices("aeinorst", k=r.randrange(1, 6))) for _ in range(90)]
    forms = [str, str.title, str.upper, "{},".format, "{}.)".format, "({})".format, "{}é".format]
    texts = [" ".join(r.choice(forms)(w) for w in r.choices([*stems, ",", ".)", "12", ""], k=40)) for _ in range(60)]
    want = [np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [x for t in texts for x in encode([t])] == want
    assert packing.tokenizer(path, **kept)(pa.array([None, *texts])) == [b"", *want]
