"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary texts, with absolute discounting. Both
back off to one shared continuation distribution (in how many contexts a word was
seen, in either class). The rarer an expression (word or pair of words), the likelier its
class counts differ by chance: its difference is shrunk, towards what the shared counts
say of it (none), by the odds that the classes do differ, which follow from the G
statistic of its contexts and ``PRIOR``. A pair is so shrunk towards its last word.

A text is scored by the difference of the two log-likelihoods per word: over the
whole text, and over the most toxic stretch of ``STRETCH`` words, so that a few toxic
words stay visible in a long text. A logistic unit, fitted on sampled texts that the
counts of its fold have not seen, makes a probability of the two.

Trained on the driver on a bounded sample of labelled texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .quality import FOLDS, sample

__all__ = ["FOLDS", "learn", "score"]

SAMPLE = 3000  # training texts of each class
SAMPLE_CHARS = 20_000  # longer texts are not sampled
PRIOR = 1e-4  # odds, before any evidence, that an expression tells the classes apart
LEAST = 0.01  # smaller differences of a word, and smaller beliefs in a pair, are left out
STRETCH = 16
THRESHOLD = 0.5
PARTS = 2  # of the sample, for the logistic unit


def words(text: str) -> list[str]:
    """Runs of letters, lower case."""
    import re

    return re.findall(r"[^\W\d_]+", text.lower())


def _discount(counts) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.75


def _evidence(a, b, na: float, nb: float):
    """G statistic of counts a of na and b of nb against one common rate."""
    import numpy as np

    n = a + b
    ea, eb = n * na / (na + nb), n * nb / (na + nb)
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * (np.where(a > 0, a * np.log(a / ea), 0) + np.where(b > 0, b * np.log(b / eb), 0))


def _belief(g):
    """How much of a difference counts, by its G statistic: from 0 (none) to 1."""
    import numpy as np

    return 1 / (1 + np.exp(-np.minimum(g, 100) / 2) / PRIOR)


class Model:
    """Differences of log-probability, toxic minus ordinary: of words, and of pairs."""

    def __init__(self, texts: list, toxic: list[int], names: list):
        """texts: arrays of word numbers; names: what a word of each number is called in the model."""
        import numpy as np

        size = max(len(names), 1)
        none = [np.zeros(0, np.int64)]
        tokens = [np.concatenate([s for s, y in zip(texts, toxic) if y == c] or none) for c in (0, 1)]
        # which text a word is of: pairs and triples lie within one text
        of = [np.repeat(np.arange(toxic.count(c)), [len(s) for s, y in zip(texts, toxic) if y == c]) for c in (0, 1)]
        uni = [np.bincount(t, minlength=size).astype(float) for t in tokens]
        pairs = [(t[:-1] * size + t[1:])[o[:-1] == o[1:]] for t, o in zip(tokens, of)]
        found = [np.unique(p, return_counts=True) for p in pairs]
        every = np.union1d(found[0][0], found[1][0])
        bi = [np.zeros(len(every)), np.zeros(len(every))]
        for y in (0, 1):
            bi[y][np.searchsorted(every, found[y][0])] = found[y][1]
        first, second = every // size, every % size
        n = [max(u.sum(), 1.0) for u in uni]

        # shared backoff: contexts of a word in either class, a little for unseen words
        contexts = np.bincount(second, minlength=size).astype(float)
        shared = (contexts + 0.5) / (contexts.sum() + 0.5 * (size + 1))
        prob = []
        for y in (0, 1):
            d = _discount(uni[y])
            prob.append(np.maximum(uni[y] - d, 0) / n[y] + d * (uni[y] > 0).sum() / n[y] * shared + 1e-12)
        # evidence counts contexts, not occurrences: copies of a passage are no evidence
        kinds = [np.bincount(second, bi[y] > 0, minlength=size) for y in (0, 1)]
        believed = _belief(_evidence(kinds[1], kinds[0], max(kinds[1].sum(), 1), max(kinds[0].sum(), 1)))
        both = (prob[0] + prob[1]) / 2
        diff = believed * np.log(prob[1] / prob[0])
        self.words = {names[i]: float(diff[i]) for i in np.flatnonzero(np.abs(diff) >= LEAST)}

        # pairs: the context's own counts, backing off to the class's word model
        logs, seen, total = [], [], []
        for y in (0, 1):
            d = _discount(bi[y])
            context = np.bincount(first, bi[y], minlength=size)[first]
            followers = np.bincount(first, bi[y] > 0, minlength=size)
            base = (both * (prob[y] / both) ** believed)[second]
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.maximum(bi[y] - d, 0) / context + d * followers[first] / context * base
            logs.append(np.log(np.where(context > 0, p, base)))
            t = tokens[y]
            inside = of[y][:-2] == of[y][2:]
            where = np.searchsorted(every, (t[1:-1] * size + t[2:])[inside])
            three = np.unique(where * size + t[:-2][inside])
            seen.append(np.bincount(three // size, minlength=len(every)))
            total.append(np.maximum(np.bincount(first, seen[y], minlength=size)[first], 1))
        pair = _belief(_evidence(seen[1], seen[0], total[1], total[0]))
        value = pair * (logs[1] - logs[0]) + (1 - pair) * diff[second]
        self.pairs: dict = {}
        for i in np.flatnonzero(pair >= LEAST):
            self.pairs.setdefault(names[second[i]], {})[names[first[i]]] = float(value[i])

    def features(self, text: list) -> tuple[float, float]:
        """Difference per word over the text, and over its most toxic stretch."""
        single, pairs = self.words, self.pairs
        at, value = [], []
        for i, w in enumerate(text):
            if w in single or w in pairs:
                v = pairs.get(w, {}).get(text[i - 1] if i else None)
                at.append(i)
                value.append(single.get(w, 0.0) if v is None else v)
        best = run = 0.0
        lo = 0
        for hi, i in enumerate(at):
            run += value[hi]
            while at[lo] <= i - STRETCH:
                run -= value[lo]
                lo += 1
            best = max(best, run)
        return sum(value) / max(len(text), STRETCH), best / STRETCH


def _logistic(x, y, weight, rounds: int = 300):
    """Ridge-regularised logistic regression by Newton steps on scaled features."""
    import numpy as np

    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.diag([1e-3] * (x.shape[1] - 1) + [1e-6])
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(x.shape[1])
        w = w - np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge @ w)
        w = np.clip(w, -200, 200)
    return w


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int = SAMPLE,
):
    """(model, logistic weights). Without texts of both classes: (None, share of toxic labels)."""
    import numpy as np

    texts, y, share = sample(docs, labels, label, id_col, text_col, most, SAMPLE_CHARS)
    if len(set(y)) < 2:
        return None, [share]
    ids: dict[str, int] = {}
    tokens = [np.array([ids.setdefault(w, len(ids)) for w in words(t)], np.int64) for t in texts]
    del texts
    x = np.zeros((len(y), 2))
    for part in range(PARTS):
        rest = [i for i in range(len(y)) if i % PARTS != part]
        model = Model([tokens[i] for i in rest], [y[i] for i in rest], range(len(ids)))
        for i in range(part, len(y), PARTS):
            x[i] = model.features(tokens[i].tolist())
    model = Model(tokens, y, list(ids))
    y = np.array(y, float)
    share = min(max(share, 0.01), 0.99)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return model, [float(v) for v in _logistic(x * [100, 10], y, weight)]


def score(docs: DataFrame, learned, text_col: str = "text", keep: list | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns (default: none) + score, predicted, one row per input row.

    A null text counts as empty; a text without words has no evidence and gets the
    score of a text of difference 0. Whole texts are read. An empty table gives no rows.
    """
    model, weights = learned

    def make():
        import math

        def one(text):
            if model is None:
                p = weights[0]
            else:
                mean, stretch = model.features(words(text or ""))
                z = weights[0] * 100 * mean + weights[1] * 10 * stretch + weights[2]
                p = 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))
            return p, int(p >= threshold)

        return lambda texts: [list(c) for c in zip(*map(one, texts))]

    return map_texts(docs, text_col, keep, make, "score double, predicted int")
