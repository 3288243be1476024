"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded (a learned vector for each byte, and beside it the
share of the last ``ECHO_SPAN`` bytes that repeat what stood up to ``ECHO_LAG`` bytes
before, by which runs of one word show). Learned filters of ``WIDTH`` bytes pass over
the whole text in steps of ``STEP`` bytes, so their chunks overlap; each filter keeps
its largest answer (max pooling), and a logistic unit combines them into a probability.

The network is trained on the driver on a bounded sample of labelled texts; the
class shares it assumes are those of all training labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, remainder, staged

FOLDS = 5
SAMPLE = 2000  # training texts of each class
SAMPLE_BYTES = 20_000  # a training text is at most so many characters long; others are not sampled
THRESHOLD = 0.3
EMBED, FILTERS, WIDTH, STEP = 8, 24, 16, 4
ECHO_LAG, ECHO_SPAN = 24, 64
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.01, 1e-4
BLOCK = 1 << 18  # bytes convolved at once


def echo(b):
    """For each byte: the share of the last ECHO_SPAN 4-byte runs seen up to ECHO_LAG bytes before."""
    import numpy as np

    if len(b) < 4:
        return np.zeros(len(b), np.float32)
    q = b[:-3].astype(np.uint32)
    for i in (1, 2, 3):
        q = q << 8 | b[i : len(b) - 3 + i]
    hit = np.zeros(len(q), bool)
    for lag in range(2, min(ECHO_LAG, len(q) - 1) + 1):
        hit[lag:] |= q[lag:] == q[:-lag]
    c = np.concatenate(([0], np.cumsum(hit, dtype=np.int32)))
    at = np.arange(1, len(q) + 1)
    mean = (c[at] - c[np.maximum(at - ECHO_SPAN, 0)]) / np.float32(ECHO_SPAN)
    return np.concatenate((np.zeros(3, np.float32), mean.astype(np.float32)))


class Network:
    """embed (256, EMBED), filters (WIDTH * (EMBED + 1), FILTERS), bias, out, base."""

    def __init__(self, weights: dict | None = None, seed: int = 7):
        import numpy as np

        r = np.random.default_rng(seed)
        inputs = WIDTH * (EMBED + 1)
        self.w = weights or {
            "embed": r.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "filters": r.normal(0, inputs**-0.5, (inputs, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": r.normal(0, 0.3, FILTERS).astype(np.float32),
            "base": np.zeros(1, np.float32),
        }
        self.w["embed"][0] = 0  # padding

    @staticmethod
    def layout(texts: list[bytes]):
        """Texts end to end, each padded with zero bytes: bytes, echo, first step and steps of each."""
        import numpy as np

        parts, echoes, first, steps, at = [], [], [], [], 0
        for t in texts:
            b = np.frombuffer(t, np.uint8)
            n = max(1, -(-len(b) // STEP))
            size = n * STEP + WIDTH - STEP
            size += -size % STEP
            pad = np.zeros(size - len(b), np.uint8)
            parts += [b, pad]
            echoes += [echo(b), pad.astype(np.float32)]
            first.append(at // STEP)
            steps.append(n)
            at += size
        return np.concatenate(parts), np.concatenate(echoes), np.array(first), np.array(steps)

    def answers(self, b, e):
        """What every filter answers at every step."""
        import numpy as np

        x = np.empty((len(b), EMBED + 1), np.float32)
        x[:, :EMBED] = self.w["embed"][b]
        x[:, EMBED] = e
        x = x.reshape(len(b) // STEP, STEP * (EMBED + 1))
        n = len(x) - WIDTH // STEP + 1
        rows = STEP * (EMBED + 1)
        f = self.w["filters"]
        out = x[:n] @ f[:rows]
        for j in range(1, WIDTH // STEP):
            out += x[j : j + n] @ f[j * rows : (j + 1) * rows]
        return out

    def pooled(self, texts: list[bytes]):
        """The largest answer of each filter for each text (no bias), and the step that gave it."""
        import numpy as np

        b, e, first, steps = self.layout(texts)
        a = self.answers(b, e)
        top = np.empty((len(texts), FILTERS), np.float32)
        where = np.empty((len(texts), FILTERS), np.int64)
        for i, (f, n) in enumerate(zip(first, steps)):
            part = a[f : f + n]
            where[i] = part.argmax(0) + f
            top[i] = part.max(0)
        return top, where, b, e

    def largest(self, text: bytes):
        """Pooled answers of one text of any length, in blocks that overlap by a filter."""
        import numpy as np

        if len(text) <= BLOCK:
            return self.pooled([text])[0][0]
        tops = []
        # a block also needs what the echo looks back on; blocks start on a step
        back = -(-(ECHO_LAG + ECHO_SPAN + 8) // STEP) * STEP
        for at in range(0, len(text), BLOCK):
            lo = max(0, at - back)
            piece = np.frombuffer(text[lo : at + BLOCK + WIDTH], np.uint8)
            e = echo(piece)[at - lo :]
            b = piece[at - lo :]
            n = max(1, -(-min(len(b), BLOCK) // STEP))
            size = n * STEP + WIDTH - STEP
            b, e = b[:size], e[:size]
            pad = np.zeros(size - len(b), np.uint8)
            tops.append(self.answers(np.concatenate((b, pad)), np.concatenate((e, pad.astype(np.float32)))).max(0))
        return np.max(tops, 0)

    def logits(self, texts: list[bytes]):
        import numpy as np

        top = np.empty((len(texts), FILTERS), np.float32)
        group, size = [], 0
        for i, t in enumerate([*texts, None]):
            if group and (t is None or size + len(t) > BLOCK):
                top[group] = self.pooled([texts[k] for k in group])[0]
                group, size = [], 0
            if t is None:
                break
            if len(t) > BLOCK:
                top[i] = self.largest(t)
            else:
                group.append(i)
                size += len(t) + WIDTH
        return np.maximum(top + self.w["bias"], 0) @ self.w["out"] + self.w["base"]

    def train(self, texts: list[bytes], y, epochs: int = EPOCHS, seed: int = 7):
        """Adam on the logistic loss; only the windows that won the pooling are corrected."""
        import numpy as np

        r = np.random.default_rng(seed)
        y = np.asarray(y, np.float32)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        total = epochs * -(-len(texts) // BATCH)
        for _ in range(epochs):
            order = r.permutation(len(texts))
            for k in range(0, len(order), BATCH):
                batch = order[k : k + BATCH]
                top, where, b, e = self.pooled([texts[i] for i in batch])
                act = np.maximum(top + self.w["bias"], 0)
                p = 1 / (1 + np.exp(-(act @ self.w["out"] + self.w["base"])))
                g = (p - y[batch]) / len(batch)
                gh = g[:, None] * self.w["out"] * (act > 0)
                pos = where[..., None] * STEP + np.arange(WIDTH)  # text, filter, byte
                window = np.concatenate((self.w["embed"][b[pos]], e[pos][..., None]), -1)
                flat = window.reshape(len(batch), FILTERS, -1)
                f = self.w["filters"].reshape(WIDTH, EMBED + 1, FILTERS)[:, :EMBED]
                to_bytes = gh[:, :, None, None] * f.transpose(2, 0, 1)[None]
                ge = np.zeros_like(self.w["embed"])
                np.add.at(ge, b[pos].ravel(), to_bytes.reshape(-1, EMBED))
                ge[0] = 0
                grads = {
                    "embed": ge,
                    "filters": np.einsum("tf,tfi->if", gh, flat) + DECAY * self.w["filters"],
                    "bias": gh.sum(0),
                    "out": act.T @ g + DECAY * self.w["out"],
                    "base": np.array([g.sum()], np.float32),
                }
                step += 1
                rate = RATE * (1 - step / (total + 1))
                for name, grad in grads.items():
                    m[name] = 0.9 * m[name] + 0.1 * grad
                    v2[name] = 0.999 * v2[name] + 0.001 * grad * grad
                    change = m[name] / (1 - 0.9**step) / (np.sqrt(v2[name] / (1 - 0.999**step)) + 1e-8)
                    self.w[name] = (self.w[name] - rate * change).astype(np.float32)


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, most: int, longest: int):
    """(texts, classes, share of class 1 among all training labels).

    At most ``most`` rows of each class, those of smallest id hash, of crc32(id) mod
    ``FOLDS`` not 0; only labels 0 and 1 of documents with a text of at most ``longest``
    characters count. Bounded, so it may go to the driver.
    """
    text = F.col(text_col)
    d = docs.where(text.isNotNull() & (F.length(text) <= longest)).select(F.col(id_col).alias("_id"), text.alias("_t"))
    rows = labels.where(remainder(id_col, FOLDS) != 0).select(F.col(id_col).alias("_id"), F.col(label).alias("_y"))
    rows = rows.where(F.col("_y").isin(0, 1) & F.col("_id").isNotNull()).join(d.select("_id"), "_id", "left_semi")
    rows = staged(rows, "labelled")
    n = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    picks = [rows.where(F.col("_y") == c).orderBy(F.xxhash64("_id"), "_id").limit(most) for c in (0, 1)]
    few = F.broadcast(picks[0].unionByName(picks[1]))  # at most 2 * most ids
    found = d.join(few, "_id").orderBy(F.xxhash64("_id"), "_t", "_y").limit(2 * most).collect()
    total = sum(n.values())
    return [r["_t"] for r in found], [r["_y"] for r in found], (n.get(1, 0) / total if total else 0.5)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int = SAMPLE,
) -> dict:
    """Weights of the trained network; ``shift`` moves equal class shares to the real ones.

    Without texts of both classes the network answers the share of class 1 (0.5 if
    there are no labels) for every text.
    """
    import numpy as np

    texts, y, share = sample(docs, labels, label, id_col, text_col, most, SAMPLE_BYTES)
    net = Network()
    if len(set(y)) < 2:
        net.w["out"][:] = 0
    else:
        # the class with fewer texts is repeated, so that both weigh the same
        y = np.array(y)
        r = np.random.default_rng(11)
        few = int(y.sum() * 2 < len(y))
        more = r.choice(np.flatnonzero(y == few), max(0, int((y != few).sum() - (y == few).sum())))
        pick = np.concatenate((np.arange(len(y)), more))
        net.train([encoded(texts[i]) for i in pick], y[pick])
    share = min(max(share, 0.01), 0.99)
    return {**net.w, "shift": float(np.log(share / (1 - share)))}


def score(docs: DataFrame, weights: dict, text_col: str = "text", keep: list | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns (default: none) + score, predicted, one row per input row.

    Whole texts are read, in blocks, however long. A null or empty text is scored as
    no bytes. An empty table gives no rows.
    """

    def make():
        import numpy as np

        net = Network({k: v for k, v in weights.items() if k != "shift"})

        def run(texts: list):
            z = net.logits([encoded(t) for t in texts]) + weights["shift"]
            p = 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))
            return [p, (p >= threshold).astype(np.int32)]

        return run

    return map_texts(docs, text_col, keep, make, "score double, predicted int")
