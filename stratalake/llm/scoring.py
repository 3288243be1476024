"""LM scoring by deleted interpolation of word n-grams.

P(w | v) = l0(b) / (V + 1) + l1(b) c(w) / N + l2(b) c(v, w) / c(v), where b is the
bucket (power of two) of the context's frequency c(v). The weights l are learned by
expectation-maximisation on held-out training texts, with counts that leave these out;
the final counts hold all training texts.

Counting and scoring are one exchange of questions and answers, so no token is
shuffled as a row. Tasks cut texts into blocks; a block knows its distinct words and
pairs. It sends each bucket of the hash range a sorted, delta-coded, compressed list
of the hashes with its own counts. A bucket adds the lists of all blocks up and answers
every list with the totals, in the order asked. The block's texts, as numbers of its
words, meet the answers again and are scored. A frequent word or pair is one entry of a
list, however often it occurs, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, remainder, staged, word_hasher

FOLDS = 10
ESTIMATE_FOLDS = 20  # one in so many training texts is held out for the weights
BLOCK_TOKENS = 2_000_000
BUCKET_CHARS = 16_000_000  # of text for each bucket of the hash range
CONTEXTS = 32  # buckets of context frequency
CELLS = 4  # cells an octave, of the ratios that the weights are learned from
ROUNDS = 60
ADD = 0.1  # of the base score

#: kinds of blocks, by the fold of their texts
TRAIN, ESTIMATE, TEST = 0, 1, 2
#: kinds of rows: lists of words, of pairs, a block's texts, a bucket's totals
WORDS, PAIRS, TEXTS, TOTALS = 0, 1, 2, 3

ROW = "dest int, block long, kind int, fold int, payload binary"
NAMES = ["dest", "block", "kind", "fold", "payload"]


def _numbers(values) -> bytes:
    """Non-negative 64-bit numbers as compressed byte planes (as many as the largest needs)."""
    import numpy as np
    import zstandard

    v = np.ascontiguousarray(np.asarray(values).astype("<u8"))
    width = max(1, (int(v.max(initial=0)).bit_length() + 7) // 8)
    planes = v.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _of_numbers(raw: bytes):
    import numpy as np
    import zstandard

    width = raw[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(width, -1)
    v = np.zeros((planes.shape[1], 8), np.uint8)
    v[:, :width] = planes.T
    return v.reshape(-1).view("<u8")


def _joined(parts) -> bytes:
    return b"".join(len(x).to_bytes(8, "little") + x for x in parts)


def _parts(raw: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 8], "little")
        out.append(raw[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def _steps(keys):
    """Sorted 64-bit hashes as differences; np.cumsum gives them back."""
    import numpy as np

    return np.diff(keys, prepend=np.uint64(0))


def _codes(tokens, lengths, size: int):
    """For each token: context * size + word; the context of a text's first word is ``size - 1``."""
    import numpy as np

    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(lengths) - lengths] = size - 1
    return before * size + tokens


def hash_bits(chars: int) -> int:
    """Bits of a pair's hash, growing with the text: about one pair in a million collides."""
    return min(64, max(40, chars.bit_length() + 18))


def _pair_hashes(codes, vocabulary, size: int, bits: int):
    import numpy as np
    import xxhash

    begin = np.uint64(xxhash.xxh64_intdigest("begin", 1))
    h = np.append(vocabulary, begin)[codes // size] * np.uint64(0x9E3779B97F4A7C15)  # fixed value: 2**64 / golden ratio
    h ^= vocabulary[codes % size]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h & ~np.uint64((1 << (64 - bits)) - 1)


def _blocks(buckets: int, block_tokens: int, bits: int):
    """Stage 1 in a task: texts -> lists for the buckets, and the texts as word numbers."""

    def run(batches: Iterator) -> Iterator:
        import re

        import numpy as np
        import pandas as pd
        import xxhash
        from pyspark import TaskContext

        word = re.compile(r"[^\x20\x09-\x0D]+").findall
        lower = {i: i + 32 for i in range(65, 91)}  # A-Z only
        hashes = word_hasher()
        end = np.uint64(xxhash.xxh64_intdigest("end", 1))
        task = TaskContext.get().partitionId()
        texts: dict[int, tuple[list, list]] = {TRAIN: ([], []), ESTIMATE: ([], []), TEST: ([], [])}
        held = dict.fromkeys(texts, 0)
        count = 0

        def settle(fold):
            nonlocal count
            arrays, ids = texts[fold]
            if not arrays:
                return
            block = (task << 24) | count
            count += 1
            lengths = np.array([len(a) for a in arrays])
            flat = np.concatenate(arrays)
            arrays.clear()
            vocabulary, tokens, n = np.unique(flat, return_inverse=True, return_counts=True)
            del flat
            size = len(vocabulary) + 1
            codes, m = np.unique(_codes(tokens, lengths, size), return_counts=True)
            hashed = _pair_hashes(codes, vocabulary, size, bits)
            order = np.argsort(hashed, kind="stable")
            rows = []
            for kind, keys, counts in ((WORDS, vocabulary, n), (PAIRS, hashed[order], m[order])):
                bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                cut = np.searchsorted(bucket, np.arange(buckets + 1).astype(np.uint64))
                for b in np.flatnonzero(np.diff(cut)):
                    lo, hi = cut[b], cut[b + 1]
                    body = [_numbers(_steps(keys[lo:hi]))]
                    if fold != TEST:
                        body.append(_numbers(counts[lo:hi]))
                    rows.append((int(b), block, kind, fold, _joined(body)))
            missing = np.array([i is None for i in ids])
            numbers = np.array([0 if i is None else i for i in ids], np.int64)
            body = [_numbers(x) for x in (tokens, lengths, numbers, missing)]
            rows.append((block % buckets, block, TEXTS, fold, _joined(body)))
            ids.clear()
            held[fold] = 0
            yield pd.DataFrame(rows, columns=NAMES)

        for pdf in batches:
            missing = pdf["doc"].isna().tolist()
            for doc, none, fold, text in zip(pdf["doc"].tolist(), missing, pdf["fold"].tolist(), pdf["text"].tolist()):
                t = text or ""
                w = word(t.lower() if t.isascii() else t.translate(lower))
                a = np.append(np.array(hashes(w), np.uint64), end)
                texts[fold][0].append(a)
                texts[fold][1].append(None if none else int(doc))
                held[fold] += len(a)
                if held[fold] >= block_tokens:
                    yield from settle(fold)
        for fold in texts:
            yield from settle(fold)

    return run


def _answer(batches: Iterator) -> Iterator:
    """Stage 2 in a task, rows sorted by (dest, kind): lists -> answers, in the order asked.

    Answers: counts in all training texts, for ESTIMATE blocks also without the held-out
    ones; lists of words come back with their hashes.
    """
    import numpy as np
    import pandas as pd

    for (dest, kind), pdf in groups(batches, ["dest", "kind"]):
        if kind == TEXTS:
            yield pdf[NAMES]
            continue
        lists = []
        for block, fold, payload in zip(pdf["block"], pdf["fold"], pdf["payload"]):
            body = _parts(payload)
            counts = _of_numbers(body[1]).astype(np.int64) if fold != TEST else None
            lists.append((block, fold, np.cumsum(_of_numbers(body[0]), dtype=np.uint64), counts, body[0]))
        learned = [x for x in lists if x[1] != TEST]
        every = np.unique(np.concatenate([x[2] for x in learned])) if learned else np.zeros(0, np.uint64)
        total, part = np.zeros(len(every) + 1, np.int64), np.zeros(len(every) + 1, np.int64)
        for _, fold, keys, counts, _ in learned:
            at = np.searchsorted(every, keys)
            np.add.at(total, at, counts)
            if fold == TRAIN:
                np.add.at(part, at, counts)
        rows = []
        for block, fold, keys, _, raw in lists:
            at = np.searchsorted(every, keys)
            at[np.append(every, np.uint64(0))[at] != keys] = len(every)  # unknown: the extra 0
            answers = [_numbers(total[at])]
            if fold == ESTIMATE:
                answers.append(_numbers(part[at]))
            rows.append((dest, block, kind, fold, _joined([*answers, *([raw] if kind == WORDS else [])])))
        if kind == WORDS:
            totals = [len(every), int((part > 0).sum()), int(total.sum()), int(part.sum())]
            rows.append((dest, -1, TOTALS, -1, _numbers(totals)))
        yield pd.DataFrame(rows, columns=NAMES)


def _assemble(bits: int):
    """Stage 3 in a task, rows sorted by (block, kind, dest): one row per block, self-contained."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for (block,), pdf in groups(batches, ["block"]):
            if block < 0:
                yield pdf[NAMES]
                continue
            kind, payload, fold = pdf["kind"].to_numpy(), pdf["payload"].tolist(), int(pdf["fold"].iloc[0])
            body = _parts(next(p for p, k in zip(payload, kind) if k == TEXTS))
            tokens, lengths = (_of_numbers(x).astype(np.int64) for x in body[:2])
            words = [_parts(p) for p, k in zip(payload, kind) if k == WORDS]
            pairs = [_parts(p) for p, k in zip(payload, kind) if k == PAIRS]
            vocabulary = np.concatenate([np.cumsum(_of_numbers(p[-1]), dtype=np.uint64) for p in words])
            size = len(vocabulary) + 1
            codes = np.unique(_codes(tokens, lengths, size))
            order = np.argsort(_pair_hashes(codes, vocabulary, size, bits), kind="stable")
            counts = []
            for i in range(2 if fold == ESTIMATE else 1):
                counts.append(np.concatenate([_of_numbers(p[i]) for p in words]))
                by_code = np.empty(len(codes), np.uint64)
                by_code[order] = np.concatenate([_of_numbers(p[i]) for p in pairs])
                counts.append(by_code)
            rows = [(0, block, TEXTS, fold, _joined([*body, *map(_numbers, counts)]))]
            yield pd.DataFrame(rows, columns=NAMES)

    return run


def _events(payload: bytes, which: int):
    """Per token c(w), c(v), c(v, w) as floats; lengths, ids, whether an id is null."""
    import numpy as np

    body = _parts(payload)
    tokens, lengths, ids, missing = (_of_numbers(x).astype(np.int64) for x in body[:4])
    words, pairs = (_of_numbers(x).astype(float) for x in body[4 + 2 * which : 6 + 2 * which])
    size = len(words) + 1
    codes, index = np.unique(_codes(tokens, lengths, size), return_inverse=True)
    # before a text's first word: as often as there are texts, that is, ends; every text ends with the end
    texts = words[tokens[-1]]
    context = np.append(words, texts)[codes // size][index]
    return words[tokens], context, pairs[index], lengths, ids, missing


def _bucket(context):
    """0 for an unseen context, else 1 + floor(log2 of its frequency), at most CONTEXTS - 1."""
    import numpy as np

    return np.minimum(np.frexp(context)[1], CONTEXTS - 1).astype(np.int64)


def _cells(tokens: float, kinds: float):
    """Held-out events of a block, counted by context bucket and ratios p1 / p0 and p2 / p0."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for pdf in batches:
            for payload in pdf["payload"]:
                word, context, pair, *_ = _events(payload, 1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    one = np.where(word > 0, np.round(CELLS * np.log2(word / tokens * (kinds + 1))), -999)
                    two = np.where(pair > 0, np.round(CELLS * np.log2(pair / context * (kinds + 1))), -999)
                key = np.stack((_bucket(context), one.astype(np.int64), two.astype(np.int64)))
                flat = (key[0] * 4096 + key[1] + 2048) * 4096 + key[2] + 2048
                cell, n = np.unique(flat, return_counts=True)
                yield pd.DataFrame({"cell": cell, "n": n})

    return run


def weights(cells: list[tuple[int, int]]):
    """EM: weights (CONTEXTS, 3) of the uniform, word and pair estimates.

    A bucket starts at, and is smoothed by 10 events of, what all buckets learn together.
    """
    import numpy as np

    start = np.array([0.05, 0.6, 0.35])
    if not cells:
        return np.tile(start, (CONTEXTS, 1))
    cell = np.array([c for c, _ in cells], np.int64)
    n = np.array([k for _, k in cells], float)
    bucket, one, two = cell // 4096**2, cell // 4096 % 4096 - 2048, cell % 4096 - 2048
    ratio = np.stack((np.ones(len(n)), *(np.where(x == -999, 0.0, 2.0 ** (x / CELLS)) for x in (one, two))), 1)

    def learn(at, size: int, first, prior):
        w = np.tile(first, (size, 1))
        for _ in range(ROUNDS):
            q = w[at] * ratio
            q *= (n / q.sum(1))[:, None]
            new = np.stack([np.bincount(at, q[:, k], minlength=size) for k in range(3)], 1) + prior
            w = new / new.sum(1, keepdims=True)
        return w

    overall = learn(np.zeros(len(n), np.int64), 1, start, 1e-9)[0]
    overall = np.maximum(overall, 1e-6) / np.maximum(overall, 1e-6).sum()
    return learn(bucket, CONTEXTS, overall, 10 * overall)


def _score(tokens: float, kinds: float, w):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for pdf in batches:
            for fold, payload in zip(pdf["fold"], pdf["payload"]):
                word, context, pair, lengths, ids, missing = _events(payload, 0)
                own = w[_bucket(context)]
                # an unseen context or word estimate leaves its weight to the others' share of the mixture
                p = own[:, 0] / (kinds + 1)
                if tokens:
                    p = p + own[:, 1] * word / tokens + own[:, 2] * pair / np.maximum(context, 1)
                base = np.log10((word + ADD) / (tokens + ADD * (kinds + 1)))
                starts = np.cumsum(lengths) - lengths
                out = pd.DataFrame(
                    {
                        "doc_id": pd.array(ids, "Int64"),
                        "held_out": fold == TEST,
                        "n_tokens": lengths,
                        "n_known": np.add.reduceat((word > 0).astype(np.int64), starts),
                        "train_tokens": int(tokens),
                        "base_score": np.add.reduceat(base, starts),
                        "score": np.add.reduceat(np.log10(p), starts),
                    }
                )
                out.loc[missing > 0, "doc_id"] = pd.NA
                yield out

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    A text is its words, A-Z lower-cased, and one end. It is learned from unless
    crc32(id) mod ``FOLDS`` is 0 (``held_out``). score: log10 probability of the text by
    the interpolated model; base_score: by add-``ADD`` word frequencies. A null text is
    empty (only the end); without training texts every word is as likely. A null id
    stays null. Whole texts are read. An empty table gives no rows. Other columns are ignored.
    """
    crc = remainder(id_col, FOLDS * ESTIMATE_FOLDS)
    fold = F.when(crc % FOLDS == 0, TEST).when(F.floor(crc / FOLDS) == 0, ESTIMATE).otherwise(TRAIN).cast("int")
    d = docs.select(F.col(id_col).cast("long").alias("doc"), fold.alias("fold"), F.col(text_col).alias("text"))
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 + int(chars // BUCKET_CHARS)
    bits = hash_bits(chars)
    asked = d.mapInPandas(_blocks(buckets, block_tokens, bits), ROW)
    answered = asked.repartition(buckets, "dest").sortWithinPartitions("dest", "kind", "block").mapInPandas(_answer, ROW)
    blocks = answered.repartition(buckets, "block").sortWithinPartitions("block", "kind", "dest").mapInPandas(_assemble(bits), ROW)
    blocks = staged(blocks, "lm")

    import numpy as np

    sums = np.zeros(4, np.int64)
    for r in blocks.where(F.col("kind") == TOTALS).select("payload").collect():  # a row per bucket, 4 numbers each
        sums += _of_numbers(bytes(r[0])).astype(np.int64)
    kinds, kinds_part, tokens, tokens_part = (float(x) for x in sums)
    texts = blocks.where(F.col("kind") == TEXTS)
    cells = []
    if tokens_part:
        held = texts.where(F.col("fold") == ESTIMATE).select("payload")
        found = held.mapInPandas(_cells(tokens_part, kinds_part), "cell long, n long")
        cells = [(r[0], r[1]) for r in found.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect()]  # bounded by the cells there are
    return texts.select("fold", "payload").mapInPandas(
        _score(tokens, kinds, weights(cells)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
