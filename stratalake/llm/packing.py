"""Packing token sequences: bounded-space online best fit.

Each task keeps at most ``open_windows`` unfinished windows. A document's tokens
first fill whole windows of their own; the rest goes into the open window that it
fills best. When none fits and no more may be opened, the fullest window leaves;
if more than ``max_pad`` of it is still free, it is first filled with the head of
the document (documents may be cut anywhere). Windows still open when a task ends
are merged, a bounded number of tasks at a time, by the same rule; what is then
left over is laid end to end and cut into whole windows and powers of two, which
need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, by_bytes, expanded, forget_worker, hand_back, per_worker, staged, stretches, translated

WINDOW = 2048
OPEN_WINDOWS = 32
MAX_PAD = 16
MERGE_TASKS = 16
END_ID = 1
CACHE_WORDS = 340_000
CACHE_STEMS = CACHE_WORDS // 4
SLICE_BYTES = 1 << 18  # of text, tokenized at once (a longer text is tokenized whole)
HANDED_ROWS = 1000  # rows that a task hands over at once, or somewhat more
SPACES = bytes(32 if b == 10 else b for b in range(256))

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Best fit into a bounded number of open windows; calls ``emit`` with the pieces of a finished one."""

    def __init__(self, emit, window: int, open_windows: int, max_pad: int):
        self.emit, self.window, self.most, self.max_pad = emit, window, open_windows, max_pad
        self.open: list[tuple[list, list[int]]] = []  # pieces, [free]

    def add(self, doc_id, total: int, start: int, ids: bytes) -> None:  # 4 bytes an id
        pos, n = 0, len(ids) // 4
        while n - pos >= self.window:
            self.emit([(doc_id, total, start + pos, ids[4 * pos : 4 * (pos + self.window)])])
            pos += self.window
        while pos < n:
            need = n - pos
            best = min((i for i, w in enumerate(self.open) if w[1][0] >= need), key=lambda i: self.open[i][1][0], default=-1)
            if best < 0:
                if len(self.open) < self.most:
                    self.open.append(([], [self.window]))
                    best = len(self.open) - 1
                else:
                    best = min(range(len(self.open)), key=lambda i: self.open[i][1][0])
                    if self.open[best][1][0] <= self.max_pad:
                        self.emit(self.open.pop(best)[0])
                        continue
            pieces, free = self.open[best]
            take = min(need, free[0])
            pieces.append((doc_id, total, start + pos, ids[4 * pos : 4 * (pos + take)]))
            free[0] -= take
            pos += take
            if not free[0]:
                self.emit(self.open.pop(best)[0])

    def left(self) -> list:
        out = [w[0] for w in self.open]
        self.open = []
        return out


def tokenizer(path: str, cache_words: int = CACHE_WORDS, cache_stems: int = CACHE_STEMS):
    """texts (a list or Arrow strings) -> ids of each text as little-endian unsigned 32-bit, without special tokens.

    Spaces and line feeds separate tokens, so texts are encoded word by word, each
    distinct word of a batch once, and once altogether as long as it is remembered (about
    ``cache_words`` are, those met again before others). A word of Latin letters before
    ASCII punctuation is put together from the two if the tokenizer is byte-level, keeps
    them apart and ignores case (tried on samples first); any other word is encoded whole.
    Parts that are no words themselves are remembered apart (about ``cache_stems``).
    Lower-case Latin words go to the tokenizer's model at once, without normalisation.
    """
    import re

    import numpy as np
    import pyarrow as pa
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
    latin = re.compile(r"[a-zß-öø-ÿ]+").fullmatch
    # byte-level vocabularies write printable bytes as themselves, the others from U+0100 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    as_char = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}

    def whole(words: list[str]) -> list[list[int]]:
        return [e.ids for e in model.encode_batch_fast(words, add_special_tokens=False)]

    def flat(ids: list[list[int]]):
        return np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), np.uint32)

    def merged(w: str) -> list[int]:
        spelled = w if w.isascii() else "".join(map(as_char.__getitem__, w.encode()))
        return [t.id for t in model.model.tokenize(spelled)]

    def stems_made(stems: list[str]):
        rest = [s for s in stems if not (apart and latin(s))]
        ids = dict(zip(rest, whole(rest)))
        return flat([ids[s] if s in ids else merged(s) for s in stems])

    def split(w: str) -> tuple[str, str]:
        m = plain(w) if apart else None
        return (m[1].lower(), m[2]) if m else (w, "")

    def words_made(words: list[str]):
        parts = list(chain.from_iterable(map(split, words)))
        # a part that is a word, too, is split into itself and nothing: known already, or among the new words
        new, met, own, others = set(words), [], [], []
        for part in dict.fromkeys(parts):
            (met if part in known.row else own if part in new else others).append(part)
        at, met_many = known.expand(np.fromiter(map(known.row.__getitem__, met), np.int64, len(met)))
        made = [known.columns[0][at]] if len(at) else []
        own_many, ids = stems_made(own)
        made.append(ids)
        at, others_many = stems.expand(stems.rows(others))
        made += [stems.columns[0][at]] if len(at) else []
        ids, held = np.concatenate(made), np.concatenate([met_many, own_many, others_many])
        number = dict(zip(chain(met, own, others), range(len(held))))
        rows = np.fromiter(map(number.__getitem__, parts), np.int64, len(parts))
        places, many = expanded(np.cumsum(held) - held, held, rows)
        return many.reshape(-1, 2).sum(1), ids[places]

    tries = ["Abcxyz!!", "THE,", "zzqj$$$###", "Ing.)", "a", "It-&", "ÀÉñçßüÿ,", "éèêôíóúäöÜÑ"]
    apart = True
    stems, known = Remembered(stems_made, cache_stems), Remembered(words_made, cache_words)
    spelled = known.expand(known.rows(tries))[0]
    if known.columns[0][spelled].tolist() != list(chain.from_iterable(whole(tries))):
        apart = False
        stems, known = Remembered(stems_made, cache_stems), Remembered(words_made, cache_words)

    def encode(texts) -> list[bytes]:
        # separators alike, so that stretches between spaces are words
        texts = translated(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), SPACES)
        of_text, at, entries = stretches(texts)
        places, many = known.expand(known.rows(entries)[at])
        raw = known.columns[0][places].astype("<u4").tobytes() if len(places) else b""
        ends = 4 * np.concatenate([[0], np.cumsum(many)])[np.concatenate([[0], np.cumsum(of_text)])]
        return [raw[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    return encode


def _rows(pieces: list, sequence: int, keep_ids: bool):
    at = 0
    for doc_id, total, start, ids in pieces:
        n = len(ids) // 4
        row = (doc_id, start, n, zlib.crc32(ids), total, sequence, at)
        yield (*row, ids) if keep_ids else row
        at += n


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    max_pad: int = MAX_PAD,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ``ids``, little-endian unsigned 32-bit, if ``keep_ids``).

    A null text is empty (its only id is the end id); a null id stays null; repeated
    rows are packed each. Long texts are cut into windows; a task's memory is one batch of
    texts, what is made of ``SLICE_BYTES`` of them, the words its worker remembers and the
    open windows. An empty table gives no rows. Other columns are ignored.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = [c.split()[0] for c in PIECES.split(", ")]
    schema = PIECES + ", ids binary, task int, open boolean"

    def place(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are what runs side by side
        task = TaskContext.get().partitionId()
        encode = per_worker(("tokenizer", tokenizer_path), lambda: tokenizer(tokenizer_path))
        end = end_id.to_bytes(4, "little")
        types = [*[(n, pa.int64()) for n in names], ("ids", pa.binary()), ("open", pa.bool_())]
        rows: list = []
        count = [0]

        def emit(pieces):
            sequence = (task << 32) | count[0]
            count[0] += 1
            rows.extend((*r[:7], r[7] if keep_ids else None, False) for r in _rows(pieces, sequence, True))

        def table():
            made = {n: pa.array(c, t) for (n, t), c in zip(types, zip(*rows))}
            made["task"] = pa.array([task] * len(rows), pa.int32())
            rows.clear()
            return pa.RecordBatch.from_pydict({n: made[n] for n in [*names, "ids", "task", "open"]})

        packer = Packer(emit, window, open_windows, max_pad)
        try:
            for batch in batches:
                for part in by_bytes(batch, 1, SLICE_BYTES):
                    for doc_id, raw in zip(part.column(0).to_pylist(), encode(part.column(1))):
                        raw += end
                        packer.add(doc_id, len(raw) // 4, 0, raw)
                    if len(rows) >= HANDED_ROWS:
                        yield table()
                hand_back()
            for pieces in packer.left():
                rows.extend((*r, True) for r in _rows(pieces, (task << 32) | count[0], True))
                count[0] += 1
            if rows:
                yield table()
        finally:
            hand_back()

    def merge(key, pdf):
        import pandas as pd

        forget_worker()
        group = int(key[0])
        out: list = []
        count = [0]

        def emit(pieces):
            sequence = (1 << 62) | (group << 32) | count[0]
            count[0] += 1
            out.extend(_rows(pieces, sequence, True))

        pdf = pdf.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True])
        packer = Packer(emit, window, open_windows, max_pad)
        null = pdf["doc_id"].isna().to_numpy()
        for doc_id, missing, total, start, raw in zip(pdf["doc_id"], null, pdf["doc_tokens"], pdf["start"], pdf["ids"]):
            packer.add(None if missing else int(doc_id), int(total), int(start), raw)
        rest = [p for w in packer.left() for p in w]
        size = sum(len(p[3]) // 4 for p in rest)
        cuts = [window] * (size // window) + [1 << b for b in range(window.bit_length(), -1, -1) if size % window >> b & 1]
        seq: list = []
        room = cuts.pop(0) if cuts else 0
        for doc_id, total, start, ids in rest:
            pos = 0
            while pos < len(ids) // 4:
                take = min(room, len(ids) // 4 - pos)
                seq.append((doc_id, total, start + pos, ids[4 * pos : 4 * (pos + take)]))
                pos, room = pos + take, room - take
                if not room:
                    emit(seq)
                    seq, room = [], cuts.pop(0) if cuts else 0
        res = pd.DataFrame(out, columns=[*names, "ids"])
        res["doc_id"] = res["doc_id"].astype("Int64")
        return res

    placed = staged(d.mapInArrow(place, schema), "pack")
    done = placed.where(~F.col("open")).select(*names, "ids")
    rest = (
        placed.where("open")
        .withColumn("part", F.floor(F.col("task") / MERGE_TASKS))
        .groupBy("part")
        .applyInPandas(merge, PIECES + ", ids binary")
    )
    return done.unionByName(rest).select(*names, *(["ids"] if keep_ids else []))
