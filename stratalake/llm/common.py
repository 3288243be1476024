"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import scratch_path

#: Fixed value: a word is a run of code points other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, k: int) -> Column:
    """crc32 of the id as text, modulo k (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % F.lit(k)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage and lets several consumers share one computation; an executor
    lost later costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def groups(batches: Iterator, keys: list[str]) -> Iterator[tuple[tuple, object]]:
    """Whole groups of a stream of pandas batches sorted by ``keys``.

    Only the group that is open at a batch's end is carried over, so memory is one
    batch plus one group, and a group costs a slice instead of a call from the JVM.
    """
    import numpy as np
    import pandas as pd

    held: list = []
    held_key = None
    for pdf in batches:
        if not len(pdf):
            continue
        cols = [pdf[k].to_numpy() for k in keys]
        change = np.zeros(len(pdf), bool)
        change[0] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], len(pdf))
        for s, e in zip(starts, ends):
            key = tuple(c[s] for c in cols)
            part = pdf.iloc[s:e]
            if held and key == held_key:
                held.append(part)
                continue
            if held:
                yield held_key, held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            held, held_key = [part], key
    if held:
        yield held_key, held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): one row (node, comp) per
    node that has an edge, comp being the smallest node reachable.

    Alternating large-star / small-star steps; each is an aggregation with map-side
    minima and a join that adaptive execution may split, so a hub is not one task.
    Every round is checkpointed in the shared folder.
    """

    def state(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    # b < a in every edge from here on
    cur = (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
        .checkpoint()
    )
    before = state(cur)
    while before[0]:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.where(F.col("a") != F.col("b")).distinct()
        m = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where(F.col("a") != F.col("b")).unionByName(m.select("a", F.col("m").alias("b")))
        cur = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
        after = state(cur)
        if after == before:
            break
        before = after
    roots = cur.select(F.col("b").alias("node")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        roots.select("node", F.col("node").alias("comp"))
    )


#: A key counts as heavy if more than one in so many rows have it; so there are fewer heavy keys than this.
HEAVY = 1000


def join_unique(rows: DataFrame, unique: DataFrame, on: list[str], many: str, how: str) -> DataFrame:
    """``rows`` joined (inner or left) with a table that has each key once.

    Column ``many`` of ``unique`` says how many of the rows have its key. Heavy keys,
    fewer than ``HEAVY`` whatever the input, are joined by broadcast, the others by
    a shuffle in which none of them weighs much. ``unique`` should be narrow; both are read twice.
    """
    unique = staged(unique, "unique")
    total = unique.agg(F.sum(many)).first()[0] or 0
    heavy = F.col(many) > total / HEAVY
    few = unique.where(heavy)
    met = rows.join(F.broadcast(few), on)
    return met.unionByName(rows.join(F.broadcast(few.select(*on)), on, "left_anti").join(unique.where(~heavy), on, how))


def word_hasher(limit: int = 400_000) -> Callable[[list[str]], list[int]]:
    """64-bit hashes of words, remembered up to ``limit`` words (then forgotten, never wrong)."""
    import xxhash

    known: dict[str, int] = {}
    h64 = xxhash.xxh64_intdigest

    def hashes(words: list[str]) -> list[int]:
        got = list(map(known.get, words))
        if None in got:
            if len(known) > limit:
                known.clear()
            for i, x in enumerate(got):
                if x is None:
                    w = words[i]
                    got[i] = known[w] = h64(w.encode("utf-8", "surrogatepass"))
        return got

    return hashes


def per_worker(key, make: Callable):
    """What ``make`` returns, made once for each Python worker process (functions and
    their globals are unpickled for each task, so a module global would not last).

    A worker serves one operator after the other and keeps the last one's only, so what
    an operator remembers takes no memory from the next.
    """
    import sys
    import types

    kept = sys.modules.setdefault("_per_worker", types.ModuleType("_per_worker")).__dict__
    if kept.get("key") != key:
        forget_worker()
        kept["made"], kept["key"] = make(), key
    return kept["made"]


def forget_worker() -> None:
    """Drop what :func:`per_worker` has kept in this process and hand the memory back."""
    import gc
    import sys

    kept = getattr(sys.modules.get("_per_worker"), "__dict__", {})
    if kept.pop("key", None) is None:
        return
    kept.pop("made", None)
    gc.collect()
    hand_back()


def hand_back() -> None:
    """Give memory that this process has freed, but kept for itself, back to the system."""
    import ctypes
    import sys

    if sys.platform == "linux":
        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def tidy(run: Callable) -> Callable:
    """``run`` (batches -> batches) as a task that starts without what other operators
    remember and hands its memory back at its end.

    A worker outlives its task: while Spark joins, it would keep what its last task took.
    """

    def tidied(batches: Iterator) -> Iterator:
        forget_worker()
        try:
            yield from run(batches)
        finally:
            hand_back()

    return tidied


def map_texts(df: DataFrame, text_col: str, keep: list | None, make: Callable, added: str) -> DataFrame:
    """The ``keep`` columns, unchanged, and columns computed from the texts batch by batch.

    ``make()`` runs once in each task and returns a function from a list of texts
    (None for null) to one list per added column. Texts are handed over at most
    ``SLICE`` rows at a time; the text column itself is returned only if kept.
    """
    from pyspark.sql.types import StructType

    kept = df.select(*(keep or []))
    rows = kept if text_col in kept.columns else df.select(*(keep or []), text_col)
    names = kept.columns
    new = StructType.fromDDL(added)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        work = make()
        types = [(f.name, to_arrow_type(f.dataType)) for f in new.fields]
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                columns = [part.column(part.schema.get_field_index(n)) for n in names]
                made = work(part.column(part.schema.get_field_index(text_col)).to_pylist())
                columns += [pa.array(v, t) for v, (_, t) in zip(made, types)]
                yield pa.RecordBatch.from_arrays(columns, names + [n for n, _ in types])

    return rows.mapInArrow(tidy(run), StructType(kept.schema.fields + new.fields))


SLICE = 500


def expanded(first, held, rows):
    """Places of the rows' items, end to end, if row r has ``held[r]`` from ``first[r]`` on; and how many each has."""
    import numpy as np

    many = held[rows]
    return np.repeat(first[rows] - (np.cumsum(many) - many), many) + np.arange(many.sum()), many


class Remembered:
    """Arrays computed from words, remembered: each word's slice of one array per column.

    ``make(words)`` returns how many items each word has and the items of all of them,
    one array a column. When about ``limit`` words are held, those met in one batch only
    since the last time are forgotten, and of the others the least met beyond half the
    limit. A forgotten word is made again: memory is bounded, results never change.
    """

    def __init__(self, make: Callable, limit: int):
        self.make, self.limit = make, limit
        self.row: dict[str, int] = {}
        self.n = self.items = 0
        self.first = self.held = self.met = None
        self.columns: list = []

    def rows(self, words: list[str]):
        """Row numbers of distinct words, good until the next call."""
        import numpy as np

        got = list(map(self.row.get, words))
        new = [w for w, r in zip(words, got) if r is None]
        if new and self.n + len(new) > self.limit and self.n:
            self._forget()
            got = list(map(self.row.get, words))
            new = [w for w, r in zip(words, got) if r is None]
        if new:
            held, *columns = self.make(new)
            held = np.asarray(held, np.int64)
            if self.first is None:
                self.first, self.held, self.met = (np.zeros(0, t) for t in (np.int64, np.int64, np.int32))
                self.columns = [c[:0] for c in columns]
            first = self.items + np.cumsum(held) - held
            self.first, self.held = self._put(self.first, first, self.n), self._put(self.held, held, self.n)
            self.met = self._put(self.met, np.zeros(len(new), np.int32), self.n)
            self.columns = [self._put(old, c, self.items) for old, c in zip(self.columns, columns)]
            self.row.update(zip(new, range(self.n, self.n + len(new))))
            numbers = iter(range(self.n, self.n + len(new)))
            got = [next(numbers) if r is None else r for r in got]
            self.n, self.items = self.n + len(new), self.items + int(held.sum())
        rows = np.array(got, np.int64)
        if len(rows):
            self.met[rows] += 1
        return rows

    def expand(self, rows):
        """Items of the rows, end to end: their places in ``columns``; and how many each has."""
        import numpy as np

        if self.first is None or not len(rows):
            return np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
        return expanded(self.first, self.held, rows)

    @staticmethod
    def _put(old, new, at: int):
        import numpy as np

        if at + len(new) > len(old):
            grown = np.zeros(max(2 * len(old), at + len(new)), old.dtype)
            grown[:at] = old[:at]
            old = grown
        old[at : at + len(new)] = new
        return old

    def _forget(self) -> None:
        import numpy as np

        met = self.met[: self.n]
        keep = np.flatnonzero(met > 1)
        if len(keep) > self.limit // 2:
            most = np.argpartition(-met[keep], self.limit // 2)[: self.limit // 2]
            keep = np.sort(keep[most])
        words = list(self.row)
        items, held = self.expand(keep)
        self.columns = [c[items] for c in self.columns]
        self.first, self.held = np.cumsum(held) - held, held
        self.met = np.zeros(len(keep), np.int32)
        self.row.clear()  # before the new one is built
        self.row = {words[r]: i for i, r in enumerate(keep.tolist())}
        self.n, self.items = len(keep), len(items)


def translated(texts, table: bytes):
    """Arrow strings with each byte replaced by ``table`` (null: empty)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = data.slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes() if data is not None else b""
    return pa.Array.from_buffers(
        pa.large_string(), len(texts), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(raw.translate(table))]
    )


def stretches(texts):
    """Arrow strings cut at spaces: how many stretches each has (empty ones included),
    the number of each stretch among the distinct ones, and these."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    cut = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), " ")
    flat = pc.dictionary_encode(cut.flatten())
    return np.diff(np.asarray(cut.offsets)), np.asarray(flat.indices), flat.dictionary.to_numpy(zero_copy_only=False).tolist()


def by_bytes(batch, column: int, most: int) -> Iterator:
    """Slices of a batch that hold about ``most`` bytes of text each (a longer text is alone or last)."""
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // most)) + 1).tolist(), batch.num_rows]
    for at, to in zip(cuts, cuts[1:]):
        yield batch.slice(at, to - at)
