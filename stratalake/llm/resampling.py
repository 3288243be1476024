"""Importance resampling towards a target distribution: hashed n-grams of words.

Texts are ASCII-lowered and cut into words with their offsets by an untrained
pre-tokenizer (a ``Split`` on a regular expression). A feature is a window of offsets:
the run from one word's start to the end of the same or a following word, its words
joined by one space. Features fall into buckets by the CRC-32 of their UTF-8 bytes. What
the raw texts and the target texts hold of each bucket gives the bucket's gain, a
document's weight is the mean gain of its features, and the documents with the highest
sums of weight and Gumbel noise (a hash of the id) are drawn, without replacement.

Each text is cut once: its bucket numbers are written to the shared folder (two bytes a
feature) and serve the histogram and the gains. A histogram has as many rows as there
are buckets. Ranks need no global sort: scores are whole numbers within a range that
the logarithms bound, so a histogram of scores (at most about 120,000 rows) says how
many documents lie above each score, and only documents of one score are ordered among
themselves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Remembered, by_bytes, per_worker, staged, stretches, translated

#: Fixed value: a word is a run of code points other than ASCII ones that are no digits or lower-case letters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
RUNS = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Longest word, in UTF-8 bytes, whose checksum is appended by table.
TABLED = 64
#: Bytes of text that are cut at a time, stretches given to the pre-tokenizer at a time, stretches remembered.
SLICE_BYTES = 4_000_000
JOINED = 1000
MEMORY = 500_000

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def splitter():
    """ASCII-lowered text -> [(word, (start, end))], offsets in code points."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True).pre_tokenize_str


def shift_tables():
    """tables[n][k][v]: the CRC-32 register ``v << 8k`` after n zero bytes."""
    import numpy as np

    v = np.arange(256, dtype=np.uint32)
    byte = np.array([zlib.crc32(bytes([b ^ 255])) ^ 0xFF000000 for b in range(256)], np.uint32)
    tables = [np.stack([v << np.uint32(8 * k) for k in range(4)])]
    for _ in range(TABLED + 1):
        last = tables[-1]
        tables.append((last >> np.uint32(8)) ^ byte[last & np.uint32(255)])
    return np.stack(tables)


def cutter(runs: int = RUNS, buckets: int = BUCKETS, memory: int = MEMORY):
    """Arrow array of texts -> (words, features, bucket numbers) with one count a text;
    the bucket numbers of all texts lie end to end.

    A word holds no space, so a text's words are those of its space-free stretches; equal
    stretches go through the pre-tokenizer once as long as they are remembered. The
    checksum of a run follows from that of the run without its last word, as CRC-32 is linear.
    """
    from itertools import repeat

    import numpy as np

    split, tables, space = splitter(), shift_tables(), zlib.crc32(b" ")
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def made(entries: list[str]):
        held, spelled = [], []
        for at in range(0, len(entries), JOINED):
            some = entries[at : at + JOINED]
            found = split("\n".join(some))
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1)
            starts = np.fromiter((o[0] for _, o in found), np.int64, len(found))
            held.append(np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(some)))
            spelled += " ".join([w for w, _ in found]).encode().split(b" ") if found else []
        numbers = lambda values, t: np.fromiter(values, t, len(spelled))
        # per word: bytes, checksum, checksum after a space; long words are spelled out beside
        long = np.array([w if len(w) > TABLED else None for w in spelled], object)
        return (
            np.concatenate(held), numbers(map(len, spelled), np.int32), numbers(map(zlib.crc32, spelled), np.uint32),
            numbers(map(zlib.crc32, spelled, repeat(space)), np.uint32), long,
        )

    known = Remembered(made, memory)

    def cut(texts):
        n = len(texts)
        of_text, at, entries = stretches(texts)
        word, many = known.expand(known.rows(entries)[at])
        if not len(word):
            return np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(0, kind)
        size, crc, after_space, long = (c[word] for c in known.columns)
        text = np.repeat(np.repeat(np.arange(n), of_text), many)
        got = np.zeros((len(word), runs), kind)
        real = np.zeros((len(word), runs), bool)
        run = crc  # checksum of the run that starts at each word
        for k in range(min(runs, len(word))):
            if k:
                was, more = run[:-1], np.minimum(size[k:] + 1, TABLED + 1)
                run = (
                    tables[more, 0, was & 255] ^ tables[more, 1, was >> 8 & 255]
                    ^ tables[more, 2, was >> 16 & 255] ^ tables[more, 3, was >> 24] ^ after_space[k:]
                )
                for i in np.flatnonzero(size[k:] > TABLED).tolist():
                    run[i] = zlib.crc32(long[k + i], zlib.crc32(b" ", int(was[i])))
            m = len(run)
            got[:m, k] = run % np.uint32(buckets)
            real[:m, k] = text[:m] == text[k:]
        features = np.bincount(text, weights=real.sum(1), minlength=n).astype(np.int64)
        return np.bincount(text, minlength=n), features, got[real]

    return cut


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = RUNS, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features and ``features`` (little-endian unsigned bucket numbers).

    A null text has none. The rows keep their order and repeats; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        cut = per_worker(("cutter", runs, buckets), lambda: cutter(runs, buckets))
        for batch in batches:
            for part in by_bytes(batch, 1, SLICE_BYTES):
                words, many, got = cut(translated(part.column(1), LOWER))
                ends = np.concatenate([[0], np.cumsum(many) * got.itemsize])
                packed = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(got)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words, pa.int64()), pa.array(many, pa.int64()), packed.cast(pa.binary())],
                    ["doc_id", "n_words", "n_features", "features"],
                )

    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, features binary")


def _numbers(packed, kind):
    """All numbers of a binary array, and where each row's end."""
    import numpy as np

    ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    data = packed.buffers()[2]
    raw = memoryview(data)[ends[0] : ends[-1]] if data is not None else b""
    return np.frombuffer(raw, kind), (ends - ends[0]) // kind().itemsize


def histogram(cut: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n over the rows of :func:`features`; a task sends one row a bucket at most."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        kind = np.uint16 if buckets <= 1 << 16 else np.uint32
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0), kind)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])

    return cut.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: floor(1000 ln(P/Q)) of the add-one shares of a bucket in target (P) and raw (Q) features."""
    spark = raw.sparkSession
    both = (
        spark.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(raw.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .fillna(0, ["s", "t"])
    )
    all_s, all_t = (F.sum(c).over(Window.partitionBy()) for c in ("s", "t"))
    ratio = ((F.col("t") + 1).cast("double") * (all_s + buckets)) / ((F.col("s") + 1).cast("double") * (all_t + buckets))
    return both.select("bucket", F.floor(1000 * F.ln(ratio)).cast("long").alias("gain"))


def noise(id_col: str, seed: int = SEED) -> Column:
    """Whole thousandths of Gumbel noise from a hash of the id (a null id counts as the empty text)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.ln(-F.ln((h.cast("double") + 0.5) / F.lit(4294967296.0)))).cast("long")


def weigh(cut: DataFrame, gain: list[int]) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean gain of a row's features (none: 0)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table = np.array(gain, np.int64)
        kind = np.uint16 if len(table) <= 1 << 16 else np.uint32
        for batch in batches:
            numbers, ends = _numbers(batch.column(3), kind)
            sums = np.concatenate([[0], np.cumsum(table[numbers])])[ends]
            many = np.diff(ends)
            weight = np.where(many > 0, np.diff(sums) // np.maximum(many, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    schema = "doc_id long, n_words long, n_features long, weight long"
    return cut.select("doc_id", "n_words", "n_features", "features").mapInArrow(run, schema)


def draw(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """Adds ``rank`` to the ``percent`` % highest scores of the rows with ``least_words`` (rounded down; others null).

    Ties go to the smaller doc_id (null last), then to the larger weight; of rows equal
    in these each has a rank of its own.
    """
    able = F.col("n_words") >= least_words
    levels = scored.where(able).groupBy("score").agg(F.count("*").alias("many"))
    # one row a score: whole numbers between the logarithms of 64-bit counts, so few, whatever the input
    higher = Window.orderBy(F.col("score").desc())
    above = F.sum("many").over(higher.rowsBetween(Window.unboundedPreceding, 0)) - F.col("many")
    most = F.floor(F.sum("many").over(Window.partitionBy()) * percent / 100)
    levels = levels.select(F.col("score").alias("level"), above.alias("above"), most.cast("long").alias("most")).where("above < most")
    met = scored.join(F.broadcast(levels), able & (F.col("score") == F.col("level")), "left").drop("level")
    here = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), "n_features")
    rank = F.col("above") + F.row_number().over(here)
    drawn = met.where(F.col("above").isNotNull()).withColumn("rank", F.when(rank <= F.col("most"), rank).cast("long"))
    rest = met.where(F.col("above").isNull()).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("above", "most")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    runs: int = RUNS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null: not drawn), n_words.

    Null and empty texts have no features and weight 0; repeated rows count and are drawn
    each; a null id is noise of its own. An empty table gives no rows, an empty target
    gains from the raw texts alone. Other columns are ignored. Ids must be whole numbers.
    """
    cut = staged(features(docs, id_col, text_col, runs, buckets), "resample-features")
    wanted = features(target.withColumn("_no_id", F.lit(None).cast("long")), "_no_id", target_text, runs, buckets)
    found = gains(histogram(cut, buckets), histogram(wanted, buckets), buckets).orderBy("bucket").collect()  # one row a bucket
    scored = weigh(cut, [r["gain"] for r in found]).withColumn("score", F.col("weight") + noise("doc_id", seed))
    return draw(staged(scored, "resample-scores"), least_words, percent).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


#: Words by regular expression, checksums bit by bit.
SQL = """
WITH tbl AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(256))::BIGINT AS i))),
txt AS (
  SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
d AS (
  SELECT row_number() OVER () AS row, side, doc_id, CASE WHEN text IS NULL THEN [] ELSE
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') END AS w
  FROM txt),
f AS (
  SELECT row, side, unnest(w) AS feature FROM d
  UNION ALL SELECT row, side, unnest(list_transform(range(1, len(w)::BIGINT), lambda i: w[i] || ' ' || w[i + 1])) FROM d),
u AS (SELECT DISTINCT feature FROM f),
b AS (
  SELECT feature, xor(list_reduce([4294967295::BIGINT] ||
      list_transform(range(1, strlen(feature) + 1), lambda i: ('0x' || substr(hex(encode(feature)), 2 * i - 1, 2))::BIGINT),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM u, tbl),
h AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN b USING (feature) GROUP BY 1),
g AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM h),
m AS (SELECT row, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN b USING (feature) JOIN g USING (bucket) WHERE side = 0 GROUP BY 1),
s AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN m USING (row) WHERE side = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
    floor(25 * count(*) FILTER (n_words >= 20) OVER () / 100)::BIGINT AS most
  FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= most THEN place END AS rank, n_words FROM r
"""
