"""Order MinHash fingerprints of documents (native Spark only).

A text is cut into pieces: runs of at most ``PIECE`` code points without ASCII white
space. Its k-mers are runs of ``K`` pieces, each numbered among its equals (first
occurrence 0, second 1, ...), so repeats count. A hash of (k-mer, number) deals the
numbered k-mers into ``BINS`` bins; in each bin the ``L`` smallest are selected, put
back into text order, and hashed as a tuple. The fingerprint is the list of the
tuples' hashes, one per bin that has k-mers; likeness is the share of bins, of those
filled in either text, whose tuples agree. Order matters inside a tuple, so the
likeness follows the edit distance rather than the mere overlap.

Everything happens inside a row, on arrays: no k-mer is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 3
L = 2
BINS = 64
PIECE = 16
RANGES_A_PARTITION = 4  # ranges of ids for each shuffle partition
MOST_RANGES = 2000


#: A long holds the upper 40 bits of a hash and, below, a position modulo 2**24; so sorting
#: plain longs keeps both together. The upper 6 bits (signed) are the bin: BINS = 64.
AT_BITS = 24
AT = (1 << AT_BITS) - 1


def _bin(x: Column) -> Column:
    return F.shiftright(x, 58)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _with(hash_: Column, at: Column) -> Column:
    return hash_.bitwiseAND(F.lit(~AT)).bitwiseOR(at)


def _get(array: Column, i: Column) -> Column:
    return F.get(array, i)


def signature(text: Column) -> Column:
    """array<bigint>, one tuple hash per filled bin in bin order; its upper 6 bits are the bin.

    A text of fewer than ``K`` pieces has one k-mer, all of it; one without pieces
    (null, empty, white space) the one k-mer ''. K-mers are told apart by 40 bits.
    """
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]{1,%d}" % PIECE), F.lit(0))
    return _let(pieces, lambda p: _let(_kmers(p), lambda s: _let(F.sort_array(_numbered(s)), _tuples)))


def _kmers(p: Column) -> Column:
    """Hashes of k-mers with their positions, sorted: equal k-mers lie together, first occurrence first."""
    n = F.size(p)
    long_enough = _let(
        F.transform(p, lambda x: F.xxhash64(x)),
        lambda h: F.transform(
            F.sequence(F.lit(0), n - K),
            lambda i: _with(F.xxhash64(*[_get(h, i + j if j else i) for j in range(K)]), i.bitwiseAND(F.lit(AT))),
        ),
    )
    only = F.array(_with(F.xxhash64(F.array_join(p, " ")), F.lit(0)))
    return F.sort_array(F.when(n < K, only).otherwise(long_enough))


def _numbered(s: Column) -> Column:
    """Hashes of (k-mer, number among its equals) with their positions."""
    n = F.size(s)
    kmer = lambda x: F.shiftright(x, AT_BITS)
    first = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (kmer(_get(s, i)) != kmer(_get(s, i - 1))))
    number = lambda x, o: _with(F.xxhash64(kmer(x), o), x.bitwiseAND(F.lit(AT)))
    # without repeats, the usual case of short texts, every number is 0
    return _let(
        first,
        lambda b: F.when(F.size(b) == n, F.transform(s, lambda x: number(x, F.lit(0)))).otherwise(
            F.flatten(
                F.transform(
                    b,
                    lambda lo, j: _let(
                        F.coalesce(_get(b, j + 1), n) - lo,
                        lambda times: F.when(times == 1, F.array(number(_get(s, lo), F.lit(0)))).otherwise(
                            F.transform(F.slice(s, lo + 1, times), number)
                        ),
                    ),
                )
            )
        ),
    )


def _tuples(v: Column) -> Column:
    """From sorted hashes: in every bin the ``L`` smallest, in text order, hashed together."""
    small = F.filter(v, lambda x, i: (i < L) | (_bin(x) != _bin(_get(v, i - L))))

    def of_bins(s: Column) -> Column:
        heads = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (_bin(_get(s, i)) != _bin(_get(s, i - 1)))
        )

        def one(i: Column) -> Column:
            chosen = F.filter(F.slice(s, i + 1, L), lambda x: _bin(x) == _bin(_get(s, i)))
            # position in the upper bits orders them by text; rotated, a long stays unique
            ordered = F.sort_array(
                F.transform(
                    chosen, lambda x: F.shiftleft(x, 64 - AT_BITS).bitwiseOR(F.shiftrightunsigned(x, AT_BITS))
                )
            )
            tuple_hash = F.xxhash64(F.transform(ordered, lambda x: x.bitwiseAND(F.lit((1 << (64 - AT_BITS)) - 1))))
            return F.shiftleft(_bin(_get(s, i)), 58).bitwiseOR(F.shiftrightunsigned(tuple_hash, 6))

        return F.transform(heads, one)

    return _let(small, of_bins)


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins filled in either signature that agree, 0 to 1."""
    filled = F.size(F.array_distinct(F.concat(F.transform(a, _bin), F.transform(b, _bin))))
    return F.size(F.array_intersect(a, b)) / filled


def as_text(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, signature (array<bigint>), fingerprint (hex text): one row per input row.

    Null texts are empty; equal texts have equal fingerprints. Other columns are ignored.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return d.select("doc_id", F.length("text").cast("long").alias("n_chars"), signature(F.col("text")).alias("signature")).withColumn(
        "fingerprint", as_text(F.col("signature"))
    )


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints every text and the text that results when its last floor(n/2) code
    points are replaced by the first as many (or all) of the next document by ascending
    id (after the last: the first); adds the likeness to that and to the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next; one row per input row. Null texts are empty, null ids come
    first, rows of one id are ordered by text; a single row is its own next. An empty
    table gives no rows. Other columns are ignored.

    Ids are cut into ranges at approximate quantiles. A range is ordered within one
    task; the first text of each range is handed to the last row of the range before.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = min(RANGES_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    cuts = d.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
    cuts = sorted(set(cuts or []))
    if cuts:
        part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("doc_id")))
    else:
        part = F.lit(0)
    d = d.withColumn("part", part)

    # the first row of every range, and to which range before it that is the next row
    ids = d.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("low"))
    order = Window.orderBy("part")
    before = F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy()))
    ids = ids.select("part", F.col("low.doc_id").alias("doc_id"), before.alias("to"))
    same = d["doc_id"].eqNullSafe(ids["doc_id"]) & (d["part"] == ids["part"])
    heads = d.join(F.broadcast(ids), same).groupBy("to").agg(F.min(d["text"]).alias("head"))  # one row per range

    rows = d.repartition("part").withColumn("signature", signature(F.col("text")))
    ranked = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    rows = rows.withColumn("next", F.lead(F.struct("text", "signature")).over(ranked))
    rows = rows.join(heads, (F.col("part") == F.col("to")) & F.col("next").isNull(), "left")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("next_text", F.coalesce(F.col("next.text"), F.col("head")))
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "signature",
        F.when(F.col("next").isNull(), signature(F.col("head"))).otherwise(F.col("next.signature")).alias("next_signature"),
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"),
    )
    rows = rows.withColumn("edited_signature", signature(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
