"""Mixing sources to target weights by Pareto order sampling (native Spark only).

Targets: the budget is shared by weight, no source above ``cap`` times its size,
the excess reshared by weight (solved in closed form over the sources sorted by
the level at which they are capped). A source's target over its size splits into
whole copies, which every document gets, and a fraction. The fraction is drawn as
a Pareto order sample: a document of size s has an inclusion probability
proportional to sqrt(s), and documents are ranked by random odds divided by
inclusion odds; probabilities of 1 or more come first. The sample's size is fixed
in words: it takes the ranked documents while they fit into the words left, then the
ranked rest of those documents that still fit, and so on until no document fits. That
is one walk through the ranks that passes over what does not fit. Every pass takes
one document of each source at least and passes over another, so passes end.

Running sums never sort a source in one task: ranks are cut into ``BUCKETS`` ranges,
summed per (source, range), and only inside a range rows are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
BUCKETS = 1024
PASSES = 3  # of the query op2_mixing, whose SQL has so many


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> + target. One row per source, windows over sources only."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(
        F.array(*[F.lit(int(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    )
    s = sizes.withColumn("w", w.cast("long")).withColumn("limit", F.lit(cap) * F.col("source_size"))
    level = (F.col("limit") / F.col("w")).alias("level")
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    before, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = (
        s.withColumn("level", level)
        .withColumn("used", F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("w_used", F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("words", F.lit(float(budget)) * F.sum("source_size").over(whole))
        .withColumn("w_all", F.sum("w").over(whole))
        .withColumn("capped", F.col("level") <= (F.col("words") - F.col("used")) / (F.col("w_all") - F.col("w_used")))
    )
    free = F.sum(F.when(~F.col("capped"), F.col("w"))).over(whole)
    taken = F.coalesce(F.sum(F.when(F.col("capped"), F.col("limit"))).over(whole), F.lit(0))
    share = F.col("w") * ((F.col("words") - taken) / free)
    return s.select("source", "source_size", F.when(F.col("capped"), F.col("limit").cast("double")).otherwise(share).alias("target"))


def _fit(rows: DataFrame) -> DataFrame:
    """Mark ``extra`` for the ranked documents that fit together into their source's ``room``; each of ``rows`` does alone."""
    inside = Window.partitionBy("source", "bucket").orderBy("rank", "doc_id", "size")
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("part"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("part").over(upto), F.lit(0)).alias("base")
    )
    rows = rows.withColumn("run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    rows = rows.withColumn("extra", F.col("base") + F.col("run") <= F.col("room")).drop("s", "b", "base", "run")
    return staged(rows, "mix")


def _fill(rows: DataFrame, passes: int | None) -> DataFrame:
    """Adds ``extra``: drawn in one of ``passes`` passes (None: as many as find a document that fits).

    A pass works on the documents that still fit; all others are settled.
    """
    fits = (F.col("size") > 0) & (F.col("size") <= F.col("room"))
    settled, done = [], 0
    while passes is None or done < passes:
        settled.append(rows.where(~fits).withColumn("extra", F.lit(False)))
        rows = rows.where(fits)
        if rows.isEmpty():
            break
        tried = _fit(rows)
        settled.append(tried.where("extra"))
        got = tried.where("extra").groupBy(F.col("source").alias("s")).agg(F.sum("size").alias("got"))
        rows = tried.where(~F.col("extra")).drop("extra").join(got, F.col("source").eqNullSafe(F.col("s")))
        rows = rows.withColumn("room", F.col("room") - F.col("got")).drop("s", "got")
        done += 1
    settled.append(rows.withColumn("extra", F.lit(False)))
    every = settled[0]
    for more in settled[1:]:
        every = every.unionByName(more)
    return every


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    budget: float = BUDGET,
    cap: int = CAP,
    seed: str = "mix",
    passes: int | None = None,
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, source, copies.

    size counts words (null text: 0); a null source is a source of its own, ranked
    last; documents without words are never drawn; copies is whole copies plus the
    drawn one, taken = copies * size, never over ``cap`` * size. Draws depend only on
    the seed and the id, so reruns agree; ties rank by id, then size, and repeated
    rows are interchangeable. An empty table gives no rows. Other columns are ignored.
    No undrawn document fits what is left of its source's words; with ``passes``, the
    draw ends after so many passes, even if some still fit.
    """
    base = staged(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
        ),
        "mix",
    )
    root = F.sqrt(F.col("size").cast("double"))
    per = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * root).alias("mass"))
    t = targets(per.select("source", "source_size"), weights, budget, cap)
    t = t.select(F.col("source").alias("s"), "source_size", "target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    per = (
        per.drop("source_size")
        .join(t, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("whole", whole)
        .withColumn("room", F.floor(F.col("target")).cast("long") - F.col("whole") * F.col("source_size"))
        .select("s", "source_size", "target", "whole", "room", "mass")
    )
    # 52 random bits of the id and seed, in (0, 1)
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10)
    u = (bits.cast("double") + 0.5) / F.lit(float(2**52))
    p = F.when(F.col("mass") > 0, F.col("room") * root / F.col("mass")).otherwise(0.0)
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    # in (-1, 0): certain; in (0, 1): odds / (1 + odds); in (1, 2): nothing to draw, only spread
    rank = F.when(F.col("p") >= 1, F.col("u") - 1).when(F.col("p") <= 0, F.col("u") + 1).otherwise(odds / (1 + odds))
    rows = (
        base.join(per, F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("u", u)
        .withColumn("p", p)
        .withColumn("rank", rank)
        .withColumn("bucket", F.floor(F.col("rank") * BUCKETS).cast("int"))
        .drop("u", "p", "mass")
    )
    rows = _fill(staged(rows, "mix"), passes)
    copies = (F.col("whole") + F.col("extra").cast("long")).alias("copies")
    return rows.select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), "source", copies
    )
