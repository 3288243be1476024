"""Corpus pipeline: documents -> packed training sequences, in stages.

Each stage works on all that the one before it kept and wrote, and drops or repeats
documents; all but the last return the columns of ``documents``, extra ones included.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm import jaccard, langid, mixing, packing
from stratalake.llm import quality as quality_op
from stratalake.llm.common import read_table, staged

#: Near copies have at least 80 % of their five-word shingles in common (the query op9_jaccard has its own numbers).
SHINGLE, PERCENT = 5, 80


def _plain(docs: DataFrame) -> tuple[DataFrame, list[str], dict[str, str]]:
    """``docs`` under plain column names (c0, c1, ...), its own names, and name -> plain name.

    So no name of the input, whatever it is, clashes with a column that a stage adds.
    """
    names = docs.columns
    return docs.toDF(*[f"c{i}" for i in range(len(names))]), names, {n: f"c{i}" for i, n in enumerate(names)}


def _named(plain: DataFrame, names: list[str]) -> DataFrame:
    return plain.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def _row_key(at: dict[str, str]) -> Column:
    """A 64-bit key of a row's id (of any type) and text; nulls count."""
    a, b = F.col(at["doc_id"]), F.col(at["text"])
    return F.xxhash64(a.isNull(), a.cast("string"), b.isNull(), b)


def _where(docs: DataFrame, judge: Callable[[DataFrame, str, list], DataFrame], stays: Column) -> DataFrame:
    """Rows of ``docs`` that ``judge`` (frame, text column, columns to keep) lets stay.

    Columns get plain names for the while, so that none clashes with what is added.
    """
    plain, names, at = _plain(docs)
    return _named(judge(plain, at["text"], plain.columns).where(stays), names)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network rejects go (null and empty texts are judged, too)."""
    weights = quality_op.learn(docs, read_table(spark, sf_dir, "labels"))
    return _where(docs, lambda d, text, keep: quality_op.score(d, weights, text, keep), F.col("predicted") == 1)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language that is told apart clearly go, as do texts without letters."""
    known = langid.learn(docs)
    return _where(docs, lambda d, text, keep: langid.identify(d, known, text, keep), F.col("reliable"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows (``SHINGLE``, ``PERCENT``) the one with the smallest id stays (null last).

    Rows are linked by their own texts, whatever their ids: rows of one id with different
    texts stay or go each for itself. Of rows equal in id and text one stays (ties in
    other columns: any). Rows without words are linked with nothing and all stay.
    """
    plain, names, at = _plain(docs)
    plain = plain.withColumn("key", _row_key(at))
    rows = plain.select("key", F.col(at["doc_id"]).alias("id"), F.col(at["text"]).alias("text"))
    groups = jaccard.link_groups(rows, id_col="key", shingle=SHINGLE, percent=PERCENT)
    groups = staged(groups.select(F.col("doc_id").alias("key"), F.col("component_id").alias("group"), "n_shingles"), "groups")
    # the few that are linked are joined, so that Spark may broadcast them if they are small
    linked = groups.where("key <> group").select("key", "group").distinct()
    linked = staged(linked.unionByName(linked.select(F.col("group").alias("key"), "group").distinct()), "linked")
    least = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    first = rows.select("key", "id").join(linked, "key").groupBy("group").agg(F.min(least).alias("first"))
    gone = linked.join(first, "group").where(F.col("key") != F.col("first.key")).select("key")
    gone = staged(gone, "gone")
    twice = staged(groups.where("n_shingles > 0").groupBy("key").count().where("count > 1").select("key"), "twice")
    kept = plain.join(gone, "key", "left_anti")
    if twice.isEmpty():
        return _named(kept, names)
    # equal rows: one of them; their number is counted in each task before the shuffle
    whole = F.struct(*[c for c in plain.columns if c != "key"])
    once = kept.join(twice, "key", "left_semi").groupBy("key").agg(F.any_value(whole).alias("row")).select("key", "row.*")
    return _named(kept.join(twice, "key", "left_anti").unionByName(once), names)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as many times as the mix takes it (not at all: it goes).

    Rows are known by id and text; of rows equal in both as many are repeated once more
    as were drawn. A null text has no words and is taken whole times only; a null source
    is a source of its own. No documents, no rows.
    """
    plain, names, at = _plain(docs)
    plain = plain.withColumn("key", _row_key(at))
    taken = mixing.mix(plain.select(F.col("key").alias("doc_id"), F.col(at["text"]).alias("text"), F.col(at["source"]).alias("source")))
    copies = taken.groupBy(F.col("doc_id").alias("key")).agg(
        F.min("copies").alias("low"), F.max("copies").alias("high"), F.sum("copies").alias("all"), F.count("*").alias("rows")
    )
    met = plain.join(copies.where("high > 0"), "key")
    # only rows equal in id and text can differ in copies, by the one that is drawn
    drawn = F.row_number().over(Window.partitionBy("key").orderBy("key")) <= F.col("all") - F.col("rows") * F.col("low")
    same = met.where("low = high").withColumn("times", F.col("high"))
    some = met.where("low < high").withColumn("times", F.col("low") + drawn.cast("long"))
    out = same.unionByName(some).where("times > 0")
    return _named(out.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))), names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents that are left."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: Networks, compression and tokenizers are beyond SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
