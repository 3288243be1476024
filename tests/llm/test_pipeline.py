"""The pipeline stage by stage, on a table with odd rows and an extra column."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratalake.llm.common import read_table, staged

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = read_table(spark, SF, "documents").withColumn("score", F.lit("extra"))
    odd = [(None, None, None, None, 0, "a"), (10**6, "", "en", None, 0, "b"), (3, "another text of id three", "en", "src1", 3, "c")]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF), "test"))
    return out


def test_columns_and_rows(steps):
    for before, after in zip(steps[:4], steps[1:5]):
        assert after.columns == before.columns
        rows = {tuple(r) for r in before.collect()}
        assert all(tuple(r) in rows for r in after.collect())


def test_decisions_take_effect(spark, steps):
    docs, good, known, single, mixed, packed = steps
    labels = read_table(spark, SF, "labels")
    junk = labels.where("quality = 0")
    assert good.join(junk, "doc_id").count() <= 0.1 * junk.count()
    clean = docs.join(labels.where("quality = 1"), "doc_id")
    assert good.join(clean, "doc_id", "left_semi").count() >= 0.97 * clean.count()
    assert known.count() >= 0.97 * good.where(F.col("text").rlike(r"\p{L}")).count()
    assert single.groupBy("text").count().where("count > 1").isEmpty()
    # id 3 has two texts that are not alike: a row stays or goes by its own text
    assert sorted(single.where("doc_id = 3").select("text").distinct().collect()) == sorted(known.where("doc_id = 3").select("text").distinct().collect())
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2
    tokens = packed.agg(F.sum("length")).first()[0]
    ends = mixed.count()  # every document ends with one id of its own
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"), F.sum((F.col("start") == 0).cast("int")).alias("k"))
    assert whole.where("n <> m * k").isEmpty() and whole.agg(F.sum("k")).first()[0] == ends and tokens > ends


def test_empty_documents(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "test")
        assert docs.count() == 0
        if "text" not in docs.columns:
            break
