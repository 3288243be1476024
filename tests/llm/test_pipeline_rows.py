"""Stages that link and repeat rows: by their texts, whatever their ids and the names of extra columns."""

import random
from collections import Counter

import corpus_pipeline
from stratalake.llm import quality

CLASH = ["_key", "_copy", "_copies", "_n_of_id", "key", "group", "first", "times", "c0", "low", "row", "id"]


def words(seed, n=40):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


def frame(spark, rows):
    rows = [(i, t, s, *(f"{c}-{k}" for c in CLASH)) for k, (i, t, s) in enumerate(rows)]
    return spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", "source string", *(f"`{c}` string" for c in CLASH)])).repartition(3)


def test_rows_are_linked_by_their_texts(spark):
    a, b, c, d, e = (words(i) for i in range(5))
    near = a + " one"
    rows = [
        (1, a, "x"), (1, b, "x"),  # one id, two texts: both stay
        (5, near, "x"), (None, a, "x"), (None, a, "x"),  # near and exact copies of id 1's
        (None, c, "x"), (None, c, "x"), (None, d, "x"),  # without ids: one of the copies stays
        (7, e, "x"), (7, e, "x"), (9, b.upper(), "x"),
        (None, None, "x"), (None, None, "x"), (8, "", "x"), (8, " ", "x"),  # no words: nothing is linked
    ]
    df = frame(spark, rows)
    got = corpus_pipeline.near_duplicates(spark, df, None)
    assert got.columns == df.columns
    kept = got.collect()
    given = {tuple(r) for r in df.collect()}
    assert all(tuple(r) in given for r in kept)  # extra columns as they were
    want = [(1, a), (1, b), (None, c), (None, d), (7, e), (None, None), (None, None), (8, ""), (8, " ")]
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter(want)


def test_mix_keeps_columns_and_counts(spark):
    rows = [(i, words(i, 3 + i % 9), "abc"[i % 3]) for i in range(60)] + [(3, words(3, 6), "a")] * 4 + [(None, None, None), (None, "q r", None), (None, "q r", None)]
    df = frame(spark, rows)
    kept = corpus_pipeline.mix(spark, df, None)
    assert kept.columns == df.columns
    given = {tuple(r) for r in df.collect()}
    got = Counter(tuple(r) for r in kept.collect())
    assert set(got) <= given and max(got.values()) <= 2
    # as many words as the operator takes
    from stratalake.llm import mixing

    keyed = df.select(corpus_pipeline._row_key({"doc_id": "doc_id", "text": "text"}).alias("doc_id"), "text", "source")
    taken = sum(r["taken"] for r in mixing.mix(keyed).collect())
    assert sum(n * len((r[1] or "").split()) for r, n in got.items()) == taken


def test_text_ids(spark):
    df = spark.createDataFrame([("a1", words(1), "x"), ("b2", words(1), "x"), (None, words(2), "y")], "doc_id string, text string, source string")
    assert sorted(str(r["doc_id"]) for r in corpus_pipeline.near_duplicates(spark, df, None).collect()) == ["None", "a1"]
    assert corpus_pipeline.mix(spark, df, None).columns == df.columns


def test_labels_without_documents_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "x") for i in range(40)] + [(900, None, "x"), (901, "z" * 70_000, "x")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(i, i % 2) for i in range(1000, 9000)] + [(900, 1), (901, 1)], "doc_id long, quality int")
    texts, y, share = quality.sample(docs, labels, "quality", "doc_id", "text", 20, 1000)
    from zlib import crc32

    learnt = [i for i in range(40) if crc32(str(i).encode()) % 5]
    assert len(texts) == len(learnt) and max(map(len, texts)) <= 1000
    assert abs(share - sum(i % 2 for i in learnt) / len(learnt)) < 1e-9 and sum(y) == sum(i % 2 for i in learnt)
