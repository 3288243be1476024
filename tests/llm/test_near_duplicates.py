"""The pipeline's near-duplicate stage against brute force: five words, 80 %."""

import random

import corpus_pipeline

from .test_jaccard import shingles, variants


def stays(rows):
    """Of each group linked at five words and 80 % the smallest id."""
    first = {i: i for i, _ in rows}
    sets = [(i, shingles(t, 5)) for i, t in rows]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if a and b and 100 * both >= 80 * (len(a) + len(b) - both) and first[i] != first[j]:
                low, high = sorted((first[i], first[j]))
                first = {k: low if v == high else v for k, v in first.items()}
    return sorted(i for i, v in first.items() if i == v)


def test_stage_against_brute_force(spark):
    r = random.Random(3)
    texts = []
    for n in (4, 5, 9, 25, 60, 100, 300):
        base = [f"w{r.randrange(3000)}" for _ in range(n)]
        texts += variants(r, base, 8, max(1, n // 20))
        # blocks of 15 to 28 % of the length at the end
        texts += [" ".join(base + [f"b{r.randrange(9999)}" for _ in range(n * k // 100)]) for k in range(15, 29)]
    texts += [None, "", "a b", "A b"]
    r.shuffle(texts)
    rows = [(i * 2 + 1, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, source string").repartition(4)
    got = corpus_pipeline.near_duplicates(spark, docs, None)
    assert got.columns == docs.columns
    assert sorted(x["doc_id"] for x in got.collect()) == stays(rows)


def test_appended_block_is_a_near_copy(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(words + [f"b{i}" for i in range(20)])), (3, " ".join(words + [f"c{i}" for i in range(30)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x["doc_id"] for x in corpus_pipeline.near_duplicates(spark, docs, None).collect()) == [1, 3]
