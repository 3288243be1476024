"""Neighbour search against brute force: recall, exact scores, ties, odd vectors."""

import numpy as np
from pyspark.sql import functions as F

from stratalake.llm import neighbours
from stratalake.llm.common import read_table

SCHEMA = "vec_id long, embedding array<float>, rank string"


def brute(rows, ids, k=10):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    x, names = np.stack([v for _, v in good]), np.array([i for i, _ in good])
    out = {}
    for q in ids:
        if q in names:
            d = np.sqrt(((x - x[list(names).index(q)]) ** 2).sum(1))
            d[names == q] = np.inf
            order = np.lexsort((names, d))
            out[q] = [(int(names[j]), d[j]) for j in order[:k] if d[j] < np.inf]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA).repartition(3)
    out: dict = {}
    for r in neighbours.search(df, df.where("vec_id % 100 = 0"), **kw).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_odd_vectors_and_ties_exact(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(v) for v in r.normal(size=4)]) for i in range(150)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 330)]  # ties go to smaller ids
    rows += [(400, None), (401, [0.0] * 4), (402, [1.0, None, 1.0, 1.0]), (403, [float("nan")] * 4), (404, [float("inf")] * 4), (None, [1.0] * 4), (500, [1.0, 2.0])]
    want = brute([(i, v) for i, v in rows if v is None or len(v) == 4], [0, 100, 200, 300])
    got = run(spark, rows)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    for q in got:
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-14, atol=0)


def test_few_rows_and_empty_table(spark):
    assert run(spark, []) == {}
    assert run(spark, [(100, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]) == {100: [(2, 1.0), (1, np.sqrt(2.0))]}
    assert run(spark, [(100, [1.0, 0.0])]) == {}


def big(rows, ids, k=10):
    """Brute force by math.dist, which does not overflow."""
    import math

    return {q: sorted((math.dist(v, dict(rows)[q]), i) for i, v in rows if i != q)[:k] for q in ids}


def test_very_large_and_very_small_vectors(spark):
    r = np.random.default_rng(7)
    rows = [(i, [float(v) * 1e200 for v in r.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, [float(v) * 1e-200 for v in r.normal(size=6)]) for i in range(120)]
    rows += [(400 + i, [float(v) for v in r.normal(size=6)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got: dict = {}
    for x in neighbours.search(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(x["query_id"], []).append((x["score"], x["vec_id"]))
    want = big(rows, [0, 100, 200, 300, 400, 500])
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9
    near = dict(rows)
    for q, found in got.items():
        assert np.allclose([s for s, _ in found], [big([(i, near[i]), (q, near[q])], [q])[q][0][0] for _, i in found], rtol=1e-12, atol=0)


def test_small_tables_are_partitioned_too():
    r = np.random.default_rng(8)
    for n in (2, 3, 20, 300):
        router, probes = neighbours.fit(r.normal(size=(n, 4)), 2, 10)
        assert router is not None and router.ranked(np.ones((1, 4))).shape == (1, 2) and probes in (1, 2)
    assert neighbours.fit(np.ones((50, 4)), 2, 10) == (None, 1)


def test_many_partitions_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 3)
    r = np.random.default_rng(2)
    centres = r.normal(size=(30, 16)) * 3
    rows = [(i, [float(v) for v in centres[i % 30] + r.normal(size=16) * 0.5]) for i in range(4000)]
    rows += [(5000 + i, [0.25] * 16) for i in range(2000)]  # a third are one vector
    ids = [i for i, _ in rows if i % 100 == 0]
    got, want = run(spark, rows), brute(rows, ids)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in ids])
    assert recall >= 0.9 and all(len(got[q]) == 10 for q in ids)
    assert [i for i, _ in got[6900]] == list(range(5000, 5010))


def test_partitions_are_balanced_and_routed():
    r = np.random.default_rng(3)
    x = r.normal(size=(20, 8))[r.integers(20, size=2000)] * 2 + r.normal(size=(2000, 8)) * 0.4
    graph = neighbours._nearest(x, x, 11)
    label = neighbours._partition(x, graph, 10)
    assert np.bincount(label, minlength=10).max() <= np.ceil(neighbours.SLACK * 200)
    assert np.mean(label[graph] == label[:, None]) > 0.6  # neighbours stay together
    router, probes = neighbours.fit(x, 10, 10)
    assert router is not None and 1 <= probes < 10


def test_recall_on_table(spark):
    df = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    ids = [i for i, _ in rows if i % 100 == 0]
    want = brute(rows, ids)
    found = neighbours.search(df, df.where("vec_id % 100 = 0")).groupBy("query_id").agg(F.collect_set("vec_id").alias("v")).collect()
    assert np.mean([len(set(r["v"]) & {i for i, _ in want[r["query_id"]]}) / 10 for r in found]) >= 0.9
