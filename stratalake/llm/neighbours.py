"""Approximate nearest neighbours over learned partitions.

Fit, on the driver, on a bounded sample: the sample's neighbour graph is cut into
partitions of balanced size (median splits along principal directions, then moves to
the neighbours' partitions while sizes allow); a small network learns, from a vector,
how its neighbours spread over the partitions. The number of partitions a query is
sent to is the smallest that found ``TARGET`` of the true neighbours in a part of the
sample kept for that.

Index: every vector goes to its most probable partition. Search: every query goes to
its most probable partitions and is reranked there by exact distance. Large partitions
are dealt into blocks of vectors and blocks of queries, so a partition that holds a
third of all rows is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, staged

SAMPLE = 6000
TRIAL = 600  # of the sample, to choose the number of probes
PARTITION_ROWS = 400
LEAST_PARTITIONS, MOST_PARTITIONS = 2, 64
LARGE = 1e120  # components beyond it are scaled before they are squared
GRAPH = 10  # neighbours in the graph
SLACK = 1.1  # largest partition of the sample, times the mean
TARGET = 0.94
HIDDEN, EPOCHS, BATCH, RATE = 96, 40, 128, 0.003
BLOCK_ROWS = 8192
BLOCK_QUERIES = 1024


def _unit(*arrays) -> float:
    """1, or, where squares would overflow, the largest component."""
    import numpy as np

    most = max((float(np.abs(a).max()) for a in arrays if a.size), default=0.0)
    return most if most > LARGE else 1.0


def _distances(x, q):
    """Euclidean distances of the rows of x to q; also where their squares leave the doubles' range."""
    import numpy as np

    with np.errstate(over="ignore", under="ignore"):
        gap = x - q
        out = np.sqrt((gap**2).sum(1))
        most = np.abs(gap).max(1)
        odd = np.flatnonzero(((most > LARGE) | (most < 1 / LARGE)) & (most > 0) & (most < np.inf))
        if len(odd):
            out[odd] = most[odd] * np.sqrt(((gap[odd] / most[odd, None]) ** 2).sum(1))
    return out


def _nearest(x, q, k: int):
    """Row numbers of the k nearest in x of each of q."""
    import numpy as np

    norms = (x * x).sum(1)
    out = np.empty((len(q), k), np.int64)
    for at in range(0, len(q), 512):
        d = norms - 2 * (q[at : at + 512] @ x.T)
        out[at : at + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def _partition(x, graph, parts: int, rounds: int = 12):
    """Balanced partition of the neighbour graph: number of the partition of each row."""
    import numpy as np

    label = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), parts, 0)]
    while todo:
        rows, n, first = todo.pop()
        if n == 1:
            label[rows] = first
            continue
        centred = x[rows] - x[rows].mean(0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ direction, kind="stable")]
        cut = len(rows) * (n // 2) // n
        todo += [(order[:cut], n // 2, first), (order[cut:], n - n // 2, first + n // 2)]
    most = int(np.ceil(SLACK * len(x) / parts))
    sizes = np.bincount(label, minlength=parts)
    a, b = np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), np.int64)
        np.add.at(votes, (a, label[b]), 1)
        np.add.at(votes, (b, label[a]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), label]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < most:
                sizes[label[i]] -= 1
                sizes[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


class Router:
    """One hidden layer: probabilities of the partitions."""

    def __init__(self, x, target, seed: int = 5):
        import numpy as np

        r = np.random.default_rng(seed)
        self.unit = _unit(x)
        self.mean, self.scale = (x / self.unit).mean(0), (x / self.unit).std() + 1e-12
        z = self._scaled(x)
        parts = target.shape[1]
        w = [
            r.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)),
            np.zeros(HIDDEN),
            r.normal(0, HIDDEN**-0.5, (HIDDEN, parts)),
            np.zeros(parts),
        ]
        m, v, step = [0 * a for a in w], [0 * a for a in w], 0
        for _ in range(EPOCHS):
            order = r.permutation(len(z))
            for k in range(0, len(order), BATCH):
                rows = order[k : k + BATCH]
                h = np.maximum(z[rows] @ w[0] + w[1], 0)
                s = h @ w[2] + w[3]
                p = np.exp(s - s.max(1, keepdims=True))
                g = (p / p.sum(1, keepdims=True) - target[rows]) / len(rows)
                gh = (g @ w[2].T) * (h > 0)
                grads = [z[rows].T @ gh, gh.sum(0), h.T @ g, g.sum(0)]
                step += 1
                for i, grad in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad * grad
                    w[i] = w[i] - RATE * m[i] / (1 - 0.9**step) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.w = w

    def _scaled(self, x):
        import numpy as np

        with np.errstate(over="ignore"):
            return np.clip((x / self.unit - self.mean) / self.scale, -1e6, 1e6)

    def ranked(self, x):
        """Partitions of each vector, most probable first."""
        import numpy as np

        h = np.maximum(self._scaled(x) @ self.w[0] + self.w[1], 0)
        return np.argsort(-(h @ self.w[2] + self.w[3]), axis=1, kind="stable")


def fit(x, parts: int, k: int, target: float = TARGET):
    """(router, probes) from a sample of vectors; (None, 1) if all of them are equal.

    Vectors of a sample too small to keep some for trial go to every partition.
    """
    import numpy as np

    x = np.asarray(x, float)
    if parts < 2 or not len(x):
        return None, 1
    _, first = np.unique(x, axis=0, return_index=True)
    x = x[np.sort(first)]  # copies would be each other's only neighbours
    parts = min(parts, len(x))
    if parts < 2:
        return None, 1
    unit = _unit(x)
    x = x / unit
    near = min(GRAPH, len(x) - 1)
    graph = _nearest(x, x, near + 1)
    label = _partition(x, graph, parts)
    spread = np.zeros((len(x), parts))
    np.add.at(spread, (np.repeat(np.arange(len(x)), near + 1), label[graph].ravel()), 1.0 / (near + 1))
    trial = np.random.default_rng(3).permutation(len(x))[: min(TRIAL, len(x) // 5)]
    rest = np.setdiff1d(np.arange(len(x)), trial)
    router = Router(x[rest], spread[rest])
    router.unit *= unit
    if not len(trial):
        return router, parts
    ranked = router.ranked(x * unit)
    home = ranked[:, 0]
    truth = _nearest(x[rest], x[trial], min(k, len(rest)))
    order = np.argsort(ranked[trial], axis=1)  # place of each partition
    place = np.take_along_axis(order, home[rest][truth], 1)
    found = np.cumsum(np.bincount(place.ravel(), minlength=parts)) / place.size
    return router, int(np.searchsorted(found, target) + 1) if found[-1] >= target else parts


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    x = F.col(vector_col).cast("array<double>")
    good = (
        F.col(id_col).isNotNull()
        & x.isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(x, lambda v: v != 0)
    )
    return vectors.where(good).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def _routed(router, probes: int, sizes=None, k: int = 0):
    """Rows (vec_id, x) -> (vec_id, x, part): ``probes`` partitions a row, more while they hold k rows or fewer."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["x"].to_list()).astype(float)
            ranked = router.ranked(x) if router else np.zeros((len(x), 1), np.int64)
            if sizes is None:
                count = np.full(len(x), min(probes, ranked.shape[1]))
            else:
                enough = (np.cumsum(sizes[ranked], 1) <= k).sum(1) + 1
                count = np.minimum(np.maximum(enough, probes), ranked.shape[1])
            rows = np.repeat(np.arange(len(x)), count)
            within = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            yield pd.DataFrame(
                {"vec_id": pdf["vec_id"].to_numpy()[rows], "x": pdf["x"].to_numpy()[rows], "part": ranked[rows, within]}
            )

    return run


def _rerank(k: int):
    """Rows of one (part, block, qblock): the k nearest of the block for each of its queries."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for _, pdf in groups(batches, ["part", "block", "qblock"]):
            asks = pdf["query"].to_numpy()
            if asks.all() or not asks.any():
                continue
            x = np.stack(pdf["x"].to_list()).astype(float)
            ids = pdf["vec_id"].to_numpy()
            base, base_ids, q, q_ids = x[~asks], ids[~asks], x[asks], ids[asks]
            unit = _unit(base, q)
            small = base / unit
            norms = (small * small).sum(1)
            out = []
            for at in range(0, len(q), 256):
                part = q[at : at + 256]
                near = part / unit
                own = (near * near).sum(1)[:, None]
                d = own + norms - 2 * (near @ small.T)
                self_ = q_ids[at : at + 256, None] == base_ids[None]
                # rounding may hide a tie: whatever can be among the k nearest is measured exactly
                error = 1e-9 * (own + norms)
                upper = np.where(self_, np.inf, d + error)
                kth = np.partition(upper, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
                close = (d - error <= kth[:, None]) & ~self_
                for i in range(len(part)):
                    some = np.flatnonzero(close[i])
                    exact = _distances(base[some], part[i])
                    best = np.lexsort((base_ids[some], exact))[:k]
                    out.append((np.full(len(best), q_ids[at + i]), base_ids[some][best], exact[best]))
            yield pd.DataFrame({n: np.concatenate([o[j] for o in out]) for j, n in enumerate(("query_id", "vec_id", "score"))})

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query, nearest first.

    score is the Euclidean distance in double precision, ties go to the smaller vec_id;
    a query's own id is no candidate. Null ids, and vectors that are null, zero, hold a
    null or non-finite component, or have another length than most, take no part. Finite
    vectors all do, whatever their size (a distance beyond the doubles is infinite).
    Queries of one id count once (the smallest vector); repeated vectors are candidates
    each. Fewer than k rows are returned only if there are fewer candidates. An empty
    table gives no rows. Other columns are ignored.
    """
    import numpy as np

    base = _valid(vectors, id_col, vector_col)
    length = base.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    n = length["n"] if length else 0
    base = base.where(F.size("x") == n)
    asked = _valid(queries, id_col, vector_col).where(F.size("x") == n).groupBy("vec_id").agg(F.min("x").alias("x"))
    rows = length["count"] if length else 0
    sample = [r["x"] for r in base.orderBy(F.xxhash64("vec_id"), "vec_id", "x").limit(SAMPLE).select("x").collect()]
    router, probes = fit(sample, min(MOST_PARTITIONS, max(LEAST_PARTITIONS, rows // PARTITION_ROWS)), k)

    routed = "vec_id long, x array<double>, part long"
    placed = staged(base.mapInPandas(_routed(router, 1), routed), "ann")
    found = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}  # MOST_PARTITIONS rows
    sizes = np.array([found.get(i, 0) for i in range(max(found, default=0) + 1)], np.int64)
    if router is not None:
        sizes = np.append(sizes, np.zeros(len(router.w[3]) - len(sizes), np.int64))
    sent = staged(asked.mapInPandas(_routed(router, probes, sizes, k), routed), "ann")
    asks = {r["part"]: r["count"] for r in sent.groupBy("part").count().collect()}
    blocks = F.create_map(*[F.lit(int(v)) for i, c in found.items() for v in (i, -(-c // BLOCK_ROWS))]) if found else None
    qblocks = F.create_map(*[F.lit(int(v)) for i, c in asks.items() for v in (i, -(-c // BLOCK_QUERIES))]) if asks else None
    if not found or not asks:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    nb, nq = blocks[F.col("part").cast("int")], qblocks[F.col("part").cast("int")]
    every = lambda m: F.explode(F.sequence(F.lit(0), m - 1))
    dealt = lambda m: F.pmod(F.xxhash64("vec_id"), m).cast("int")
    left = placed.where(nq.isNotNull()).select("part", "vec_id", "x", F.lit(False).alias("query"), dealt(nb).alias("block"), every(nq).alias("qblock"))
    right = sent.where(nb.isNotNull()).select("part", "vec_id", "x", F.lit(True).alias("query"), every(nb).alias("block"), dealt(nq).alias("qblock"))
    near = (
        left.unionByName(right)
        .repartition("part", "block", "qblock")
        .sortWithinPartitions("part", "block", "qblock")
        .mapInPandas(_rerank(k), "query_id long, vec_id long, score double")
    )
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
