"""N-gram Jaccard join: exact linked groups of documents by shingle overlap.

1. Every text becomes the set of its distinct word shingles (64-bit hashes). Sizes are
   cut into bands. Two linked sets differ in so few shingles that, if a band's hash
   range is cut into one segment more than that, some segment is the same in both
   (pigeonhole): its content is a key, and linked sets share a key. There are some
   segments more than that, so that thin ones, and those of shingles that many texts
   share (lines, passages), mostly need no key. Sets near a band's end also make the keys of the next band. Keys met twice within a task are settled
   there (the later document points to the earlier one), so a key leaves a task once,
   however many copies there are.
2. Keys met by several tasks connect their documents; connected components of these
   candidate edges hold every linked pair and are small.
3. Each component is dealt into tiles of about ``TILE`` shingles. In a tile,
   for pairs of sets not yet in one group: sizes, then bitmap signatures (a hashed bit
   per shingle; bits set in one only are shingles missing in the other, which bounds
   the overlap from above), then the exact intersection of the sorted arrays.
4. Tiles of one component: their groups' first documents meet in further tiles; if
   more than one group is left, the documents outside the largest group are compared
   with all others, tile by tile. No link is lost, and no tile grows with its component.

The groups follow from the links found by one more components run. Hash collisions
aside (64 bits), everything is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, components, groups, staged, tidy

SHINGLE = 4
PERCENT = 85  # links: 100 * intersection >= PERCENT * union
BAND = 1.5  # ratio of a band's sizes
SPARE = 32  # one more segment than needed for each so many shingles, so that thin ones can be left out
SAMPLE, SAMPLE_TASKS = 20_000, 4  # texts in which common shingles are looked for
COMMON = 0.001  # of these texts
TILE = 1_500_000  # shingles of a tile of documents
FLUSH_KEYS = 2_000_000  # keys held by a task before it settles them
PART_KEYS = 100_000  # keys settled at once; rows that a task hands over at once
TEXTS = 500
CHUNK = 2**18  # bytes of text made into sets at once (a longer text is alone or last)
LONG = 64  # bytes; longer words are hashed one by one


def shingle_sets(shingle: int = SHINGLE):
    """A list of texts (or None) -> for each, its sorted distinct 64-bit shingle hashes.

    A text of fewer words has one hash, of the whole word sequence. Words, shingles and
    sets of about ``CHUNK`` bytes of text are made at once, by array.
    """
    import numpy as np
    import xxhash

    def fixed(name: str, n: int):
        return np.array([xxhash.xxh64_intdigest(f"{name} {i}") for i in range(n)], np.uint64)

    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))  # A-Z only; no byte of another character is one of these
    white = np.zeros(256, bool)
    white[[*range(9, 14), 32]] = True
    value = np.where(white, np.uint64(0), fixed("byte", 256))
    place = fixed("place", LONG) | np.uint64(1)
    odd = fixed("shingle", shingle) * np.uint64(2) + np.uint64(1)

    def mix(h):
        h = h ^ (h >> np.uint64(31))
        h = h * np.uint64(0x9E3779B97F4A7C15)  # fixed value: 2**64 / golden ratio
        return h ^ (h >> np.uint64(29))

    def words(raw: bytes, b, starts, ends):
        """64-bit hashes of the words: the sum over bytes of a number of the byte times one of its place."""
        h = np.zeros(len(starts), np.uint64)
        cuts = np.flatnonzero(np.diff(starts // CHUNK, prepend=-1, append=-1))
        for lo, hi in zip(cuts, cuts[1:]):
            own = starts[lo:hi]
            first = int(own[0])
            at = own - first
            n = int(min(ends[hi - 1] - first, at[-1] + LONG))
            where = np.arange(n) - np.repeat(at, np.diff(at, append=n))
            # white space between words counts 0, wherever it is
            h[lo:hi] = np.add.reduceat(value[b[first : first + n]] * place.take(where, mode="clip"), at)
        for i in np.flatnonzero(ends - starts > LONG).tolist():
            h[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]])
        return mix(mix(h))

    def some(texts: list[bytes]) -> list:
        raw = b"\n".join([b"", *texts, b""]).translate(lower)
        b = np.frombuffer(raw, np.uint8)
        edges = white[b]
        edges = np.flatnonzero(edges[1:] != edges[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        offsets = np.cumsum([1, *(len(t) + 1 for t in texts)])
        n = np.diff(np.searchsorted(starts, offsets))
        h = words(raw, b, starts, ends)
        short = (n > 0) & (n < shingle)
        if short.any():  # filled up with their number of words
            wide = np.where(short, shingle, n)
            filled = np.repeat(n.astype(np.uint64), wide)
            filled[np.repeat(np.cumsum(wide) - wide - (np.cumsum(n) - n), n) + np.arange(len(h))] = h
            h, n = filled, wide
        m = max(0, len(h) - shingle + 1)
        s = np.zeros(m, np.uint64)
        for i in range(shingle):
            s = mix(s + h[i : i + m] * odd[i])
        ends = np.cumsum(n)
        keep = np.ones(len(h), bool)  # no shingle starts at a text's last words
        for i in range(1, shingle):
            keep[ends[n > 0] - i] = False
        s = s[keep[:m]]
        n = np.maximum(n - shingle + 1, 0)
        ends = np.cumsum(n)
        for lo, hi in zip((ends - n).tolist(), ends.tolist()):
            s[lo:hi].sort()
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        new[(ends - n)[n > 0]] = True
        ends = np.append(0, np.cumsum(new))[ends]
        s = s[new]
        return [s[lo:hi] for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def sets(texts: list) -> list:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        total = np.cumsum([len(t) for t in raw], dtype=np.int64)
        cuts = np.flatnonzero(np.diff(total // CHUNK, prepend=-1, append=-1)).tolist()
        return [s for lo, hi in zip(cuts, cuts[1:]) for s in some(raw[lo:hi])]

    return sets


class Bands:
    """Size bands, their segments, and which keys a set makes."""

    def __init__(self, percent: int):
        self.percent = percent
        self.lows = [1]

    def band(self, n: int) -> int:
        import bisect

        while self.lows[-1] <= n:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * BAND)))
        return bisect.bisect_right(self.lows, n) - 1

    def differ(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of these sizes."""
        p = self.percent
        return (100 - p) * (a + b) // (100 + p)

    def keys(self, s, common=()) -> list:
        """Arrays of keys, one per band that a set may meet a partner in.

        Shingles are dealt into ``segments`` segments by hash, common ones into as many
        of their own. At least 2 * segments - differ() of these are the same in a
        partner, so a set may leave out all but differ() + 1 of them. In this order:
        (a) the common segments and those of fewer than 3, 2 or 1 shingles, (b) the
        empty ones, (c) none. Of two partners, what the choice of the one that leaves
        out more is sure to have in common, the other has not left out either.
        """
        import numpy as np

        k, _, many = self.keys_of([s], common)
        return np.split(k, np.cumsum(many)[:-1])

    def keys_of(self, sets: list, common=()):
        """The keys of several sets, end to end, one run for each set (not empty) and band
        as in :meth:`keys`: the numbers of the runs' sets, and how many keys a run has."""
        import numpy as np

        runs = [(i, n, band) for i, n in enumerate(map(len, sets)) for band in range(self.band(n), self.band(100 * n // self.percent) + 1)]
        if not runs:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.band(self.lows[max(band for *_, band in runs)])  # so that each band has an end
        of, sizes, bands = np.array(runs, np.int64).T
        high = np.array(self.lows, np.int64)[bands + 1]
        segments = self.differ(high - 1, high - 1) + 1 + -(-high // SPARE)
        spare = segments - self.differ(sizes, np.minimum(100 * sizes // self.percent, high - 1)) - 1
        s = np.concatenate([sets[i] for i in of.tolist()])
        run = np.repeat(np.arange(len(runs)), sizes)
        # cells: the segments of a run, then those of its common shingles
        first = np.cumsum(2 * segments) - 2 * segments
        cell = ((s >> np.uint64(16)) % segments.astype(np.uint64)[run]).astype(np.int64) + first[run]
        if len(common):
            usual = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
            cell[usual] += segments[run[usual]]
        cells = int(2 * segments.sum())
        body = np.zeros(cells, np.uint64)
        np.add.at(body, cell, s * (s | np.uint64(1)))
        size = np.bincount(cell, minlength=cells)
        run = np.repeat(np.arange(len(runs)), 2 * segments)
        seg = np.arange(cells) - first[run]
        plain = np.where(seg < segments[run], size, 0)
        used = size > 0
        used |= (2 * segments - np.add.reduceat(used, first, dtype=np.int64) > segments + spare)[run]
        for least in (1, 2, 3):
            full = plain >= least
            used = np.where((segments - np.add.reduceat(full, first, dtype=np.int64) <= spare)[run], full, used)
        where = bands.astype(np.uint64)[run] * np.uint64(0x100000001B3) + seg.astype(np.uint64)
        k = (body[used] ^ (where[used] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)  # odd, fixed
        return k ^ (k >> np.uint64(32)), of, np.add.reduceat(used, first, dtype=np.int64)


def common_shingles(known: DataFrame, shingle: int):
    """Sorted hashes of shingles in at least ``COMMON`` of a sample of about ``SAMPLE`` texts.

    Only steers which keys are made: any set gives the same, exact result. At most the
    sample's shingles / (COMMON * SAMPLE) hashes, so it may go to every task.
    """
    import numpy as np

    def count(batches: Iterator) -> Iterator:
        import pandas as pd

        sets = shingle_sets(shingle)
        for pdf in batches:
            found = sets(pdf["text"].tolist())
            if found:
                names, n = np.unique(np.concatenate(found), return_counts=True)
                some = n > 1
                yield pd.DataFrame({"s": names[some].view(np.int64), "n": n[some]})

    total = known.count()
    sample = known.where(F.pmod(F.xxhash64("doc"), F.lit(max(1, total // SAMPLE))) == 0).select("text")
    least = max(4, int(COMMON * min(total, SAMPLE)))
    counts = sample.repartition(SAMPLE_TASKS).mapInPandas(tidy(count), "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    got = [r["s"] for r in counts.where(F.col("n") >= least).select("s").collect()]
    return np.sort(np.array(got, np.int64).view(np.uint64))


#: kinds of rows that step 1 makes
DOC, SAME, NEAR, KEY, SET = range(5)


def _sketch(shingle: int, percent: int, common=()):
    """Step 1 in a task, over record batches: (key, doc, other, n, kind) rows.

    Keys held are bounded by ``FLUSH_KEYS``; sorting them and handing them over takes
    memory for about ``PART_KEYS`` more (or the texts of one key, if they are more).
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        sets = shingle_sets(shingle)
        bands = Bands(percent)
        first: dict[bytes, int] = {}  # set -> document that stands for it
        keys: list = []
        owners: list = []  # for each of these arrays: documents, and how many of its keys each has
        held = 0

        def rows(kind, key, doc, other=None, n=None):
            """Record batches of at most ``PART_KEYS`` rows."""
            key = np.asarray(key).astype(np.uint64, copy=False).view(np.int64)
            for at in range(0, len(key), PART_KEYS):
                m = min(PART_KEYS, len(key) - at)
                columns = [
                    pa.array(np.zeros(m, np.int64) if c is None else np.asarray(c[at : at + m], np.int64))
                    for c in (key, doc, other, n)
                ]
                columns.append(pa.array(np.full(m, kind, np.int8)))
                yield pa.RecordBatch.from_arrays(columns, ["key", "doc", "other", "n", "kind"])

        def settle():
            """Keys of this task: one row each; documents behind the first point to it."""
            nonlocal held
            if not keys:
                return
            k = np.concatenate(keys)
            o = np.concatenate([np.repeat(*x) for x in owners])
            keys.clear()
            owners.clear()
            first.clear()
            held = 0
            # keys are hashes: their remainders deal them into parts of about one size
            parts = -(-len(k) // PART_KEYS)
            behind = []
            for p in range(parts):
                mine = np.flatnonzero(k % np.uint64(parts) == p) if parts > 1 else slice(None)
                pk, po = k[mine], o[mine]
                if not len(pk):
                    continue
                order = np.lexsort((po, pk))
                pk, po = pk[order], po[order]
                new = np.append(True, pk[1:] != pk[:-1])
                lead = po[new][np.cumsum(new) - 1]
                pairs = np.stack((po[~new], lead[~new]), 1)
                if len(pairs):
                    behind.append(np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0))
                yield from rows(KEY, pk[new], po[new])
            del k, o
            if behind:
                a, b = np.unique(np.concatenate(behind), axis=0).T
                yield from rows(NEAR, a, a, b)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                docs, sizes, names, same, reps, digests = part.column(0).to_numpy(), [], [], [], [], []
                for few in by_bytes(part, 1, CHUNK):
                    new = []
                    for doc, s in zip(few.column(0).to_pylist(), sets(few.column(1).to_pylist())):
                        raw = xxhash.xxh3_128_digest(s.tobytes())
                        sizes.append(len(s))
                        names.append(int.from_bytes(raw[:8], "little", signed=True))
                        if not len(s):
                            continue
                        rep = first.setdefault(raw, doc)
                        if rep != doc:
                            same.append((doc, rep))
                            continue
                        reps.append(doc)
                        digests.append(raw)
                        new.append((doc, s))
                    k, of, many = bands.keys_of([s for _, s in new], common)
                    keys.append(k)
                    owners.append((np.array([doc for doc, _ in new], np.int64)[of], many))
                    held += len(k)
                yield from rows(DOC, docs, docs, names, sizes)  # other: 64 bits of the set
                if same:
                    a = np.array(same)
                    yield from rows(SAME, a[:, 0], a[:, 0], a[:, 1])
                if reps:
                    halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
                    yield from rows(SET, halves[:, 0], reps, halves[:, 1].copy().view(np.int64))
                if held >= FLUSH_KEYS:
                    yield from settle()
        yield from settle()

    return run


def _meet(batches: Iterator) -> Iterator:
    """Step 2 in a task, rows sorted: neighbours on one key (sets: of one 128-bit hash) become edges."""
    import numpy as np
    import pandas as pd

    names = ["key", "kind", "other", "doc"]
    last = None
    for pdf in batches:
        if not len(pdf):
            continue
        cols = [pdf[c].to_numpy() for c in names]
        prev = [np.append(c[:1] if last is None else np.array([x], c.dtype), c[:-1]) for c, x in zip(cols, last or cols)]
        key, kind, other, doc = cols
        joined = (kind >= KEY) & (key == prev[0]) & (kind == prev[1]) & (other == prev[2]) & (doc != prev[3])
        passed = pdf[kind <= NEAR][["doc", "other", "n", "kind"]]
        made = pd.DataFrame({"doc": doc[joined], "other": prev[3][joined], "n": 0, "kind": kind[joined]})
        made["kind"] = np.where(made["kind"] == SET, SAME, NEAR).astype(np.int8)
        yield pd.concat((passed, made.drop_duplicates()), ignore_index=True)
        last = [c[-1] for c in cols]


class Tile:
    """Documents' sets with bitmaps; finds links between groups."""

    def __init__(self, texts: list, shingle: int, percent: int, sets=None):
        import numpy as np

        self.percent = percent
        make = sets or shingle_sets(shingle)
        self.sets = make(texts)
        self.n = np.array([len(s) for s in self.sets], np.int64)
        # a bit for each of twice the median size, so that bits of one set rarely meet
        width = int(2 ** np.ceil(np.log2(max(64, 2 * np.median(self.n) if len(self.n) else 64))))
        self.maps = np.zeros((len(texts), width // 64), np.uint64)
        for i, s in enumerate(self.sets):
            bit = (s >> np.uint64(8)) % np.uint64(width)
            np.bitwise_or.at(self.maps[i], (bit // np.uint64(64)).astype(np.int64), np.uint64(1) << (bit % np.uint64(64)))
        # sorted arrays of small numbers, end to end
        self.ends = np.cumsum(self.n)
        names, self.flat = np.unique(np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64), return_inverse=True)
        self.mine = np.zeros(len(names) + 1, bool)

    def candidates(self, i: int, others):
        """Those of ``others`` whose sizes and bitmaps allow a link with i."""
        import numpy as np

        p = self.percent
        a, b = self.n[i], self.n[others]
        need = -(-p * (a + b) // (100 + p))
        others = others[(np.minimum(a, b) >= need) & (b > 0)]
        if not len(others):
            return others
        b = self.n[others]
        need = -(-p * (a + b) // (100 + p))
        mine, theirs = self.maps[i], self.maps[others]
        lost = np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64)
        theirs_lost = np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64)
        return others[(np.minimum(a - lost, b - theirs_lost) >= need)]

    def numbers(self, i: int):
        return self.flat[self.ends[i] - self.n[i] : self.ends[i]]

    def linked(self, i: int, others):
        """Those of ``others`` (no empty sets) that are linked with i, by exact intersection."""
        import numpy as np

        if not len(others):
            return others
        own = self.numbers(i)
        self.mine[own] = True
        sizes = self.n[others]
        hits = self.mine[np.concatenate([self.numbers(j) for j in others])]
        self.mine[own] = False
        same = np.add.reduceat(hits.astype(np.int64), np.cumsum(sizes) - sizes)
        return others[100 * same >= self.percent * (self.n[i] + sizes - same)]

    def links(self, groups, left=None, right=None) -> list[tuple[int, int]]:
        """Links that join different groups (numbers, changed in place), among all or left x right."""
        import numpy as np

        found = []
        whole = left is None
        left = np.argsort(-self.n, kind="stable") if whole else left
        for place, i in enumerate(left):
            others = left[:place] if whole else right
            others = others[groups[others] != groups[i]]
            for j in self.linked(i, self.candidates(i, others)):
                if groups[j] != groups[i]:
                    found.append((int(i), int(j)))
                    groups[groups == groups[j]] = groups[i]
        return found


def _link_tiles(shingle: int, percent: int, cross: bool):
    """Steps 3 and 4 in a task: tiles of (doc, grp, text[, side]) -> (doc, other) links and (doc, grp) groups.

    Rows: link rows have kind SAME; with ``cross`` false, a DOC row for each document
    gives the document that stands for its group within the tile.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        sets = shingle_sets(shingle)
        rows: list = []
        for _, pdf in groups(batches, ["sc", "tile"]):
            docs = pdf["doc"].to_numpy()
            number = np.unique(pdf["grp"].to_numpy(), return_inverse=True)[1]
            tile = Tile(pdf["text"].tolist(), shingle, percent, sets)
            if cross:
                side = pdf["side"].to_numpy()
                found = tile.links(number, np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            else:
                found = tile.links(number)
                low = pd.Series(docs).groupby(number).transform("min").to_numpy()
                rows += [(int(d), int(g), DOC) for d, g in zip(docs, low)]
            rows += [(int(docs[i]), int(docs[j]), SAME) for i, j in found]
            if len(rows) >= 10_000:
                yield pd.DataFrame(rows, columns=["doc", "other", "kind"])
                rows.clear()
        yield pd.DataFrame(rows, columns=["doc", "other", "kind"])

    return run


def _tiles(members: DataFrame, tile: int) -> DataFrame:
    """Adds ``tile``: the documents of a component dealt by hash into tiles of about ``tile`` shingles, and ``tiles``."""
    size = members.groupBy("sc").agg(F.greatest(F.ceil(F.sum("n") / tile), F.lit(1)).cast("int").alias("tiles"))
    return members.join(size, "sc").withColumn("tile", F.pmod(F.xxhash64("doc"), F.col("tiles")).cast("int"))


def _run_tiles(tiles: DataFrame, shingle: int, percent: int, cross: bool) -> DataFrame:
    side = ["side"] if cross else []
    rows = tiles.select("sc", "tile", "doc", "grp", "text", *side)
    rows = rows.repartition("sc", "tile").sortWithinPartitions("sc", "tile", "doc")
    return rows.mapInPandas(tidy(_link_tiles(shingle, percent, cross)), "doc long, other long, kind byte")


def link_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    tile: int = TILE,
) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row.

    component_id is the smallest doc_id reachable by links, the document included. A
    text without words (or null) has an empty set and no links. Rows of one doc_id are
    one node: a link of one is a link of all. Rows with a null id keep a null
    component. Words are lower-cased A-Z only; whole texts are read. An empty table
    gives no rows. Other columns are ignored.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    known = d.where(F.col("doc").isNotNull())
    common = common_shingles(known, shingle)
    rows = known.mapInArrow(tidy(_sketch(shingle, percent, common)), "key long, doc long, other long, n long, kind byte")
    met = rows.repartition("key").sortWithinPartitions("key", "kind", "other", "doc").mapInPandas(
        tidy(_meet), "doc long, other long, n long, kind byte"
    )
    met = staged(met, "jaccard")
    edge = lambda df, *kinds: df.where(F.col("kind").isin(*kinds)).select(F.col("doc").alias("a"), F.col("other").alias("b"))
    certain = edge(met, SAME)
    near = edge(met, NEAR)

    # documents of one set are one, unless one of them has rows of other sets, which nobody else
    # would stand for; candidate edges between those that stand for sets
    several = met.where((F.col("kind") == DOC) & (F.col("n") > 0)).groupBy("doc")
    several = several.agg(F.min("other").alias("low"), F.max("other").alias("high")).where("low <> high").select("doc")
    several = staged(several, "jaccard")
    alike = certain
    if not several.isEmpty():
        for c in ("a", "b"):
            alike = alike.join(several.withColumnRenamed("doc", c), c, "left_anti").select("a", "b")
    same = components(alike).withColumnRenamed("comp", "rep").checkpoint()
    rep = lambda df, c: (
        df.join(same.select(F.col("node").alias(c), F.col("rep").alias(f"r{c}")), c, "left")
        .withColumn(c, F.coalesce(f"r{c}", c))
        .drop(f"r{c}")
    )
    near = rep(rep(near, "a"), "b").where("a <> b").distinct()
    members = components(near).select(F.col("node").alias("doc"), F.col("comp").alias("sc"))
    # the texts of documents that may have links, found once
    sizes = met.where(F.col("kind") == DOC).select("doc", "n")
    members = members.join(sizes.groupBy("doc").agg(F.max("n").alias("n")), "doc")
    texts = _tiles(members, tile).withColumn("grp", F.col("doc")).join(known, "doc")
    texts = staged(texts.select("doc", "sc", "tile", "tiles", "grp", "n", "text"), "jaccard")

    links = [certain]
    first = staged(_run_tiles(texts, shingle, percent, False), "jaccard")
    links.append(edge(first, SAME))

    # components of several tiles: groups' first documents meet
    wide = texts.where("tiles > 1").select("doc", "sc", "n", "tile", "tiles").distinct().checkpoint()
    with_text = lambda df: df.join(texts.where("tiles > 1").select("doc", "text"), "doc")
    if not wide.isEmpty():
        state = wide.join(first.where(F.col("kind") == DOC).select("doc", F.col("other").alias("grp")).distinct(), "doc")
        heads = _tiles(state.where("doc = grp").select("sc", "doc", "grp", "n"), tile)
        again = staged(_run_tiles(with_text(heads), shingle, percent, False), "jaccard")
        links.append(edge(again, SAME))
        merged = components(edge(again, SAME)).select(F.col("node").alias("grp"), "comp")
        state = state.join(merged, "grp", "left").withColumn("grp", F.coalesce("comp", "grp")).drop("comp")
        # the largest group of each component, and what is outside of it
        by_group = state.groupBy("sc", "grp").agg(F.count("*").alias("m"))
        top = by_group.groupBy("sc").agg(F.max(F.struct("m", F.col("grp").alias("big"))).alias("t"), F.count("*").alias("parts"))
        top = top.where("parts > 1").select("sc", F.col("t.big").alias("big"))
        state = state.join(top, "sc").checkpoint()
        if not state.isEmpty():
            out = _tiles(state.where("grp <> big").select("sc", "doc", "grp", "n"), tile)
            every = state.select("sc", "doc", "grp", "tile", "tiles")
            # each tile of the outside meets each tile of the component: blocks, not pairs
            span = out.groupBy("sc").agg(F.max("tiles").alias("outs")).join(
                every.groupBy("sc").agg(F.max("tiles").alias("alls")), "sc"
            )
            outside = out.join(span, "sc").select(
                "sc",
                "doc",
                "grp",
                F.explode(F.sequence(F.lit(0), F.col("alls") - 1)).alias("t"),
                F.col("tile").alias("o"),
                "alls",
                F.lit(0).alias("side"),
            )
            inside = every.join(span, "sc").select(
                "sc",
                "doc",
                "grp",
                F.col("tile").alias("t"),
                F.explode(F.sequence(F.lit(0), F.col("outs") - 1)).alias("o"),
                "alls",
                F.lit(1).alias("side"),
            )
            blocks = outside.unionByName(inside).withColumn("tile", F.col("o") * F.col("alls") + F.col("t"))
            last = staged(_run_tiles(with_text(blocks), shingle, percent, True), "jaccard")
            links.append(edge(last, SAME))

    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    comp = components(every)
    nulls = d.where(F.col("doc").isNull()).mapInPandas(tidy(_sizes(shingle)), "n long")
    return (
        sizes.join(comp, F.col("doc") == F.col("node"), "left")
        .select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("comp", "doc").alias("component_id"))
        .unionByName(
            nulls.select(
                F.lit(None).cast("long").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
            )
        )
    )


def _sizes(shingle: int):
    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        sets = shingle_sets(shingle)
        for pdf in batches:
            yield pd.DataFrame({"n": [len(s) for s in sets(pdf["text"].tolist())]}, dtype="int64")

    return run
