"""Order MinHash against plain Python with the same hash function."""

import hashlib
import random
import re
import struct

import xxhash

from stratalake.llm import fingerprint as fp
from stratalake.llm.common import read_table


def h(raw, seed=42):
    return xxhash.xxh64_intdigest(raw, seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def signature(text):
    pieces = re.findall(r"[^\x20\x09-\x0D]{1,%d}" % fp.PIECE, text or "")
    if len(pieces) < fp.K:
        kmers = [h(" ".join(pieces).encode())]
    else:
        single = [h(p.encode()) for p in pieces]
        kmers = []
        for i in range(len(single) - fp.K + 1):
            seed = 42
            for x in single[i : i + fp.K]:
                seed = h(struct.pack("<Q", x), seed)
            kmers.append(seed)
    seen: dict = {}
    bins: dict = {}
    for at, k in enumerate(kmers):
        k = signed(k) >> fp.AT_BITS
        number = seen[k] = seen.get(k, -1) + 1
        v = signed(h(struct.pack("<i", number), h(struct.pack("<q", k)))) & ~fp.AT | at
        bins.setdefault(v >> 58, []).append(v)
    out = []
    for b in sorted(bins):
        seed = 42
        for v in sorted(sorted(bins[b])[: fp.L], key=lambda x: x & fp.AT):
            seed = h(struct.pack("<q", v >> fp.AT_BITS & (1 << 64 - fp.AT_BITS) - 1), seed)
        out.append((b & 63) << 58 | seed >> 6)
    return out


def likeness(a, b):
    return len({*a} & {*b}) / len({x >> 58 for x in a} | {x >> 58 for x in b})


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        m = len(t) // 2
        edited = t[: len(t) - m] + nxt[:m]
        a, e, n = signature(t), signature(edited), signature(nxt)
        text = lambda s: "".join(f"{x:016X}" for x in s)
        out.append(
            (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(e), round(likeness(a, e), 9), round(likeness(a, n), 9))
        )
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, part string").repartition(4)
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in fp.compare_neighbours(df).collect()), key=repr)


def test_against_brute_force(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    rows = [(i * 7 - 50, " ".join(r.choice(words) for _ in range(r.randrange(0, 200)))) for i in range(60)]
    rows += [(5, None), (9, ""), (10, " \n "), (11, "one two"), (12, "é😀" * 50), (13, "a " * 5000), (14, "x" * 20_000)]
    rows += [(15, "same text here and there"), (15, "same text here and there"), (None, "no id at all"), (None, None)]
    assert run(spark, rows) == brute(rows)


def test_single_row_and_empty_table(spark):
    assert run(spark, [(1, "a b c d e f")]) == brute([(1, "a b c d e f")])
    assert run(spark, [(None, "x")]) == brute([(None, "x")])
    assert run(spark, []) == []


def test_order_matters(spark):
    a = " ".join(f"w{i}" for i in range(400))
    halves = " ".join([f"w{i}" for i in range(200, 400)] + [f"w{i}" for i in range(200)])
    shuffled = " ".join(random.Random(1).sample([f"w{i}" for i in range(400)], 400))
    assert likeness(signature(a), signature(a)) == 1
    assert likeness(signature(a), signature(halves)) < 0.9 and likeness(signature(a), signature(shuffled)) < 0.1


def test_whole_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    assert run(spark, [(r["doc_id"], r["text"]) for r in docs.collect()]) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
