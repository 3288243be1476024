"""Rows of one id with different texts: a link of one row is a link of all rows of that id."""

import random

from .test_jaccard import brute, run, variants


def test_near_copy_of_a_repeated_ids_other_text(spark):
    r = random.Random(8)
    rows = []
    for n in range(12):
        t1, t2 = ([f"w{r.randrange(5000)}" for _ in range(60)] for _ in range(2))
        one, near = " ".join(t1), " ".join(t2 + ["end"])
        low = 100 * n
        # 5 has both texts; 3 is a copy of the first, 9 a near copy of the second, 7 (at times) a copy of it
        rows += [(low + 3, one), (low + 5, one), (low + 5, " ".join(t2)), (low + 9, near)]
        rows += [(low + 7, " ".join(t2))] * (n % 2) + [(low + 5, one)] * (n % 3)
        rows += [(low + 20, x) for x in variants(r, t1, 2, 2)] if n % 4 == 0 else []
    got = run(spark, rows)
    assert got == brute(rows)
    assert {c for i, _, c in got if i % 100 == 9} == {100 * n + 3 for n in range(12)}
