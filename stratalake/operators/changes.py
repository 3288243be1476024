"""What changed between two versions of a table, and a distinct roll-up that recounts only that."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._cols import require_columns
from ..sources.storage import Version
from .rollup import distinct_rollup


def changed_partitions(old: Version, new: Version) -> tuple[set[str], set[str]] | None:
    """Partition folders of ``old`` and of ``new`` that may differ from the other version's.

    A partition that both take from the same files, or with the same digest, is unchanged.
    None if a version does not list its partitions. Metadata only.
    """
    if old.parts is None or new.parts is None:
        return None
    was, now = old.where(), new.where()
    a, b = old.digests(), new.digests()
    same = {d for d in was.keys() & now.keys() if was[d] == now[d] or (a[d] and a[d] == b[d])}
    return set(was) - same, set(now) - same


def row_changes(before: DataFrame, after: DataFrame, cols: Sequence[str], distinct: bool = False) -> DataFrame:
    """Rows of ``cols`` that the two frames hold a different number of times: ``cols`` and ``change`` (after - before).

    ``distinct`` looks at whether a row is there, not how often. NULLs are equal. One
    shuffle of rows counted in each task first, hashed on all columns, so no key is hot.
    """
    cols = list(cols)
    require_columns(before, cols)
    require_columns(after, cols)
    plain = [f"c{i}" for i in range(len(cols))]

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(cols, plain)], F.lit(sign).cast("long").alias("s"))

    both = side(before, -1).unionByName(side(after, 1)).groupBy(*plain)
    if distinct:
        change = (F.max("s") == 1).cast("long") - (F.min("s") == -1).cast("long")
    else:
        change = F.sum("s")
    out = both.agg(change.alias("change")).where("change <> 0")
    return out.select(*[F.col(p).alias(c) for p, c in zip(plain, cols)], "change")


def _same(a: str, b: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`"))
    return cond


def rollup_on_changes(
    counted: DataFrame,
    before: DataFrame,
    after: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    id_col: str,
    alias: str = "n_distinct",
) -> DataFrame:
    """:func:`distinct_rollup` of ``rows``, given ``counted``, the roll-up of the version before.

    ``before`` and ``after`` are the rows that may differ between the versions, ``rows``
    all rows of the new one that can belong to a group of those (all of them, or, if the
    partition columns are among the keys, those of the changed partitions). Only groups in
    which a (keys, id) pair came or went are counted again; a group without rows is gone.
    Keys must not be named like ``alias``.
    """
    keys = list(keys)
    touched = row_changes(before, after, [*keys, id_col], distinct=True).select(*keys).distinct()
    again = rows.select(*keys, id_col).alias("r").join(touched.alias("t"), _same("r", "t", keys), "left_semi")
    kept = counted.alias("g").join(touched.alias("t"), _same("g", "t", keys), "left_anti")
    return kept.select(*keys, alias).unionByName(distinct_rollup(again, keys, id_col, alias))
