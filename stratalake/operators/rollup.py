"""Exact distinct-count roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._cols import require_columns


def distinct_rollup(
    df: DataFrame,
    keys: Sequence[str],
    id_col: str,
    alias: str = "n_distinct",
) -> DataFrame:
    """``GROUP BY keys`` with ``count(DISTINCT id_col)``.

    NULL keys form their own group; NULL ids are not counted, so an all-NULL
    group yields 0.

    Plan: Spark rewrites a single distinct aggregate into two aggregation
    levels. The first exchange is hashed on ``(keys, id_col)``, so a key that
    holds a large share of the rows is spread over many tasks by its ids; the
    second exchange carries at most one partial count per (key, task).
    """
    keys = list(keys)
    require_columns(df, [*keys, id_col])
    return df.groupBy(*keys).agg(F.count_distinct(F.col(id_col)).alias(alias))
