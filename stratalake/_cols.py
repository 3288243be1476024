"""Small shared helpers for Column arguments and column-set guards."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return c if isinstance(c, Column) else F.col(c)


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise ``ValueError`` naming the columns of ``required`` missing from ``df``.

    Runs at plan time (schema only), never touches data.
    """
    missing = set(required) - set(df.columns)
    if missing:
        raise ValueError(
            f"Input DataFrame is missing required columns: {sorted(missing)}"
        )
