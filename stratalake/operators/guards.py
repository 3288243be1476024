"""Plan-time and cheap run-time guards."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .._cols import require_columns

__all__ = ["require_columns", "require_rows"]


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise ``ValueError`` when ``df`` has no rows.

    ``isEmpty`` stops at the first row found, so on a large input it reads at
    most one partition's worth of work before answering.
    """
    if df.isEmpty():
        raise ValueError(f"No rows in {what}; refusing to write an empty result.")
    return df
