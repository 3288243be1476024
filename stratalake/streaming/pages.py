"""Following a paged source: what came since the last run is appended to a table of pages."""

from __future__ import annotations

import re

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from ..sources import storage
from ..sources.paged import DEFAULT_PER_PAGE, DEFAULT_RETRIES, RAW_SCHEMA, PagedReadError, stream_pages


def incremental_pages(
    spark: SparkSession,
    fetch,
    path: str,
    checkpoint: str,
    *,
    per_page: int = DEFAULT_PER_PAGE,
    pages_per_partition: int = 50,
    retries: int = DEFAULT_RETRIES,
    base_wait: float = 0.5,
) -> int:
    """Append the records that the source has now and had not at the last run; return how many.

    The table at ``path`` (Parquet, ``page`` and ``record``) is written by a file sink,
    whose log names the files of each finished micro-batch: a record is in it once,
    whatever tasks, executors or runs were lost. Read it with :func:`read_pages`. Raises
    :class:`PagedReadError` if a page cannot be read or has lost records; the next run
    goes on where this one stopped.
    """
    taken = 0
    # a run that starts with an unfinished micro-batch finishes that one only
    for _ in range(1 + _unfinished(spark, checkpoint)):
        pages = stream_pages(
            spark, fetch, per_page=per_page, pages_per_partition=pages_per_partition, retries=retries, base_wait=base_wait
        )
        q = (
            pages.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        try:
            q.awaitTermination()
        except StreamingQueryException as e:
            m = re.search(r"PagedReadError: (page .*)", str(e))
            if m:
                raise PagedReadError(m[1]) from e
            raise
        taken += sum(p.numInputRows for p in q.recentProgress)
    return taken


def _unfinished(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a micro-batch was planned that has not finished."""
    planned, done = (
        {n for n in storage.list_names(spark, f) if n.isdigit()} if storage.exists(spark, f) else set()
        for f in (f"{checkpoint.rstrip('/')}/{name}" for name in ("offsets", "commits"))
    )
    return bool(planned) and max(map(int, planned)) > max(map(int, done), default=-1)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """All pages that :func:`incremental_pages` has taken so far."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)
