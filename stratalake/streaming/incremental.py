"""Incremental silver: pick up only new bronze snapshots with Structured Streaming.

The bronze folder is watched by a streaming file source that lists files only
(``binaryFile`` projected to the partition label, so no file is opened); new
``dt_extraction=...`` directories are discovered by the source's own file log. Each micro-batch
keeps only its newest snapshot and, if that snapshot is newer than the one
already published, cleans, verifies and publishes it -- "the latest snapshot
replaces the table". ``trigger(availableNow=True)`` processes everything that
is there now and stops, so the job can run on a schedule; the checkpoint
makes reruns skip files already processed, and survives driver restarts.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NULL_LABEL
from ..operators.quality import Check, VerificationError
from ..plans.stages import EntityColumns, clean_entities, entity_checks, publish
from ..sources import storage
from ..sources.schema import with_field
from ..sources.snapshots import FILE_SCHEMA, LABEL_COL, LABEL_REGEX, label_time, snapshot_files, snapshot_labels

log = logging.getLogger(__name__)

MARKER = "_published_label"


def _published_label(spark: SparkSession, checkpoint: str) -> str | None:
    """Label last published from ``checkpoint``, or None."""
    return storage.read_note(spark, checkpoint, MARKER)


def _mark_published(spark: SparkSession, checkpoint: str, label: str) -> None:
    """Add a note with the label; the one before it holds until it is complete."""
    storage.write_note(spark, checkpoint, MARKER, label)


def newest_label(batch: DataFrame, label_col: str = LABEL_COL) -> str | None:
    """Newest valid label present in ``batch`` (ties: smallest name); one small aggregate."""
    t = label_time(label_col)
    row = (
        batch.select(label_col)
        .where(t.isNotNull())
        .groupBy(label_col)
        .agg(F.max(t).alias("_t"))
        .orderBy(F.col("_t").desc(), F.col(label_col).asc())
        .first()
    )
    return row[label_col] if row else None


def _older(label: str, than: str) -> bool:
    """``label`` loses to ``than`` under the latest-snapshot rule (newest time,
    ties to the smallest name). The time part has a fixed width: text order is time order."""
    a, b = (re.match(LABEL_REGEX, x).group(1) for x in (label, than))
    return a < b or (a == b and label > than)


def incremental_silver(
    spark: SparkSession,
    bronze_base: str,
    silver_path: str,
    schema: T.StructType,
    checkpoint: str,
    *,
    cols: EntityColumns = EntityColumns(),
    checks: Sequence[Check] | None = None,
    partition_cols: Sequence[str] | None = None,
    mode: str = "atomic",
    empty_as: str | None = NULL_LABEL,
    label_col: str = LABEL_COL,
    multiline: bool = False,
    max_files_per_trigger: int | None = None,
) -> list[str]:
    """Process all new snapshots under ``bronze_base``; return the labels published.

    A micro-batch only tells *which* snapshots received new files. The newest
    of them is then read whole from its directory, so a snapshot whose files
    are split over several micro-batches (``max_files_per_trigger``, or a
    listing taken while the snapshot was being committed) is never published
    partially: a later batch with more files of the same snapshot publishes it
    again, complete. Older snapshots arriving late are skipped.

    A snapshot that fails an Error-level check leaves silver untouched and is
    *not* retried: its micro-batch still commits, later snapshots in the same
    run are processed, and :class:`VerificationError` is raised once the
    stream has stopped. Replaying a deterministic gate failure would otherwise
    block every later snapshot. Any other error fails the micro-batch, so the
    next run retries it.
    """
    partition_cols = [cols.country, cols.state] if partition_cols is None else list(partition_cols)
    checks = [entity_checks(cols)] if checks is None else list(checks)
    full_schema = with_field(schema, label_col, "string")
    # The stream tracks *files*: a binaryFile source projected to the partition
    # label never opens a file, so discovering new snapshots costs metadata only.
    reader = spark.readStream.format("binaryFile").schema(with_field(FILE_SCHEMA, label_col, "string"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.load(bronze_base).select(label_col)
    published: list[str] = []
    tried: set[str] = set()
    rejected: list[tuple[str, VerificationError]] = []

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        label = newest_label(batch, label_col)
        if label is not None:
            take(batch.sparkSession, label, epoch_id)

    def take(s: SparkSession, label: str, epoch_id: int | None = None) -> None:
        done = _published_label(s, checkpoint)
        if done is not None and _older(label, done):
            log.info("batch %s: snapshot %s is older than %s; skipped", epoch_id, label, done)
            return
        files = snapshot_files(s, f"{bronze_base.rstrip('/')}/{label_col}={label}")
        if not files:
            log.info("batch %s: snapshot %s has no manifest yet", epoch_id, label)
            return
        rows = (
            s.read.schema(full_schema)
            .option("multiline", str(multiline).lower())
            .option("basePath", bronze_base)
            .json(files)
            .drop(label_col)
        )
        tried.add(label)
        try:
            publish(clean_entities(rows, cols, mode), silver_path, checks,
                    partition_cols=partition_cols, empty_as=empty_as)
        except VerificationError as e:
            log.error("batch %s: snapshot %s rejected by the quality gate: %s", epoch_id, label, e)
            rejected.append((label, e))
            return
        _mark_published(s, checkpoint, label)
        published.append(label)

    q = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    # a manifest written after the stream met its snapshot's files, which it meets only once
    label = newest_label(snapshot_labels(spark, bronze_base, label_col), label_col)
    if label is not None and label not in tried:
        done = _published_label(spark, checkpoint)
        if done is None or (label != done and not _older(label, done)):
            take(spark, label)
    if rejected:
        raise VerificationError([f for _, e in rejected for f in e.failures])
    return published
