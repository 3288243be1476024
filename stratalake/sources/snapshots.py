"""Dated snapshots ("bronze"): write, read with a declared schema, pick the latest.

Layout: ``<base>/dt_extraction=YYYY-MM-DDTHH-MM/run-<id>-*.json`` (JSON Lines, so every
file is splittable) and beside them a manifest ``_files-<n>`` that names the files of one
run. It is written last: a snapshot is what its newest complete manifest names, so
readers see the run before, whole, while a rerun of the label writes and if it dies.
A label without runs, as other tools write it, is its folder. Multi-line JSON array
files stay readable with ``multiline=True``.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._cols import as_col
from . import storage
from .schema import with_field

log = logging.getLogger(__name__)

# ---------------------------------------------------------------------------
# Partition column, label format (minute grain, UTC) and the
# directory-name pattern (prefix match: trailing text after the label is
# allowed and ignored).
# ---------------------------------------------------------------------------
LABEL_COL = "dt_extraction"
LABEL_PY_FORMAT = "%Y-%m-%dT%H-%M"
LABEL_REGEX = r"(\d{4}-\d{2}-\d{2}T\d{2}-\d{2})"
# JSON text keeps full microsecond precision (Spark's default writes milliseconds).
JSON_TIME_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
# Schema of Spark's binaryFile source: used to list snapshot files (one row per
# file; no file is opened unless ``content`` is selected).
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def current_label(now: datetime | None = None) -> str:
    """Label for ``now`` (default: the current UTC minute)."""
    now = now or datetime.now(timezone.utc)
    return now.strftime(LABEL_PY_FORMAT)


def label_of(ts, grain: str = "minute") -> Column:
    """UTC label of a timestamp Column, whatever the session's time zone.

    A TIMESTAMP_NTZ is taken as UTC wall time as it stands; a TIMESTAMP (an instant) is
    counted from the epoch. ``grain="day"`` gives the label of the day's first minute.
    """
    if grain not in ("minute", "day"):
        raise ValueError("grain must be 'minute' or 'day'")
    ts = as_col(ts)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    instant = F.timestamp_add("MINUTE", F.floor(F.unix_seconds(ts.cast("timestamp")) / 60).cast("int"), epoch)
    wall = F.when(F.typeof(ts) == "timestamp_ntz", ts.cast("string")).otherwise(instant.cast("string"))
    day = F.substring(wall, 1, 10)
    if grain == "day":
        return F.concat(day, F.lit("T00-00"))
    return F.concat(day, F.lit("T"), F.substring(wall, 12, 2), F.lit("-"), F.substring(wall, 15, 2))


def label_time(label) -> Column:
    """TIMESTAMP_NTZ of a label (prefix match); NULL for names that are not a valid label."""
    prefix = F.regexp_extract(as_col(label), "^" + LABEL_REGEX, 1)
    text = F.concat(F.substring(prefix, 1, 10), F.lit(" "), F.translate(F.substring(prefix, 12, 5), "-", ":"))
    return text.try_cast("timestamp_ntz")


def _writer(df: DataFrame, fmt: str, label_col: str):
    w = (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(label_col)
        .format(fmt)
    )
    return w.options(**JSON_TIME_OPTIONS) if fmt == "json" else w


MANIFEST = "_files"
RUN = "run-"


def _manifest(spark: SparkSession, folder: str) -> dict | None:
    note = storage.read_note(spark, folder, MANIFEST)
    return json.loads(note) if note else None


def snapshot_files(spark: SparkSession, folder: str) -> list[str] | None:
    """Paths that hold the snapshot ``folder`` (a label's): the files that its newest complete
    manifest names, the folder itself if it has no runs, None if none is complete."""
    found = _manifest(spark, folder)
    if found:
        return [f"{folder.rstrip('/')}/{n}" for n in found["files"]]
    return None if any(n.startswith(RUN) for n in storage.list_names(spark, folder)) else [folder]


def write_run(
    spark: SparkSession,
    base: str,
    label: str,
    write: Callable[[str, dict[str, str]], int],
    *,
    label_col: str = LABEL_COL,
    allow_empty: bool = False,
    keep_replaced: bool = True,
) -> str:
    """Write one snapshot; return its folder.

    ``write`` gets the folder and options for a writer in mode append, which name the files
    of this run, and returns the number of rows. The files lie beside those of the run
    before, which stays the snapshot until the manifest is written. Its files are deleted
    by the next rerun, so that running readers can finish (``keep_replaced=False``: at
    once, for a folder that is also read without its manifest). No rows: ``ValueError``,
    and nothing is left.
    """
    folder = f"{base.rstrip('/')}/{label_col}={label}"
    run = f"{RUN}{uuid.uuid4().hex}"

    def drop(names) -> None:
        for n in names:
            storage.delete(spark, f"{folder}/{n}")

    try:
        rows = write(folder, {"mapreduce.output.basename": run})
        if not rows and not allow_empty:
            raise ValueError("No data in the snapshot: nothing written")
        names = storage.list_names(spark, folder)
        before = _manifest(spark, folder) or {}
        replaced = before.get("files") or [n for n in names if not n.startswith((RUN, "_", "."))]
        files = sorted(n for n in names if n.startswith(run))
        storage.write_note(spark, folder, MANIFEST, json.dumps({"files": files, "rows": rows, "replaced": replaced}))
    except BaseException:
        if storage.exists(spark, folder):
            drop(n for n in storage.list_names(spark, folder) if n.startswith(run))
            if not any(not n.startswith(("_S", "_t", ".")) for n in storage.list_names(spark, folder)):
                storage.delete(spark, folder)
        raise
    drop(before.get("replaced", []) + ([] if keep_replaced else replaced))
    log.info("snapshot %s: %s rows in %s files", label, rows, len(files))
    return folder


def clean_snapshots(spark: SparkSession, base: str, label_col: str = LABEL_COL) -> list[str]:
    """Delete files of runs that died before their manifest; only for when no snapshot is being written."""
    gone = []
    for name in storage.list_names(spark, base):
        if name.startswith(f"{label_col}="):
            found = _manifest(spark, f"{base.rstrip('/')}/{name}") or {"files": [], "replaced": []}
            runs = [n for n in storage.list_names(spark, f"{base.rstrip('/')}/{name}") if n.startswith(RUN)]
            gone += [f"{name}/{n}" for n in runs if n not in found["files"] and n not in found["replaced"]]
    for n in gone:
        storage.delete(spark, f"{base.rstrip('/')}/{n}")
    for folder in {f"{base.rstrip('/')}/{n.partition('/')[0]}" for n in gone}:
        if all(n.startswith(("_S", "_t", ".")) for n in storage.list_names(spark, folder)):
            storage.delete(spark, folder)  # a label that never had a complete run
    return gone


def write_snapshot(
    df: DataFrame,
    base: str,
    label: str | None = None,
    *,
    fmt: str = "json",
    label_col: str = LABEL_COL,
    allow_empty: bool = False,
    keep_replaced: bool = True,
) -> str:
    """Write ``df`` as one snapshot under ``base`` (see :func:`write_run`); return the snapshot directory.

    Raises ``ValueError`` on an empty input unless ``allow_empty``.
    """
    from pyspark.sql import Observation

    def write(folder: str, options: dict[str, str]) -> int:
        # the count rides along the write instead of costing a pass over the input
        seen = Observation()
        w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("append").options(**options)
        (w.options(**JSON_TIME_OPTIONS) if fmt == "json" else w).save(folder)
        return seen.get["rows"]

    return write_run(df.sparkSession, base, label or current_label(), write, label_col=label_col,
                     allow_empty=allow_empty, keep_replaced=keep_replaced)


def write_snapshots(
    df: DataFrame,
    base: str,
    label: Column,
    *,
    fmt: str = "json",
    label_col: str = LABEL_COL,
) -> None:
    """Write ``df`` as several snapshots, the label computed per row.

    Rows are rebalanced on the label so each label directory gets few, large
    files; AQE splits a label that holds a large share of the rows. The labels that
    occur are replaced in place, without runs and manifests: for a first load.
    """
    out = df.withColumn(label_col, label).hint("rebalance", label_col)
    _writer(out, fmt, label_col).save(base)


def _reader(spark: SparkSession, schema: T.StructType, fmt: str, multiline: bool, label_col: str, damaged: str | None):
    """Reader of snapshots. With ``damaged``, a column of that name holds the text of records
    that are not as the schema says (null for all others)."""
    full = with_field(schema, label_col, "string")
    if damaged:
        full = with_field(full, damaged, "string")
    reader = spark.read.schema(full)
    if fmt == "json":
        reader = reader.option("multiline", str(multiline).lower())
        if damaged:
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", damaged)
    return reader.format(fmt)


def split_damaged(df: DataFrame, damaged: str) -> tuple[DataFrame, DataFrame]:
    """Good rows without the column ``damaged``, and the texts of the damaged ones (all other columns too,
    as far as they could be read).

    Whether a record fits depends on the columns that are read, so both conditions name
    every column (a hash is never below the smallest integer): none is pruned from the scan.
    """
    others = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name != damaged and not isinstance(f.dataType, T.MapType)]
    whole = F.hash(*others) >= F.lit(-(2**31)) if others else F.lit(True)
    return df.where(F.col(damaged).isNull() & whole).drop(damaged), df.where(F.col(damaged).isNotNull() & whole)


def read_snapshots(
    spark: SparkSession,
    base: str,
    schema: T.StructType,
    *,
    fmt: str = "json",
    multiline: bool = False,
    label_col: str = LABEL_COL,
    damaged: str | None = None,
) -> DataFrame:
    """All snapshots under ``base`` with the declared schema plus ``label_col`` (string).

    The label is declared as a string so it is never re-typed by inference. Of a label
    with runs the one its manifest names is read. ``damaged`` names a column for the
    text of records that do not fit the schema.
    """
    reader = _reader(spark, schema, fmt, multiline, label_col, damaged)
    folders = [f"{base.rstrip('/')}/{n}" for n in storage.list_names(spark, base) if n.startswith(f"{label_col}=")]
    runs = [snapshot_files(spark, f) for f in folders]
    if all(r == [f] for r, f in zip(runs, folders)):
        return reader.load(base)
    found = [p for r in runs for p in r or ()]
    if not found:
        return spark.createDataFrame([], with_field(schema, label_col, "string"))
    return reader.option("basePath", base).load(found)


def latest_snapshot_path(
    spark: SparkSession,
    base: str,
    filename: str | None = None,
    *,
    label_col: str = LABEL_COL,
) -> str:
    """Folder (or ``filename`` inside it) of the newest complete snapshot under ``base``.

    Only names are listed and manifests read, no data; a folder that a rerun has written to
    is read by :func:`read_latest_snapshot` or :func:`snapshot_files`. Names are prefix-matched; one
    whose date does not parse is skipped with a warning; among equal times the smallest
    name wins. A snapshot whose only run has no manifest yet is passed over.
    ``FileNotFoundError`` when ``base`` is missing or holds no snapshot.
    """
    pattern = re.compile(re.escape(label_col) + "=" + LABEL_REGEX)
    times: dict[str, datetime] = {}
    for m in filter(None, map(pattern.match, storage.list_names(spark, base))):
        try:
            times[m.string] = datetime.strptime(m[1], LABEL_PY_FORMAT)
        except ValueError:
            log.warning("no date in the folder name %s: passed over", m.string)
    newest_first = sorted(sorted(times), key=times.get, reverse=True)
    folders = (f"{base.rstrip('/')}/{n}" for n in newest_first)
    path = next((f for f in folders if snapshot_files(spark, f) is not None), None)
    if path is None:
        raise FileNotFoundError(f"{base} holds no complete snapshot ({label_col}=...)")
    return f"{path}/{filename}" if filename else path


def read_latest_snapshot(
    spark: SparkSession,
    base: str,
    schema: T.StructType,
    *,
    fmt: str = "json",
    multiline: bool = False,
    label_col: str = LABEL_COL,
    filename: str | None = None,
    damaged: str | None = None,
) -> DataFrame:
    """Rows of the newest snapshot only; the scan touches only its folder
    (or only ``filename`` inside it). ``damaged`` as in :func:`read_snapshots`."""
    path = latest_snapshot_path(spark, base, filename, label_col=label_col)
    files = [path] if filename else snapshot_files(spark, path)
    reader = _reader(spark, schema, fmt, multiline, label_col, damaged).option("basePath", base)
    return reader.load(files or path)


def snapshot_labels(spark: SparkSession, base: str, label_col: str = LABEL_COL) -> DataFrame:
    """One row per snapshot under ``base`` (folder names and manifests; incomplete ones are left out)."""
    prefix = f"{label_col}="
    names = [n for n in storage.list_names(spark, base) if n.startswith(prefix)]
    names = [n[len(prefix):] for n in names if snapshot_files(spark, f"{base.rstrip('/')}/{n}") is not None]
    return spark.createDataFrame([(n,) for n in names], T.StructType([T.StructField(label_col, T.StringType())]))


def newest_label_value(labels: DataFrame, label_col: str = LABEL_COL) -> Column:
    """Scalar subquery: the newest valid label in ``labels`` (ties: smallest name)."""
    t = label_time(label_col)
    return (
        labels.select(label_col)
        .where(t.isNotNull())
        .orderBy(t.desc(), F.col(label_col).asc())
        .limit(1)
        .scalar()
    )


def latest_snapshot(df: DataFrame, label_col: str = LABEL_COL, *, base: str | None = None) -> DataFrame:
    """Rows whose label is the newest valid one, as a lazy DataFrame.

    The newest label is one uncorrelated scalar subquery (newest time, ties to
    the smallest name). When ``label_col`` is a partition column, Spark applies
    the comparison as a runtime partition filter, so only the winning directory
    is scanned by the outer query.

    Pass ``base``, the folder ``df`` was read from, so the subquery runs over the
    names of its snapshot folders (no file is listed or opened). Without it the
    labels are those in ``df``'s rows: cheap for Parquet (row counts come from
    footers), but for JSON files it is refused, as it would read them all.
    """
    if base is None and any(f.endswith((".json", ".json.gz")) for f in df.inputFiles()[:1]):
        raise ValueError("pass base: finding the newest label would read every JSON snapshot")
    labels = snapshot_labels(df.sparkSession, base, label_col) if base else df
    return df.where(F.col(label_col) == newest_label_value(labels, label_col))
