"""Lake stages as plain functions: source -> bronze -> silver -> gold.

Each stage is extract -> transform -> verify (gate) -> load. Column names,
checks and paths are parameters, so the same stages serve any entity table.

Publishing (:func:`publish`) is write, verify, promote: the transformed rows are
written once to a new version folder of the target, the checks run during that write
and over the written Parquet (reading only the columns they need), and only if the
gate passes a small note makes the new version the table. No data is renamed or
copied, the transform is computed exactly once, readers of the version before are not
disturbed, and whatever fails removes its own version. ``verify_on="input"`` persists
and verifies the input before anything is written.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._cols import require_columns
from ..functions.text import NULL_LABEL, clean_code, clean_label
from ..operators.geo import repair_coordinates
from ..operators.quality import REPORT_SCHEMA, Check, ObservedVerification, VerificationError, gate, verify
from ..operators.rollup import distinct_rollup
from ..sources import storage
from ..sources.paged import DEFAULT_RETRIES, paged_errors, raw_pages
from ..sources.sinks import partition_digests, prepare_partitions, read_table, write_partitioned, write_table
from ..sources.snapshots import LABEL_COL, current_label, read_latest_snapshot, split_damaged, write_run
from .reports import drop_report, keep_report, with_history

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class EntityColumns:
    """Names of the columns the silver cleaning and checks work on."""

    id: str = "id"
    kind: str = "kind"
    country: str = "country"
    state: str = "state"
    lat: str = "latitude"
    lon: str = "longitude"


# ---------------------------------------------------------------------------
# Transforms
# ---------------------------------------------------------------------------
def clean_entities(
    df: DataFrame, cols: EntityColumns = EntityColumns(), mode: str = "atomic"
) -> DataFrame:
    """Repair coordinates and clean the state / country labels.

    ``mode="atomic"``: one projection computed from the input values.
    ``mode="sequential"``: the longitude is recomputed from the already
    repaired latitude (reproduces chained column replacement).
    """
    require_columns(df, [cols.lat, cols.lon, cols.state, cols.country])
    labels = {cols.state: clean_label(cols.state), cols.country: clean_code(cols.country)}
    return repair_coordinates(df, cols.lat, cols.lon, mode=mode).withColumns(labels)


# ---------------------------------------------------------------------------
# Default checks
# ---------------------------------------------------------------------------
def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# The names of the two range checks in the report.
def entity_checks(
    cols: EntityColumns = EntityColumns(),
    *,
    name: str = "silver entity checks",
    text_columns: Sequence[str] | None = None,
) -> Check:
    """Completeness, uniqueness, type and coordinate-range checks for silver rows.

    ``text_columns`` are checked to hold text values (default: id, state,
    country, kind). The coordinate predicates let NULL pass because repair
    already nulls every out-of-range value.
    """
    text_columns = (
        [cols.id, cols.state, cols.country, cols.kind] if text_columns is None else text_columns
    )
    chk = (
        Check(name)
        .is_complete(cols.id)
        .is_unique(cols.id)
        .is_complete(cols.state)
        .is_complete(cols.country)
        .is_complete(cols.kind)
    )
    for c in text_columns:
        chk = chk.has_data_type(c, "String")
    return (
        chk.has_data_type(cols.lat, "Numeric")
        .has_data_type(cols.lon, "Numeric")
        .satisfies(f"{_quoted(cols.lat)} BETWEEN -90 AND 90", "Latitude within range", nulls="pass")
        .satisfies(f"{_quoted(cols.lon)} BETWEEN -180 AND 180", "Longitude within range", nulls="pass")
    )


def rollup_checks(
    keys: Sequence[str], count_col: str, *, name: str = "gold rollup checks",
    text_columns: Sequence[str] | None = None,
) -> Check:
    """Keys complete (and text), count numeric."""
    chk = Check(name)
    for k in keys:
        chk = chk.is_complete(k)
    for k in keys if text_columns is None else text_columns:
        chk = chk.has_data_type(k, "String")
    return chk.has_data_type(count_col, "Numeric")


# ---------------------------------------------------------------------------
# Publishing
# ---------------------------------------------------------------------------
def _write(df: DataFrame, path: str, partition_cols: Sequence[str], empty_as, observe=None,
           rebalance: bool = True) -> None:
    if partition_cols:
        write_partitioned(df, path, partition_cols, empty_as=empty_as, observe=observe,
                          rebalance=rebalance)
    else:
        write_table(df, path, observe=observe)


def _stored_as_written(df: DataFrame, partition_cols: Sequence[str], empty_as) -> bool:
    """True when reading the written table gives back exactly the rows of ``df``.

    Partition directories turn ``""`` into NULL (unless ``empty_as`` replaced
    it) and only round-trip string, integral and boolean values exactly.
    """
    exact = (T.StringType, T.IntegralType, T.BooleanType)
    for c in partition_cols:
        dt = df.schema[c].dataType
        if not isinstance(dt, exact):
            return False
        if isinstance(dt, T.StringType) and empty_as is None:
            return False
    return True


def _with_replaced(spark: SparkSession, path: str, before: storage.Version | None, folder: str, parts: dict[str, str],
                   depth: int, keep_others: bool) -> dict[str, dict[str, str]]:
    """The partitions of a table after those in ``parts`` came from ``folder``; of equal digests the old files stay."""
    old = before.parts if before else {}
    if old is None:
        # a version that did not list its partitions
        listed = storage.partition_folders(spark, f"{path.rstrip('/')}/{before.folder}", depth)
        if not listed and storage.exists(spark, f"{path.rstrip('/')}/{before.folder}"):
            raise ValueError("the version before is not partitioned that way: publish it whole once")
        old = {before.folder: dict.fromkeys(listed, "")}
    out: dict[str, dict[str, str]] = {}
    held = {d: (f, x) for f, dirs in old.items() for d, x in dirs.items()}
    for d, x in parts.items():
        f, was = held.pop(d, (None, ""))
        out.setdefault(f if x and x == was else folder, {})[d] = x
    if keep_others:
        for d, (f, x) in held.items():
            out.setdefault(f, {})[d] = x
    return out


def publish(
    df: DataFrame,
    path: str,
    checks: Sequence[Check],
    *,
    partition_cols: Sequence[str] = (),
    empty_as: str | None = NULL_LABEL,
    verify_on: str = "staged",
    rebalance: bool = True,
    overwrite: str = "static",
    extra: Callable[[DataFrame], Sequence[tuple]] | None = None,
    reports: str | None = None,
    table_name: str | None = None,
) -> DataFrame:
    """Verify ``checks`` and write ``df`` to ``path`` only if the gate passes.

    ``overwrite="static"`` replaces the table; ``"dynamic"`` only the partitions that
    ``df`` has rows of; ``"changed"`` replaces the table, too, but a partition whose rows
    are those it had before keeps its files (one more pass over what was written
    computes a digest for each partition, which the note keeps). The last two write
    only new folders, and the note names each partition's: nothing is moved, and a crash
    before the note leaves the table as it was. Uniqueness is verified over the table
    as it would be, everything else over the rows written.

    ``extra`` gives further report rows from the rows written, before the gate.
    ``reports`` names a folder that keeps the report, also of a version that is rejected,
    under ``table_name`` (default: ``path``); see :mod:`stratalake.plans.reports`. Assertions
    of type :class:`~stratalake.operators.quality.Recent` compare with the kept ones.
    Returns the verification report (materialised, one row per constraint).
    Raises :class:`~stratalake.operators.quality.VerificationError` on failure.
    """
    if verify_on not in ("staged", "input"):
        raise ValueError("verify_on must be 'staged' or 'input'")
    if overwrite not in ("static", "dynamic", "changed"):
        raise ValueError("overwrite must be 'static', 'dynamic' or 'changed'")
    if overwrite != "static" and (not partition_cols or verify_on == "input"):
        raise ValueError(f"overwrite={overwrite!r} needs partition columns and verify_on='staged'")
    spark = df.sparkSession
    df = prepare_partitions(df, partition_cols, empty_as) if partition_cols else df
    version = storage.new_version(path)
    folder = version.rpartition("/")[2]
    before = storage.current_version(spark, path) if overwrite != "static" or reports else None
    table_name = table_name or path.rstrip("/")
    if reports:
        checks = with_history(checks, spark, reports, table_name, (before.number if before else 0) + 1)
    report = spark.createDataFrame([], REPORT_SCHEMA)
    parts = None

    def write(observe=None) -> None:
        _write(df, version, partition_cols, empty_as, observe=observe, rebalance=rebalance)

    def verified(frame: DataFrame) -> DataFrame:
        return spark.createDataFrame(verify(frame, *checks).collect(), REPORT_SCHEMA)

    def gated(rep: DataFrame, written: DataFrame | None = None) -> DataFrame:
        if extra is not None:
            written = read_table(spark, version, df.schema) if written is None else written
            rep = rep.unionByName(spark.createDataFrame(list(extra(written)), REPORT_SCHEMA))
        try:
            gate(rep)
        except VerificationError:
            if reports:
                keep_report(rep, reports, table_name, folder, None)
            raise
        return rep

    def table() -> DataFrame:
        """The table as the note would make it."""
        if overwrite != "dynamic":
            return read_table(spark, version, df.schema)
        return read_table(spark, path, df.schema, version=storage.Version(0, folder, replaced()))

    def replaced() -> dict[str, dict[str, str]]:
        if overwrite == "changed":
            new = partition_digests(spark, version, df.schema, partition_cols)
        else:
            new = dict.fromkeys(storage.partition_folders(spark, version, len(partition_cols)), "")
        return _with_replaced(spark, path, before, folder, new, len(partition_cols), overwrite == "dynamic")

    try:
        if not checks:
            write()
            report = gated(report)
        elif verify_on == "input":
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                report = gated(verified(df), df)
                write()
            finally:
                df.unpersist()
        elif _stored_as_written(df, partition_cols, empty_as):
            # Scan metrics are observed during the write itself; only uniqueness
            # re-reads the written files (its key columns only).
            ov = ObservedVerification(df, *checks)
            write(ov.attach)
            report = gated(ov.report(table()))
        else:
            write()
            report = gated(verified(table()))
        if overwrite != "static":
            parts = replaced()
        after = before.number if before else 0
        if reports:
            keep_report(report, reports, table_name, folder, after + 1)
        storage.promote(spark, path, version, parts, after if overwrite != "static" or reports else None)
    except VerificationError:
        storage.delete(spark, version)
        raise
    except BaseException:
        storage.delete(spark, version)
        if reports:
            drop_report(spark, reports, table_name, folder)
        raise
    for d in sorted(set(storage.partition_folders(spark, version, len(partition_cols))) - set(parts[folder])) if parts and folder in parts else ():
        storage.delete(spark, f"{version}/{d}")  # copies of what is shared
    if parts is not None and folder not in parts:
        storage.delete(spark, version)
    log.info("published %s", path)
    return report


def run_stage(
    extract: Callable[[], DataFrame],
    transforms: Sequence[Callable[[DataFrame], DataFrame]],
    load: Callable[[DataFrame], DataFrame | None],
    checks: Sequence[Check] = (),
) -> DataFrame | None:
    """Generic template: extract, transform one after the other, validate, load.

    With ``checks`` the transformed rows are verified and gated before ``load`` runs
    (one pass over them). A ``load`` that verifies what it writes (:func:`publish`)
    needs none. Errors are logged and re-raised.
    """
    try:
        df = extract()
        for t in transforms:
            df = df.transform(t)
        if checks:
            gate(verify(df, *checks))
        return load(df)
    except Exception:
        log.exception("stage failed")
        raise


# ---------------------------------------------------------------------------
# The three stages
# ---------------------------------------------------------------------------
DAMAGED = "_damaged"


class Damaged:
    """Takes damaged records out of the way of a stage, counted by the pass that reads them.

    Only if that pass has met any are they read once more and published to ``table``
    (partition: label), so sound input costs nothing. The count of that pass only says
    whether there are any: a task that runs again counts again. Numbers in the report are
    those of the rows stored.
    """

    def __init__(self, table: str | None, most: float = 1.0):
        self.table, self.most = table, most
        self.seen: Observation | None = None
        self.bad: DataFrame | None = None

    def take_out(self, rows: DataFrame) -> DataFrame:
        self.seen = Observation()
        good, bad = split_damaged(rows, DAMAGED)
        self.bad = bad.select(F.col(DAMAGED).alias("record"), LABEL_COL)
        counted = rows.observe(self.seen, F.count(DAMAGED).alias("damaged"))
        return split_damaged(counted, DAMAGED)[0] if self.table else counted.drop(DAMAGED)

    def report(self, written: DataFrame) -> list[tuple]:
        n = self.seen.get["damaged"]
        if n:
            log.warning("%s damaged records%s", n, f" go to {self.table}" if self.table else " are read as far as they go")
        if not self.table:
            return []
        share = 0.0
        if n:
            publish(self.bad, self.table, [], partition_cols=[LABEL_COL], overwrite="dynamic")
            labels = [r[0] for r in self.bad.select(LABEL_COL).distinct().collect()]  # one: a stage reads one snapshot
            stored = read_table(written.sparkSession, self.table, self.bad.schema).where(F.col(LABEL_COL).isin(labels)).count()
            share = stored / (stored + written.count())
        passed = share <= self.most
        status = "Success" if passed else "Error"
        return [("damaged records", "Error", status, "Damaged(share)", "Success" if passed else "Failure",
                 "" if passed else f"more than {self.most}", share)]


def to_bronze(
    spark: SparkSession,
    fetch,
    bronze_base: str,
    *,
    label: str | None = None,
    per_page: int = 200,
    pages_per_partition: int | None = None,
    retries: int = DEFAULT_RETRIES,
    label_col: str = LABEL_COL,
) -> str:
    """Paged source -> one dated raw snapshot (JSON Lines of the source records).

    Pages go from the tasks straight into the files of a new run. A page that cannot be
    read fails the write as a whole (:class:`PagedReadError`) before its manifest; a
    snapshot is complete, or what it was before. Refuses to write an empty snapshot.
    Returns the snapshot directory.
    """
    def load(pages: DataFrame) -> str:
        def write(folder: str, options: dict[str, str]) -> int:
            rows = Observation()
            counted = pages.select("record").observe(rows, F.count(F.lit(1)).alias("rows"))
            with paged_errors():
                counted.write.mode("append").options(**options).text(folder)
            return rows.get["rows"]

        return write_run(spark, bronze_base, label or current_label(), write, label_col=label_col)

    def extract() -> DataFrame:
        return raw_pages(spark, fetch, per_page=per_page, pages_per_partition=pages_per_partition, retries=retries)

    return run_stage(extract, [], load)


def to_silver(
    spark: SparkSession,
    bronze_base: str,
    silver_path: str,
    schema: T.StructType,
    *,
    cols: EntityColumns = EntityColumns(),
    checks: Sequence[Check] | None = None,
    partition_cols: Sequence[str] | None = None,
    mode: str = "atomic",
    empty_as: str | None = NULL_LABEL,
    multiline: bool = False,
    verify_on: str = "staged",
    filename: str | None = None,
    overwrite: str = "static",
    quarantine: str | None = None,
    most_damaged: float = 1.0,
    reports: str | None = None,
) -> DataFrame:
    """Newest bronze snapshot -> cleaned, verified silver table partitioned by country/state.

    ``multiline=True`` reads snapshots written as one JSON array per file;
    ``filename`` reads a single file of the newest snapshot. ``overwrite`` and ``reports`` as in :func:`publish`.

    Records that do not fit the schema (cut off, of wrong types, no objects) are counted
    while the snapshot is read. With a ``quarantine`` table their texts go there, to the
    partition of their snapshot's label, the others go on, and the report has a
    constraint on their share, which may be ``most_damaged``. Without one they go on with
    what could be read of them, as NULLs otherwise, and a warning says how many.
    """
    partition_cols = [cols.country, cols.state] if partition_cols is None else list(partition_cols)
    checks = [entity_checks(cols)] if checks is None else checks

    apart = Damaged(quarantine, most_damaged)

    def extract() -> DataFrame:
        rows = read_latest_snapshot(spark, bronze_base, schema, multiline=multiline, filename=filename, damaged=DAMAGED)
        return apart.take_out(rows).drop(LABEL_COL)

    def load(df: DataFrame) -> DataFrame:
        return publish(df, silver_path, checks, partition_cols=partition_cols, empty_as=empty_as,
                       verify_on=verify_on, overwrite=overwrite, extra=apart.report, reports=reports)

    return run_stage(extract, [lambda df: clean_entities(df, cols, mode)], load)


def to_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    schema: T.StructType,
    *,
    keys: Sequence[str] = ("country", "state", "kind"),
    id_col: str = "id",
    alias: str = "n_entities",
    checks: Sequence[Check] | None = None,
    verify_on: str = "staged",
    reports: str | None = None,
) -> DataFrame:
    """Silver table -> distinct-count roll-up by ``keys``, verified, written unpartitioned."""
    checks = [rollup_checks(keys, alias)] if checks is None else checks
    return run_stage(
        lambda: read_table(spark, silver_path, schema),
        [lambda silver: distinct_rollup(silver, keys, id_col, alias)],
        lambda gold: publish(gold, gold_path, checks, verify_on=verify_on, reports=reports),
    )
