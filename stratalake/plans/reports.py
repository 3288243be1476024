"""Kept verification reports, and assertions that look back over them.

A table of reports is a folder, ``table_name=<table>/version=<folder>/`` for each version
of a table that a publish has verified, published or rejected. A report is stored before
the note that makes its version the table, so a published version always has one; a
publish that comes to nothing for another reason than its checks takes its report back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import REPORT_SCHEMA, Check, Recent
from ..sources import storage

#: ``number`` of the version (null if rejected), when it was verified, and the report's columns.
KEPT_SCHEMA = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("verified_at", T.TimestampType()),
        *REPORT_SCHEMA.fields,
        T.StructField("table_name", T.StringType()),
        T.StructField("version", T.StringType()),
    ]
)


def _folder(spark: SparkSession, reports: str, table: str, version: str) -> str:
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(table)
    return f"{reports.rstrip('/')}/table_name={escaped}/version={version}"


def keep_report(report: DataFrame, reports: str, table: str, version: str, number: int | None) -> None:
    """Store the report of one version; ``number`` None: its checks have rejected it."""
    rows = report.select(F.lit(number).cast("long").alias("number"), F.current_timestamp().alias("verified_at"), *REPORT_SCHEMA.names)
    rows.coalesce(1).write.mode("overwrite").parquet(_folder(report.sparkSession, reports, table, version))


def drop_report(spark: SparkSession, reports: str, table: str, version: str) -> None:
    storage.delete(spark, _folder(spark, reports, table, version))


def kept_reports(spark: SparkSession, reports: str, table: str | None = None) -> DataFrame:
    """All rows of kept reports (of one table): number, verified_at, the report's columns, table_name, version.

    ``number`` counts a table's published versions and is null for a rejected one. If a
    driver died between a report and its note, the number was given again; the later
    report holds, and the earlier one is left out.
    """
    if not storage.exists(spark, reports):
        return spark.createDataFrame([], KEPT_SCHEMA)
    rows = spark.read.schema(KEPT_SCHEMA).parquet(reports)
    if table is not None:
        rows = rows.where(F.col("table_name") == table)
    of_number = Window.partitionBy("table_name", "number")
    newest = F.max(F.struct("verified_at", "version")).over(of_number)
    stale = F.col("number").isNotNull() & (F.struct("verified_at", "version") < newest)
    return rows.withColumn("_stale", stale).where(~F.col("_stale")).drop("_stale")


def recent_means(reports: DataFrame, last: int, before: int | None = None) -> DataFrame:
    """check, constraint, mean, versions: each metric over the last ``last`` published versions of one table.

    ``before``: only versions of a smaller number.
    """
    published = reports.where(F.col("number").isNotNull() if before is None else F.col("number") < before)
    published = published.where(F.col("metric").isNotNull())
    back = F.dense_rank().over(Window.partitionBy("check", "constraint").orderBy(F.desc("number")))
    return (
        published.withColumn("_back", back)
        .where(F.col("_back") <= last)
        .groupBy("check", "constraint")
        .agg(F.avg("metric").alias("mean"), F.count_distinct("number").alias("versions"))
    )


def with_history(checks: Sequence[Check], spark: SparkSession, reports: str, table: str, number: int) -> list[Check]:
    """``checks`` with every :class:`Recent` replaced by the bound that reports of versions before ``number`` give.

    One row a constraint and length of the look back comes to the driver, never data.
    """
    lengths = {c.assertion.last for chk in checks for c in chk.constraints if isinstance(c.assertion, Recent)}
    if not lengths:
        return list(checks)
    kept = kept_reports(spark, reports, table)
    means = {(n, r["check"], r["constraint"]): (r["mean"], r["versions"]) for n in lengths for r in recent_means(kept, n, before=number).collect()}

    def bound(chk: Check, c):
        if not isinstance(c.assertion, Recent):
            return c
        return replace(c, assertion=c.assertion.bound(*means.get((c.assertion.last, chk.name, c.name), (None, 0))))

    return [replace(chk, constraints=tuple(bound(chk, c) for c in chk.constraints)) for chk in checks]
