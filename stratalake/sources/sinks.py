"""Table sinks and schema'd table reads (Parquet by default)."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._cols import require_columns
from ..functions.text import NULL_LABEL, empty_as as _empty_as
from .storage import Version, current_version, exists

OVERWRITE_MODES = ("static", "dynamic")


def prepare_partitions(
    df: DataFrame, partition_cols: Sequence[str], empty_as: str | None = NULL_LABEL
) -> DataFrame:
    """Replace ``""`` in string partition columns by ``empty_as``.

    A directory ``col=`` cannot hold an empty string: it is stored as the
    default partition and read back as NULL. Applying this before
    verification keeps what is checked equal to what is stored;
    ``empty_as=None`` keeps the values untouched.
    """
    if empty_as is None:
        return df
    string_cols = {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    repl = {c: _empty_as(c, empty_as) for c in partition_cols if c in string_cols}
    return df.withColumns(repl) if repl else df


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    *,
    mode: str = "overwrite",
    overwrite: str = "static",
    empty_as: str | None = NULL_LABEL,
    max_records_per_file: int | None = None,
    fmt: str = "parquet",
    observe: Callable[[DataFrame], DataFrame] | None = None,
    rebalance: bool = True,
) -> None:
    """Write ``df`` partitioned by ``partition_cols``.

    ``overwrite="static"`` replaces the whole table (stale partitions vanish);
    ``"dynamic"`` replaces only the partitions present in ``df``.

    Rows are rebalanced on the partition columns before the write so that
    each directory is written by few tasks (few files) instead of every input
    task writing into every directory. A rebalance (unlike a plain
    ``repartition``) lets AQE split a partition value that holds a large share
    of the rows over several tasks and merge tiny ones.

    The rebalance costs one shuffle of the rows; ``rebalance=False`` skips it
    when the input is already clustered by the partition columns or when many
    small files per directory are acceptable (each task then writes one file
    into every directory it has rows for).

    ``observe`` (e.g. ``ObservedVerification.attach``) is applied after the
    rebalance, so observed metrics are collected in the writing stage.
    """
    cols = list(partition_cols)
    require_columns(df, cols)
    if overwrite not in OVERWRITE_MODES:
        raise ValueError(f"overwrite must be one of {OVERWRITE_MODES}")
    out = prepare_partitions(df, cols, empty_as)
    if rebalance:
        out = out.hint("rebalance", *cols)
    if observe is not None:
        out = observe(out)
    w = out.write.mode(mode).option("partitionOverwriteMode", overwrite).partitionBy(*cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.format(fmt).save(path)


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    fmt: str = "parquet",
    observe: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Unpartitioned write (one file per task)."""
    (observe(df) if observe is not None else df).write.mode(mode).format(fmt).save(path)


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Plain JSON Lines output (no dated folder); timestamps keep microseconds."""
    from .snapshots import JSON_TIME_OPTIONS

    df.write.mode(mode).options(**JSON_TIME_OPTIONS).json(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    fmt: str = "parquet",
    version: Version | None = None,
    only: Collection[str] | None = None,
) -> DataFrame:
    """Read a table, typed by ``schema`` when given (partition columns included).

    A published table is read from its current version, or from ``version``. With a
    declared schema a partition value ``007`` stays the string ``"007"``; columns missing
    from the files read as NULL. Partition columns come last, after the file columns.

    A version that shares partitions with others is a union of one scan per version
    folder; it needs a schema unless one folder holds it all. ``only`` limits such a
    version to some of its partition folders (no other file is listed).
    """
    version = version or current_version(spark, path)
    root = path.rstrip("/")

    def reader():
        r = spark.read.format(fmt)
        return r.schema(schema) if schema is not None else r

    if version is None:
        return reader().load(path)
    if version.parts is None:
        if only is not None:
            raise ValueError("the version does not list its partitions")
        return reader().load(f"{root}/{version.folder}")
    frames = []
    for folder, dirs in sorted(version.parts.items()):
        paths = [f"{root}/{folder}/{d}" for d in sorted(dirs) if only is None or d in only]
        if paths:
            frames.append(reader().option("basePath", f"{root}/{folder}").load(paths))
    if schema is None and len(frames) != 1:
        raise ValueError("pass the schema: the table's partitions lie in several versions")
    if not frames:
        return spark.createDataFrame([], schema)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def partition_digests(
    spark: SparkSession, folder: str, schema: T.StructType, partition_cols: Sequence[str], fmt: str = "parquet"
) -> dict[str, str]:
    """Partition folder -> a digest of its rows, whatever their order (count, xor and sum of row hashes).

    One pass with map-side sums; a row for each partition reaches the driver.
    """
    data = [F.col(f"`{f.name}`") for f in schema.fields if f.name not in set(partition_cols)]
    if not exists(spark, folder):
        return {}
    rows = spark.read.format(fmt).schema(schema).load(folder)
    where = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    h = F.xxhash64(F.lit(1), *data)
    sums = rows.groupBy(where.alias("d")).agg(
        F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(F.xxhash64(F.lit(2), *data).cast("decimal(38,0)")).alias("s")
    )
    depth = len(partition_cols)
    return {"/".join(unquote(r["d"]).split("/")[-depth:]): f"{r['n']}:{r['x']}:{r['s']}" for r in sums.collect()}
