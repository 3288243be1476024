"""Incremental gold: a roll-up that follows the published versions of a silver table.

Every publish of a versioned table adds an entry to its log, a folder of small files. A
file stream over the log says that there is something new; a micro-batch takes the
newest version it names, pins it (so that publishes meanwhile neither delete nor change
what is read), counts, verifies, publishes gold and notes which version it counted. With
the version before still pinned, only the groups that changed are counted again.
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import changed_partitions, rollup_on_changes
from ..operators.quality import Check, VerificationError
from ..operators.rollup import distinct_rollup
from ..plans.stages import publish, rollup_checks
from ..sources import storage
from ..sources.sinks import read_table
from ..sources.storage import Version

log = logging.getLogger(__name__)

MARKER = "_published_version"


def counted_on_changes(
    spark: SparkSession,
    silver_path: str,
    schema: T.StructType,
    old: Version,
    new: Version,
    counted: DataFrame,
    keys: Sequence[str],
    id_col: str,
    alias: str,
    partition_cols: Sequence[str],
) -> DataFrame:
    """Roll-up of version ``new`` from ``counted``, that of ``old``; partitions that both share are not read.

    Groups can only lie in one partition if the partition columns are among the keys;
    otherwise the touched groups are looked for in the whole new version.
    """
    changed = changed_partitions(old, new)
    if changed is None:
        before, after = (read_table(spark, silver_path, schema, version=v) for v in (old, new))
        return rollup_on_changes(counted, before, after, after, keys, id_col, alias)
    before = read_table(spark, silver_path, schema, version=old, only=changed[0])
    after = read_table(spark, silver_path, schema, version=new, only=changed[1])
    within = set(partition_cols) <= set(keys)
    rows = after if within else read_table(spark, silver_path, schema, version=new)
    return rollup_on_changes(counted, before, after, rows, keys, id_col, alias)


def incremental_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    schema: T.StructType,
    checkpoint: str,
    *,
    keys: Sequence[str] = ("country", "state", "kind"),
    id_col: str = "id",
    alias: str = "n_entities",
    partition_cols: Sequence[str] = ("country", "state"),
    checks: Sequence[Check] | None = None,
    name: str = "gold",
) -> list[int]:
    """Bring gold up to the newest version of silver; return the numbers of the versions counted.

    Runs until no new version is left and stops, so it can run on a schedule; a run with
    nothing new publishes nothing. Of several new versions the newest counts. The first
    run, one after gold was published by someone else, and one whose version before is
    gone count everything; the others recount the groups that changed.

    A version whose roll-up fails an Error-level check leaves gold untouched and is not
    retried: :class:`VerificationError` is raised once the stream has stopped. Any other
    error fails the micro-batch, and the next run replays it. ``name`` tells the consumers
    of one silver table apart.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.]+", name):
        raise ValueError("name: letters, digits, _ and . only")
    checks = [rollup_checks(keys, alias)] if checks is None else list(checks)
    storage.publish_log(spark, silver_path)
    if not storage.exists(spark, storage.log_path(silver_path)):
        return []
    stream = spark.readStream.format("text").option("pathGlobFilter", "*.json").load(storage.log_path(silver_path))
    done: list[int] = []
    rejected: list[VerificationError] = []

    def count(s: SparkSession, version: Version, last: dict | None) -> DataFrame:
        gold = storage.current_version(s, gold_path)
        if last and gold and gold.number == last["gold"]:
            old = Version.from_json(last["silver"])
            if storage.version_exists(s, silver_path, old):
                counted = read_table(s, gold_path, version=gold)
                return counted_on_changes(s, silver_path, schema, old, version, counted, keys, id_col, alias, partition_cols)
        return distinct_rollup(read_table(s, silver_path, schema, version=version), keys, id_col, alias)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        s = batch.sparkSession
        number = F.get_json_object("value", "$.number").cast("long")
        entry = batch.where(number.isNotNull()).orderBy(number.desc()).select("value").first()
        if entry is None:
            return
        version = Version.from_json(json.loads(entry["value"]))
        note = storage.read_note(s, checkpoint, MARKER)
        last = json.loads(note) if note else None
        if last and version.number <= last["silver"]["number"]:
            log.info("batch %s: version %s is counted already", epoch_id, version.number)
            return
        held = [Version.from_json(last["silver"])] if last else []
        storage.pin(s, silver_path, name, [*held, version])
        if not storage.version_exists(s, silver_path, version):
            log.info("batch %s: version %s has been replaced; a later entry follows", epoch_id, version.number)
            storage.pin(s, silver_path, name, held)
            return
        try:
            publish(count(s, version, last), gold_path, checks)
        except VerificationError as e:
            log.error("batch %s: roll-up of version %s rejected by the quality gate: %s", epoch_id, version.number, e)
            storage.pin(s, silver_path, name, held)
            rejected.append(e)
            return
        gold = storage.current_version(s, gold_path)
        storage.write_note(s, checkpoint, MARKER, json.dumps({"silver": version.to_json(), "gold": gold.number}))
        storage.pin(s, silver_path, name, [version])
        done.append(version.number)

    q = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if rejected:
        raise VerificationError([f for e in rejected for f in e.failures])
    return done
