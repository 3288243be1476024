"""Partitioned sinks: encoding round trip, static vs dynamic overwrite, file counts."""

import glob
import os

import pytest
from pyspark.sql import types as T

from stratalake.sources import read_table, write_partitioned, write_table

SCHEMA = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("country", T.StringType()),
     T.StructField("state", T.StringType())]
)
STATES = ["", "007", None, "a/b", "unknown", "New:York", "12"]


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame([(str(i), "", s) for i, s in enumerate(STATES)], SCHEMA)


def test_reference_encoding(spark, tmp_dir, frame):
    write_partitioned(frame, tmp_dir, ["country", "state"], empty_as=None)
    back = {r.id: (r.country, r.state) for r in read_table(spark, tmp_dir, SCHEMA).collect()}
    assert [back[str(i)][1] for i in range(len(STATES))] == [None, "007", None, "a/b", "unknown", "New:York", "12"]
    assert {c for c, _ in back.values()} == {None}


def test_empty_as_unknown(spark, tmp_dir, frame):
    write_partitioned(frame, tmp_dir, ["country", "state"])
    back = {r.id: (r.country, r.state) for r in read_table(spark, tmp_dir, SCHEMA).collect()}
    assert back["0"] == ("unknown", "unknown")
    assert back["2"] == ("unknown", None)


def test_inferred_types_without_schema(spark, tmp_dir, frame):
    write_partitioned(frame.where("state IN ('007', '12')"), tmp_dir, ["state"])
    inferred = spark.read.parquet(tmp_dir)
    assert dict(inferred.dtypes)["state"] == "int"
    declared = read_table(spark, tmp_dir, SCHEMA)
    assert sorted(r.state for r in declared.collect()) == ["007", "12"]


def test_static_overwrite_replaces_table(spark, tmp_dir, frame):
    write_partitioned(frame, tmp_dir, ["state"], empty_as="unknown")
    write_partitioned(frame.limit(1), tmp_dir, ["state"])
    assert read_table(spark, tmp_dir, SCHEMA).count() == 1


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_dir, frame):
    write_partitioned(frame, tmp_dir, ["state"], empty_as="unknown")
    one = frame.where("state = '12'")
    write_partitioned(one, tmp_dir, ["state"], overwrite="dynamic")
    assert read_table(spark, tmp_dir, SCHEMA).count() == len(STATES)


def test_few_files_per_partition(spark, tmp_dir):
    df = spark.range(0, 20000, numPartitions=8).selectExpr("CAST(id AS STRING) AS id",
                                                          "CAST(id % 5 AS STRING) AS state")
    write_partitioned(df, tmp_dir, ["state"])
    files = glob.glob(os.path.join(tmp_dir, "state=*", "*.parquet"))
    assert len(files) <= 8  # not 8 tasks x 5 values
    assert spark.read.parquet(tmp_dir).count() == 20000


def test_rebalance_in_plan(spark, tmp_dir, frame):
    from stratalake.sources.sinks import prepare_partitions

    plan = prepare_partitions(frame, ["state"]).hint("rebalance", "state")._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_write_table(spark, tmp_dir, frame):
    write_table(frame, tmp_dir)
    assert read_table(spark, tmp_dir).count() == len(STATES)


def test_hot_partition_value_is_split_over_tasks(spark, tmp_dir):
    """One value holds a third of all rows: AQE splits it over several writing tasks."""
    keys = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 300000, numPartitions=8).selectExpr(
            "CAST(id AS STRING) AS id",
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 50 AS STRING) END AS state",
            "repeat('x', 20) AS pad",
        )
        write_partitioned(df, tmp_dir, ["state"])
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    hot_files = glob.glob(os.path.join(tmp_dir, "state=hot", "*.parquet"))
    assert len(hot_files) > 1
    back = spark.read.parquet(tmp_dir)
    assert back.count() == 300000 and back.where("state = 'hot'").count() == 100000


def test_rebalance_can_be_skipped(spark, tmp_dir, frame):
    write_partitioned(frame, tmp_dir, ["state"], rebalance=False)
    assert read_table(spark, tmp_dir, SCHEMA).count() == len(STATES)


def versions(path):
    return sorted(n for n in os.listdir(path) if n.startswith("v-"))


def test_publish_switches_versions_and_keeps_the_one_before(spark, tmp_dir, frame):
    from stratalake.plans.stages import publish
    from stratalake.sources import storage

    target = os.path.join(tmp_dir, "t")
    publish(frame, target, [], partition_cols=["state"])
    reader = read_table(spark, target, SCHEMA)  # planned before the next publish
    first = storage.current_path(spark, target)
    publish(frame.limit(2), target, [])
    assert read_table(spark, target, SCHEMA).count() == 2
    assert reader.count() == len(STATES)  # a running reader keeps its files
    assert len(versions(target)) == 2
    publish(frame.limit(1), target, [])
    assert read_table(spark, target, SCHEMA).count() == 1
    assert len(versions(target)) == 2 and os.path.basename(first) not in versions(target)
    with pytest.raises(ValueError, match="verify_on"):
        publish(frame, target, [], verify_on="nowhere")


@pytest.mark.parametrize("verify_on", ["staged", "input"])
def test_any_failure_removes_its_own_version(spark, tmp_dir, frame, verify_on):
    from pyspark.sql import functions as F

    from stratalake.operators import Check
    from stratalake.plans.stages import publish

    target = os.path.join(tmp_dir, "t")
    publish(frame, target, [])
    before = os.listdir(target)
    broken = frame.withColumn("id", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        publish(broken, target, [Check("c").is_complete("id")], verify_on=verify_on)
    with pytest.raises(AssertionError):
        publish(frame, target, [Check("c").satisfies("id = 'none'", "never")], verify_on=verify_on)
    assert sorted(os.listdir(target)) == sorted(before)
    assert read_table(spark, target, SCHEMA).count() == len(STATES)


def test_clean_deletes_only_what_no_note_mentions(spark, tmp_dir, frame):
    from stratalake.plans.stages import publish
    from stratalake.sources import storage

    target = os.path.join(tmp_dir, "t")
    assert storage.clean_table(spark, target) == []
    publish(frame, target, [])
    publish(frame.limit(2), target, [])
    crashed = storage.new_version(target)
    write_table(frame, crashed)
    publish(frame.limit(3), target, [])  # leaves the other run's version alone
    assert os.path.exists(crashed)
    assert storage.clean_table(spark, target) == [os.path.basename(crashed)]
    assert read_table(spark, target, SCHEMA).count() == 3 and len(versions(target)) == 2


def test_unfinished_note_is_passed_over(spark, tmp_dir):
    from stratalake.sources import storage

    assert storage.read_note(spark, tmp_dir, "n") is None
    for text in ("a", "b", "c", "d"):
        storage.write_note(spark, tmp_dir, "n", text)
    assert storage.read_note(spark, tmp_dir, "n") == "d"
    assert len([n for n in os.listdir(tmp_dir) if n.startswith("n-")]) == 3
    with open(os.path.join(tmp_dir, "n-000000005"), "w") as fh:
        fh.write("half")  # the writer died
    assert storage.read_note(spark, tmp_dir, "n") == "d"
    storage.write_note(spark, tmp_dir, "n", "e")
    assert storage.read_note(spark, tmp_dir, "n") == "e"


def test_plain_folder_is_read_as_it_is(spark, tmp_dir, frame):
    write_table(frame, tmp_dir)
    assert read_table(spark, tmp_dir).count() == len(STATES)


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from stratalake.sources import storage

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(fake)
