"""Records that do not fit, and snapshots that are complete or what they were before."""

import os

import pytest
from pyspark.sql import types as T

from stratalake.operators import Check, VerificationError
from stratalake.plans.stages import DAMAGED, Damaged, EntityColumns, to_silver
from stratalake.sources import clean_snapshots, parse_records, snapshot_files, snapshot_labels, storage, write_snapshot
from stratalake.sources.sinks import read_table
from stratalake.sources.snapshots import latest_snapshot, read_latest_snapshot, read_snapshots, split_damaged
from stratalake.streaming import incremental_silver

SCHEMA = T.StructType(
    [T.StructField(n, T.DoubleType() if n.endswith("itude") else T.StringType()) for n in ("id", "kind", "latitude", "longitude", "country", "state")]
)
BAD = {
    "cut off": '{"id": "x1", "kind": "a", "lat',
    "wrong type": '{"id": "x2", "kind": "a", "latitude": "north", "longitude": 1.0, "country": "us", "state": "ny"}',
    "number": "12",
    "text": '"x"',
    "true": "true",
    "array": "[1, 2]",
    "not json": "id;kind",
}
GOOD = ['{"id": "%d", "kind": "a", "latitude": 1.5, "longitude": 2.0, "country": "us", "state": "ny"}' % i for i in range(5)] + ['{"id": "5", "kind": "b", "country": "us", "state": "ny", "more": 1}']
COLS = EntityColumns()
CHECKS = [Check("c").is_complete("id").is_unique("id")]


def bronze(tmp_dir, lines, label="2024-01-01T00-00"):
    d = os.path.join(tmp_dir, "b", f"dt_extraction={label}")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return os.path.join(tmp_dir, "b")


@pytest.mark.parametrize("kind", sorted(BAD))
def test_every_kind_of_damage_is_kept(spark, tmp_dir, kind):
    base = bronze(tmp_dir, [GOOD[0], BAD[kind], "", GOOD[5]])
    for df in (read_latest_snapshot(spark, base, SCHEMA, damaged=DAMAGED), read_snapshots(spark, base, SCHEMA, damaged=DAMAGED)):
        good, bad = split_damaged(df, DAMAGED)
        assert sorted(r.id for r in good.collect()) == ["0", "5"] and DAMAGED not in good.columns
        assert [r[DAMAGED] for r in bad.collect()] == [BAD[kind]]


def test_damaged_page_records(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*GOOD, *BAD.values()])], "n int, record string")
    good, bad = split_damaged(parse_records(df, SCHEMA, damaged=DAMAGED), DAMAGED)
    assert good.count() == len(GOOD) and sorted(r[DAMAGED] for r in bad.collect()) == sorted(BAD.values())


@pytest.mark.parametrize("verify_on", ["staged", "input"])
def test_quarantine(spark, tmp_dir, verify_on):
    base = bronze(tmp_dir, [*GOOD, *BAD.values()])
    silver, bad = os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "q")
    kw = {"cols": COLS, "checks": CHECKS, "quarantine": bad, "verify_on": verify_on}
    with pytest.raises(VerificationError, match="Damaged"):
        to_silver(spark, base, silver, SCHEMA, most_damaged=0.5, **kw)
    assert not storage.current_version(spark, silver)
    rep = {r.constraint: r for r in to_silver(spark, base, silver, SCHEMA, most_damaged=0.6, **kw).collect()}
    assert rep["Damaged(share)"].metric == len(BAD) / (len(BAD) + len(GOOD)) and rep["Damaged(share)"].constraint_status == "Success"
    assert read_table(spark, silver, SCHEMA).count() == len(GOOD)
    table = read_table(spark, bad, T.StructType.fromDDL("record string, dt_extraction string"))
    assert sorted(r.record for r in table.collect()) == sorted(BAD.values())  # run twice, kept once
    # a later snapshot adds its own; a sound one costs nothing and adds nothing
    bronze(tmp_dir, [*GOOD[:2], BAD["cut off"]], "2024-01-02T00-00")
    to_silver(spark, base, silver, SCHEMA, **kw)
    bronze(tmp_dir, GOOD, "2024-01-03T00-00")
    rep = to_silver(spark, base, silver, SCHEMA, **kw).collect()
    assert [r.metric for r in rep if r.constraint == "Damaged(share)"] == [0.0]
    table = read_table(spark, bad, T.StructType.fromDDL("record string, dt_extraction string"))
    assert table.count() == len(BAD) + 1 and {r[0] for r in table.select("dt_extraction").distinct().collect()} == {"2024-01-01T00-00", "2024-01-02T00-00"}


def test_without_quarantine_damage_is_warned_of(spark, tmp_dir, caplog):
    base = bronze(tmp_dir, [GOOD[0], BAD["wrong type"]])
    to_silver(spark, base, os.path.join(tmp_dir, "s"), SCHEMA, cols=COLS, checks=[])
    assert read_table(spark, os.path.join(tmp_dir, "s"), SCHEMA).count() == 2
    assert any("1 damaged records" in r.getMessage() for r in caplog.records)
    assert Damaged(None).report is not None


def frame(spark, ids):
    return spark.createDataFrame([(i, "k", 1.0, 2.0, "us", "ny") for i in ids], SCHEMA).repartition(2)


def ids(df):
    return sorted(r.id for r in df.collect())


def names(path):
    return sorted(n for n in os.listdir(path) if n.startswith(("run-", "part-")))


def test_a_rerun_replaces_at_its_manifest(spark, tmp_dir, monkeypatch):
    label = "2024-01-01T00-00"
    folder = write_snapshot(frame(spark, "ab"), tmp_dir, label)
    planned = read_latest_snapshot(spark, tmp_dir, SCHEMA)
    first = names(folder)
    seen = []
    note = storage.write_note

    def before_note(s, where, name, text):
        seen.append(ids(read_latest_snapshot(spark, tmp_dir, SCHEMA)) + ids(read_snapshots(spark, tmp_dir, SCHEMA)))
        return note(s, where, name, text)

    with monkeypatch.context() as m:
        m.setattr(storage, "write_note", before_note)
        write_snapshot(frame(spark, "xyz"), tmp_dir, label)
    assert seen == [["a", "b", "a", "b"]]  # all files of the rerun are there, its manifest is not
    assert ids(read_latest_snapshot(spark, tmp_dir, SCHEMA)) == ids(read_snapshots(spark, tmp_dir, SCHEMA)) == ["x", "y", "z"]
    assert ids(planned) == ["a", "b"] and set(first) <= set(names(folder))
    write_snapshot(frame(spark, "q"), tmp_dir, label)
    assert not set(first) & set(names(folder))  # gone with the next rerun
    write_snapshot(frame(spark, "r"), tmp_dir, label, keep_replaced=False)
    assert ids(spark.read.schema(SCHEMA).json(folder)) == ["r"]  # as any tool reads it
    assert ids(latest_snapshot(read_snapshots(spark, tmp_dir, SCHEMA), base=tmp_dir)) == ["r"]


def test_a_run_that_died(spark, tmp_dir, monkeypatch):
    old, new = "2024-01-01T00-00", "2024-01-02T00-00"
    write_snapshot(frame(spark, "ab"), tmp_dir, old)
    for label in (old, new):  # killed after its files, before its manifest
        frame(spark, "zz").write.mode("append").option("mapreduce.output.basename", "run-died").json(os.path.join(tmp_dir, f"dt_extraction={label}"))
    assert ids(read_latest_snapshot(spark, tmp_dir, SCHEMA)) == ids(read_snapshots(spark, tmp_dir, SCHEMA)) == ["a", "b"]
    assert [r[0] for r in snapshot_labels(spark, tmp_dir).collect()] == [old]
    assert snapshot_files(spark, os.path.join(tmp_dir, f"dt_extraction={new}")) is None
    gone = clean_snapshots(spark, tmp_dir)
    assert gone and all("run-died" in g for g in gone) and clean_snapshots(spark, tmp_dir) == []
    assert ids(read_latest_snapshot(spark, tmp_dir, SCHEMA)) == ["a", "b"]
    with monkeypatch.context() as m:  # an error before the manifest removes the run's own files
        m.setattr(storage, "write_note", lambda *a: (_ for _ in ()).throw(OSError("full")))
        with pytest.raises(OSError, match="full"):
            write_snapshot(frame(spark, "c"), tmp_dir, old)
    assert clean_snapshots(spark, tmp_dir) == [] and ids(read_latest_snapshot(spark, tmp_dir, SCHEMA)) == ["a", "b"]


def test_files_of_other_tools_are_replaced(spark, tmp_dir):
    label = "2024-01-01T00-00"
    folder = os.path.join(tmp_dir, f"dt_extraction={label}")
    frame(spark, "ab").write.json(folder)
    assert ids(read_latest_snapshot(spark, tmp_dir, SCHEMA)) == ["a", "b"]
    write_snapshot(frame(spark, "c"), tmp_dir, label)
    assert ids(read_snapshots(spark, tmp_dir, SCHEMA)) == ["c"] and any(n.startswith("part-") for n in names(folder))
    write_snapshot(frame(spark, "d"), tmp_dir, label)
    assert ids(read_snapshots(spark, tmp_dir, SCHEMA)) == ["d"] and not any(n.startswith("part-") for n in names(folder))


def test_a_stream_takes_a_snapshot_when_its_manifest_is_there(spark, tmp_dir):
    base, silver, ckpt = (os.path.join(tmp_dir, n) for n in "bsc")
    write_snapshot(frame(spark, "ab"), base, "2024-01-01T00-00")
    folder = os.path.join(base, "dt_extraction=2024-01-02T00-00")
    frame(spark, "xyz").write.mode("append").option("mapreduce.output.basename", "run-slow").json(folder)
    run = lambda: incremental_silver(spark, base, silver, SCHEMA, ckpt, checks=CHECKS)
    assert run() == ["2024-01-01T00-00"] and ids(read_table(spark, silver, SCHEMA)) == ["a", "b"]
    assert run() == []
    # the writer goes on: the stream has met the files already
    import json

    files = [n for n in os.listdir(folder) if n.startswith("run-slow")]
    storage.write_note(spark, folder, "_files", json.dumps({"files": files, "rows": 3, "replaced": []}))
    assert run() == ["2024-01-02T00-00"] and ids(read_table(spark, silver, SCHEMA)) == ["x", "y", "z"]
    assert run() == []
