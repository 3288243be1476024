"""Dated snapshots: latest selection, write/read round trip, JSON schema-on-read."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources import (
    current_label,
    latest_snapshot,
    latest_snapshot_path,
    read_latest_snapshot,
    read_snapshots,
    write_snapshot,
)

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
    ]
)


def mkdirs(base, names):
    for n in names:
        os.makedirs(os.path.join(base, n), exist_ok=True)


def test_newest_folder_over_year_end_and_equal_days(spark, tmp_dir):
    mkdirs(tmp_dir, ["dt_extraction=2031-12-31T23-59", "dt_extraction=2032-01-01T00-00",
                     "dt_extraction=2032-01-01T00-01", "dt_extraction=2031-10-09T09-10"])
    assert latest_snapshot_path(spark, tmp_dir).endswith("/dt_extraction=2032-01-01T00-01")


def test_file_inside_the_newest_folder(spark, tmp_dir):
    mkdirs(tmp_dir, ["dt_extraction=2030-02-28T07-07", "dt_extraction=2030-03-01T07-06"])
    p = latest_snapshot_path(spark, tmp_dir, "rows.json")
    assert p.endswith("/dt_extraction=2030-03-01T07-06/rows.json")


def test_other_names_and_impossible_dates_are_skipped(spark, tmp_dir):
    mkdirs(tmp_dir, ["readme", "dt_extraction=soon", "dt_extraction=2033-02-29T00-00", "dt_extraction=2034-01-01T24-00",
                     "xdt_extraction=2040-01-01T00-00", "dt_extraction=2029-06-05T04-03"])
    assert latest_snapshot_path(spark, tmp_dir).endswith("dt_extraction=2029-06-05T04-03")


def test_prefix_match_counts(spark, tmp_dir):
    mkdirs(tmp_dir, ["dt_extraction=2024-01-01T10-00", "dt_extraction=2025-01-01T00-00-backup"])
    assert latest_snapshot_path(spark, tmp_dir).endswith("dt_extraction=2025-01-01T00-00-backup")


def test_ties_smallest_name(spark, tmp_dir):
    mkdirs(tmp_dir, ["dt_extraction=2024-01-01T10-00-b", "dt_extraction=2024-01-01T10-00-a"])
    assert latest_snapshot_path(spark, tmp_dir).endswith("-a")


def test_no_snapshot(spark, tmp_dir):
    mkdirs(tmp_dir, ["dt_extraction=", "archive"])
    with pytest.raises(FileNotFoundError):
        latest_snapshot_path(spark, tmp_dir)
    with pytest.raises(FileNotFoundError):
        latest_snapshot_path(spark, os.path.join(tmp_dir, "nowhere"))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_labels_do_not_depend_on_the_session_zone(spark, tmp_dir, zone):
    """02-30 does not exist on that day in New York; labels are UTC and know no gap."""
    from datetime import datetime

    from stratalake.sources import write_snapshots
    from stratalake.sources.snapshots import label_of, label_time
    from stratalake.streaming.incremental import newest_label

    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, zone)
    try:
        late, early = "2025-03-09T03-15", "2025-03-09T02-30"
        rows = [(1, datetime(2025, 3, 9, 2, 30, 59, 999999)), (2, datetime(2025, 3, 9, 3, 15)), (3, datetime(1969, 12, 31, 23, 59, 30))]
        df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
        instants = df.selectExpr("id", "timestamp_micros(unix_micros(cast(cast(ts as string) || ' UTC' as timestamp))) AS ts")
        want = [(1, early, "2025-03-09T00-00"), (2, late, "2025-03-09T00-00"), (3, "1969-12-31T23-59", "1969-12-31T00-00")]
        for frame in (df, instants):
            got = frame.select("id", label_of("ts").alias("m"), label_of("ts", grain="day").alias("d"))
            assert [tuple(r) for r in got.orderBy("id").collect()] == want
        write_snapshots(df.where("id < 3"), tmp_dir, label_of("ts"))
        schema = T.StructType.fromDDL("id int, ts timestamp_ntz")
        assert latest_snapshot_path(spark, tmp_dir).endswith(late)
        every = read_snapshots(spark, tmp_dir, schema)
        assert [r.dt_extraction for r in latest_snapshot(every, base=tmp_dir).collect()] == [late]
        assert newest_label(every) == late
        bad = spark.createDataFrame([("2025-02-30T00-00",), ("2025-01-01T24-00",), ("x",), (early + "-b",)], "l string")
        assert [r[0] for r in bad.select(label_time("l").isNotNull()).collect()] == [False, False, False, True]
    finally:
        spark.conf.set(key, before)


def test_current_label_format():
    from datetime import datetime

    assert current_label(datetime(2025, 6, 22, 15, 30, 59)) == "2025-06-22T15-30"


def test_write_read_latest(spark, tmp_dir):
    a = spark.createDataFrame([("1", "x", 1.0, 2.0)], SCHEMA)
    b = spark.createDataFrame([("2", "y", 3.0, 4.0), ("3", "z", None, None)], SCHEMA)
    p1 = write_snapshot(a, tmp_dir, "2024-01-01T00-00")
    write_snapshot(b, tmp_dir, "2024-01-02T00-00")
    assert p1.endswith("dt_extraction=2024-01-01T00-00")
    allrows = read_snapshots(spark, tmp_dir, SCHEMA)
    assert allrows.count() == 3
    assert allrows.schema["dt_extraction"].dataType == T.StringType()
    latest = read_latest_snapshot(spark, tmp_dir, SCHEMA)
    assert sorted(r.id for r in latest.collect()) == ["2", "3"]
    assert {r.dt_extraction for r in latest.collect()} == {"2024-01-02T00-00"}
    with pytest.raises(ValueError, match="base"):
        latest_snapshot(allrows)  # would read all the JSON
    sub = latest_snapshot(allrows, base=tmp_dir)
    assert sorted(r.id for r in sub.collect()) == ["2", "3"]
    # rewriting a label replaces only that snapshot
    write_snapshot(a, tmp_dir, "2024-01-02T00-00")
    assert sorted(r.id for r in read_snapshots(spark, tmp_dir, SCHEMA).collect()) == ["1", "1"]


def test_subquery_form_prunes_partitions(spark, tmp_dir):
    a = spark.createDataFrame([("1", "x", 1.0, 2.0)], SCHEMA)
    for day in ("2024-01-01T00-00", "2024-01-02T00-00", "2024-01-03T00-00"):
        write_snapshot(a, tmp_dir, day, fmt="parquet")
    df = read_snapshots(spark, tmp_dir, SCHEMA, fmt="parquet")
    q = latest_snapshot(df)
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    plan = buf.getvalue()
    outer = plan.split("===== Subqueries =====")[0]
    assert "PartitionFilters: [isnotnull(dt_extraction" in outer and "= Subquery subquery" in outer
    # the subqueries read only the partition column
    assert "ReadSchema: struct<>" in plan.split("===== Subqueries =====")[1]
    assert [r.dt_extraction for r in q.collect()] == ["2024-01-03T00-00"]


def test_empty_snapshot_refused(spark, tmp_dir):
    with pytest.raises(ValueError):
        write_snapshot(spark.createDataFrame([], SCHEMA), tmp_dir, "2024-01-01T00-00")


def test_json_microseconds_kept(spark, tmp_dir):
    from datetime import datetime

    ts = datetime(2024, 1, 1, 0, 14, 41, 845357)
    df = spark.createDataFrame([(1, ts)], "id int, ts timestamp_ntz")
    write_snapshot(df, tmp_dir, "2024-01-01T00-00")
    back = read_snapshots(spark, tmp_dir, T.StructType.fromDDL("id int, ts timestamp_ntz"))
    assert back.first().ts == ts


JSON_FIXTURE = [
    ('[{"id":"1","state":"x","latitude":1.5,"longitude":-200}]', [("1", "x", 1.5, -200.0)]),
    ('[{"id":2,"state":{"k":1},"latitude":"41.5","longitude":"NaN"}]', [("2", '{"k":1}', None, "nan")]),
    ('[{"id":"3","extra":9}]', [("3", None, None, None)]),
    ('[{"id":"1","latitude":NaN,"longitude":1e400}]', [("1", None, "nan", float("inf"))]),
    ('[{"id": "1", "state": ', [(None, None, None, None)]),
    ("[]", []),
]


@pytest.mark.parametrize("text,want", JSON_FIXTURE)
def test_json_schema_on_read(spark, tmp_dir, text, want):
    d = os.path.join(tmp_dir, "dt_extraction=2024-01-01T00-00")
    os.makedirs(d)
    with open(os.path.join(d, "data.json"), "w") as fh:
        fh.write(text)
    rows = read_snapshots(spark, tmp_dir, SCHEMA, multiline=True).drop("dt_extraction").collect()
    got = []
    for r in rows:
        vals = []
        for v in r:
            if isinstance(v, float) and v != v:
                vals.append("nan")
            else:
                vals.append(v)
        got.append(tuple(vals))
    assert got == want
    assert F  # keep import


@pytest.mark.parametrize("err", [PermissionError("denied"), OSError("device not ready")])
def test_listing_errors_propagate(spark, monkeypatch, err):
    """Errors other than "nothing found" while listing snapshots are raised unchanged."""
    from stratalake.sources import storage

    def boom(_spark, _path):
        raise err

    monkeypatch.setattr(storage, "list_names", boom)
    with pytest.raises(type(err), match=str(err)):
        latest_snapshot_path(spark, "/any/base")


def test_subquery_form_from_folder_names(spark, tmp_dir):
    """With ``base`` the newest label comes from folder names (no file is listed or read)."""
    import contextlib
    import io

    a = spark.createDataFrame([("1", "x", 1.0, 2.0)], SCHEMA)
    for label in ("2024-01-02T00-00", "2024-01-03T00-00-backup", "2024-01-03T00-00", "2024-13-01T00-00"):
        write_snapshot(a, tmp_dir, label)
    df = read_snapshots(spark, tmp_dir, SCHEMA)
    listed = latest_snapshot(df, base=tmp_dir)
    assert [r.dt_extraction for r in listed.collect()] == ["2024-01-03T00-00"]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        listed.explain("formatted")
    outer, subs = buf.getvalue().split("===== Subqueries =====")
    assert "= Subquery subquery" in outer
    assert "Scan json" not in subs and "Scan binaryFile" not in subs
