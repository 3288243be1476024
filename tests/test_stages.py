"""Stages: source -> bronze -> silver -> gold, gating, incremental stream."""

import os

import pytest
from pyspark.sql import types as T

from stratalake.operators import Check, VerificationError
from stratalake.plans import EntityColumns, entity_checks, run_stage, to_bronze, to_gold, to_silver
from stratalake.sources import PagedReadError, read_table, write_snapshot
from stratalake.streaming import incremental_silver

COLS = EntityColumns(kind="venue_type")
SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "name", "venue_type", "country", "state")]
    + [T.StructField("longitude", T.FloatType()), T.StructField("latitude", T.FloatType())]
)
GOLD_SCHEMA = SCHEMA

ROWS = [
    {"id": "a1", "name": "A", "venue_type": "small", "country": "United States", "state": "new york",
     "longitude": -73.9, "latitude": 40.7},
    {"id": "b2", "name": "B", "venue_type": "small", "country": " United  States ", "state": "NEW  YORK",
     "longitude": 40.0, "latitude": -120.0},
    {"id": "c3", "name": "C", "venue_type": "pub", "country": "Brazil", "state": "  São paulo ",
     "longitude": 200.0, "latitude": 50.0},
    {"id": "d4", "name": "D", "venue_type": "small", "country": None, "state": None,
     "longitude": None, "latitude": None},
]


def tables(path):
    """Versions and notes under ``path``."""
    return [n for n in os.listdir(path) if not n.startswith(".")] if os.path.exists(path) else []


class Pages:
    def __init__(self, rows, per_page):
        self.rows, self.per_page = rows, per_page

    def __call__(self, page, per_page):
        return self.rows[(page - 1) * per_page: page * per_page]


def test_end_to_end(spark, tmp_dir):
    bronze, silver, gold = (os.path.join(tmp_dir, n) for n in ("bronze", "silver", "gold"))
    snap = to_bronze(spark, Pages(ROWS, 2), bronze, label="2025-06-22T15-30", per_page=2)
    assert snap.endswith("dt_extraction=2025-06-22T15-30")
    rep = to_silver(spark, bronze, silver, SCHEMA, cols=COLS)
    assert {r.constraint_status for r in rep.collect()} == {"Success"}
    s = {r.id: r for r in read_table(spark, silver, SCHEMA).collect()}
    assert (s["a1"].country, s["a1"].state) == ("UnitedStates", "NewYork")
    assert (s["b2"].country, s["b2"].state, s["b2"].latitude, s["b2"].longitude) == (
        "UnitedStates", "NewYork", 40.0, -120.0)
    assert (s["c3"].state, s["c3"].latitude, s["c3"].longitude) == ("SoPaulo", None, 50.0)
    assert (s["d4"].country, s["d4"].state) == ("unknown", "unknown")
    to_gold(spark, silver, gold, SCHEMA, keys=["country", "state", "venue_type"], alias="venue_count")
    g = {(r.country, r.state, r.venue_type): r.venue_count for r in read_table(spark, gold).collect()}
    assert g == {("UnitedStates", "NewYork", "small"): 2, ("Brazil", "SoPaulo", "pub"): 1,
                 ("unknown", "unknown", "small"): 1}


def test_sequential_mode(spark, tmp_dir):
    bronze, silver = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    write_snapshot(spark.createDataFrame([ROWS[1]], SCHEMA), bronze, "2024-01-01T00-00")
    to_silver(spark, bronze, silver, SCHEMA, cols=COLS, mode="sequential")
    r = read_table(spark, silver, SCHEMA).first()
    assert (r.latitude, r.longitude) == (40.0, 40.0)


def test_gate_blocks_publish(spark, tmp_dir):
    bronze, silver = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    dup = ROWS + [dict(ROWS[0])]
    write_snapshot(spark.createDataFrame(dup, SCHEMA), bronze, "2024-01-01T00-00")
    with pytest.raises(VerificationError, match="Uniqueness"):
        to_silver(spark, bronze, silver, SCHEMA, cols=COLS)
    assert not tables(silver)


def test_gate_blocks_publish_input_mode(spark, tmp_dir):
    bronze, silver = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    write_snapshot(spark.createDataFrame(ROWS + [dict(ROWS[0])], SCHEMA), bronze, "2024-01-01T00-00")
    with pytest.raises(VerificationError):
        to_silver(spark, bronze, silver, SCHEMA, cols=COLS, verify_on="input")
    assert not tables(silver)


def test_empty_label_reference_mode_fails_type_check_downstream(spark, tmp_dir):
    """With empty_as=None a '###' state becomes '' -> stored as NULL -> completeness fails."""
    bronze, silver = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    row = dict(ROWS[0], state="###")
    write_snapshot(spark.createDataFrame([row], SCHEMA), bronze, "2024-01-01T00-00")
    with pytest.raises(VerificationError, match="Completeness\\(state\\)"):
        to_silver(spark, bronze, silver, SCHEMA, cols=COLS, empty_as=None)
    to_silver(spark, bronze, silver, SCHEMA, cols=COLS)  # default maps '' to 'unknown'
    assert read_table(spark, silver, SCHEMA).first().state == "unknown"


def test_empty_source_refused(spark, tmp_dir):
    with pytest.raises(ValueError, match="No data"):
        to_bronze(spark, Pages([], 2), os.path.join(tmp_dir, "b"))


def test_run_stage_template(spark):
    calls = []
    out = run_stage(lambda: spark.range(3), [lambda d: d.selectExpr("id * 2 AS x")],
                    lambda d: calls.append(sorted(r.x for r in d.collect())) or "done")
    assert out == "done" and calls == [[0, 2, 4]]
    with pytest.raises(ZeroDivisionError):
        run_stage(lambda: 1 / 0, [], lambda d: None)
    loaded = []
    with pytest.raises(VerificationError):
        run_stage(lambda: spark.range(3), [], loaded.append, checks=[Check("c").satisfies("id > 0", "positive")])
    assert loaded == []
    run_stage(lambda: spark.range(3), [], loaded.append, checks=[Check("c").is_complete("id")])
    assert len(loaded) == 1


def test_failed_page_leaves_no_snapshot(spark, tmp_dir):
    class Broken(Pages):
        calls = 0

        def __call__(self, page, per_page):
            if page == 2 and not hasattr(self, "probed"):
                self.probed = True  # the driver's own copy answers once, the tasks' copies fail
            elif page == 2:
                raise ConnectionError("down")
            return super().__call__(page, per_page)

        def __getstate__(self):
            return {"rows": self.rows, "per_page": self.per_page, "probed": True}

    base = os.path.join(tmp_dir, "b")
    with pytest.raises(PagedReadError, match="page 2"):
        to_bronze(spark, Broken(ROWS, 1), base, per_page=1, retries=1, label="2025-01-01T00-00")
    assert not os.path.exists(os.path.join(base, "dt_extraction=2025-01-01T00-00"))


def test_incremental_picks_newest_and_skips_old(spark, tmp_dir):
    bronze, silver, ckpt = (os.path.join(tmp_dir, n) for n in ("b", "s", "c"))
    checks = [entity_checks(COLS)]
    write_snapshot(spark.createDataFrame(ROWS[:2], SCHEMA), bronze, "2024-01-01T00-00")
    write_snapshot(spark.createDataFrame(ROWS[1:], SCHEMA), bronze, "2024-01-02T00-00")
    assert incremental_silver(spark, bronze, silver, SCHEMA, ckpt, cols=COLS, checks=checks) == [
        "2024-01-02T00-00"]
    assert sorted(r.id for r in read_table(spark, silver, SCHEMA).collect()) == ["b2", "c3", "d4"]
    # nothing new -> nothing published
    assert incremental_silver(spark, bronze, silver, SCHEMA, ckpt, cols=COLS, checks=checks) == []
    # an older snapshot arriving late does not replace the table
    write_snapshot(spark.createDataFrame(ROWS[:1], SCHEMA), bronze, "2023-12-31T00-00")
    assert incremental_silver(spark, bronze, silver, SCHEMA, ckpt, cols=COLS, checks=checks) == []
    # a newer one does
    write_snapshot(spark.createDataFrame(ROWS[:1], SCHEMA), bronze, "2024-01-03T00-00")
    assert incremental_silver(spark, bronze, silver, SCHEMA, ckpt, cols=COLS, checks=checks) == [
        "2024-01-03T00-00"]
    assert [r.id for r in read_table(spark, silver, SCHEMA).collect()] == ["a1"]
    assert Check  # keep import


def test_command_line_stages(spark, tmp_dir):
    import json

    from stratalake.plans.jobs import run

    cfg = {layer: {"venues": {"fields": {f.name: f.dataType.simpleString() for f in SCHEMA.fields}}}
           for layer in ("silver", "gold")}
    cfg_path = os.path.join(tmp_dir, "tables.json")
    with open(cfg_path, "w") as fh:
        json.dump(cfg, fh)
    bronze, silver, gold = (os.path.join(tmp_dir, n) for n in ("b", "s", "g"))
    write_snapshot(spark.createDataFrame(ROWS, SCHEMA), bronze, "2024-01-01T00-00")
    common = ["--config", cfg_path, "--table", "venues", "--kind-col", "venue_type"]
    assert run(["silver", "--bronze", bronze, "--silver", silver, *common], spark) == 0
    assert run(["gold", "--silver", silver, "--gold", gold, "--alias", "venue_count", *common], spark) == 0
    assert read_table(spark, gold).count() == 3
    dup_bronze = os.path.join(tmp_dir, "b2")
    write_snapshot(spark.createDataFrame(ROWS + [ROWS[0]], SCHEMA), dup_bronze, "2024-01-01T00-00")
    assert run(["silver", "--bronze", dup_bronze, "--silver", silver, *common], spark) == 2
    # what a crashed publish left, removed from the command line
    from stratalake.sources import storage

    left = storage.new_version(gold)
    os.makedirs(left)
    assert run(["clean", "--path", gold], spark) == 0
    assert read_table(spark, gold).count() == 3 and not os.path.exists(left)


def test_silver_from_json_array_file(spark, tmp_dir):
    """Bronze written as one pretty-printed JSON array per snapshot, picked by file name."""
    import json

    bronze, silver = os.path.join(tmp_dir, "b"), os.path.join(tmp_dir, "s")
    for label, rows in (("2024-01-01T00-00", ROWS[:1]), ("2024-01-02T00-00", ROWS[:2])):
        d = os.path.join(bronze, f"dt_extraction={label}")
        os.makedirs(d)
        with open(os.path.join(d, "data.json"), "w") as fh:
            json.dump(rows, fh, indent=4)
        with open(os.path.join(d, "other.json"), "w") as fh:
            json.dump(ROWS[2:], fh, indent=4)
    to_silver(spark, bronze, silver, SCHEMA, cols=COLS, multiline=True, filename="data.json")
    assert sorted(r.id for r in read_table(spark, silver, SCHEMA).collect()) == ["a1", "b2"]


def test_incremental_never_publishes_a_partial_snapshot(spark, tmp_dir):
    """One file per micro-batch: the snapshot is still published whole."""
    bronze, silver, ckpt = (os.path.join(tmp_dir, n) for n in ("b", "s", "c"))
    df = spark.createDataFrame(ROWS[:3], SCHEMA).repartition(3)
    write_snapshot(df, bronze, "2024-01-05T00-00")
    files = [f for f in os.listdir(os.path.join(bronze, "dt_extraction=2024-01-05T00-00"))
             if f.endswith(".json")]
    assert len(files) >= 2
    out = incremental_silver(spark, bronze, silver, SCHEMA, ckpt, cols=COLS,
                             checks=[entity_checks(COLS)], max_files_per_trigger=1)
    assert set(out) == {"2024-01-05T00-00"}
    assert sorted(r.id for r in read_table(spark, silver, SCHEMA).collect()) == ["a1", "b2", "c3"]


@pytest.mark.parametrize("parts", [[], ["state"]])
def test_publish_empty_input_fails_gate_and_writes_nothing(spark, tmp_dir, parts):
    from stratalake.plans import publish

    empty = spark.createDataFrame([], "id string, state string").where("id IS NOT NULL")
    target = os.path.join(tmp_dir, "t")
    with pytest.raises(VerificationError, match="Completeness"):
        publish(empty, target, [Check("c").is_complete("id")], partition_cols=parts)
    assert not tables(target)


def test_command_line_bronze_from_url(spark, tmp_dir):
    import json

    from stratalake.plans.jobs import run

    pages = os.path.join(tmp_dir, "pages")
    os.makedirs(pages)
    for i, p in enumerate([ROWS[:2], ROWS[2:], []], start=1):
        with open(os.path.join(pages, f"{i}.json"), "w") as fh:
            json.dump(p, fh)
    bronze = os.path.join(tmp_dir, "b")
    assert run(["bronze", "--url", "file://" + pages + "/{page}.json", "--bronze", bronze,
                "--label", "2025-06-22T15-30", "--per-page", "2"], spark) == 0
    got = spark.read.schema(SCHEMA).json(os.path.join(bronze, "dt_extraction=2025-06-22T15-30"))
    assert sorted(r.id for r in got.collect()) == ["a1", "b2", "c3", "d4"]


def test_incremental_gate_failure_does_not_block_later_snapshots(spark, tmp_dir):
    """A snapshot that fails the gate is reported, not replayed forever: the next
    run publishes a newer good snapshot (as the batch silver job would)."""
    bronze, silver, ckpt = (os.path.join(tmp_dir, n) for n in ("b", "s", "c"))
    checks = [entity_checks(COLS)]
    write_snapshot(spark.createDataFrame(ROWS + [ROWS[0]], SCHEMA), bronze, "2024-01-01T00-00")
    with pytest.raises(VerificationError, match="Uniqueness"):
        incremental_silver(spark, bronze, silver, SCHEMA, ckpt, cols=COLS, checks=checks)
    assert not tables(silver)
    write_snapshot(spark.createDataFrame(ROWS[1:], SCHEMA), bronze, "2024-01-02T00-00")
    assert incremental_silver(spark, bronze, silver, SCHEMA, ckpt, cols=COLS, checks=checks) == [
        "2024-01-02T00-00"]
    assert sorted(r.id for r in read_table(spark, silver, SCHEMA).collect()) == ["b2", "c3", "d4"]


def test_incremental_marker_survives_a_crash_while_written(spark, tmp_dir):
    """If the driver dies while a marker is written, the one before it holds, so a
    late older snapshot still does not replace the table."""
    from stratalake.streaming.incremental import MARKER

    bronze, silver, ckpt = (os.path.join(tmp_dir, n) for n in ("b", "s", "c"))
    checks = [entity_checks(COLS)]
    write_snapshot(spark.createDataFrame(ROWS[1:], SCHEMA), bronze, "2024-01-02T00-00")
    assert incremental_silver(spark, bronze, silver, SCHEMA, ckpt, cols=COLS, checks=checks) == [
        "2024-01-02T00-00"]
    with open(os.path.join(ckpt, f"{MARKER}-000000002"), "w") as fh:
        fh.write("2024-0")
    write_snapshot(spark.createDataFrame(ROWS[:1], SCHEMA), bronze, "2023-12-31T00-00")
    assert incremental_silver(spark, bronze, silver, SCHEMA, ckpt, cols=COLS, checks=checks) == []
    assert sorted(r.id for r in read_table(spark, silver, SCHEMA).collect()) == ["b2", "c3", "d4"]


def test_command_line_incremental_silver(spark, tmp_dir):
    import json

    from stratalake.plans.jobs import run

    cfg = {"silver": {"venues": {"fields": {f.name: f.dataType.simpleString() for f in SCHEMA.fields}}}}
    cfg_path = os.path.join(tmp_dir, "tables.json")
    with open(cfg_path, "w") as fh:
        json.dump(cfg, fh)
    bronze, silver, ckpt = (os.path.join(tmp_dir, n) for n in ("b", "s", "c"))
    args = ["silver", "--bronze", bronze, "--silver", silver, "--config", cfg_path, "--table", "venues",
            "--kind-col", "venue_type", "--checkpoint", ckpt]
    write_snapshot(spark.createDataFrame(ROWS + [ROWS[0]], SCHEMA), bronze, "2024-01-01T00-00")
    assert run(args, spark) == 2  # duplicate id: gate blocks, reported once
    write_snapshot(spark.createDataFrame(ROWS[1:], SCHEMA), bronze, "2024-01-02T00-00")
    assert run(args, spark) == 0
    assert sorted(r.id for r in read_table(spark, silver, SCHEMA).collect()) == ["b2", "c3", "d4"]
    assert run(args, spark) == 0  # nothing new
