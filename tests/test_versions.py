"""Publishing some partitions, sharing unchanged ones, change sets, and gold that follows silver."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators import Check, VerificationError, changed_partitions, distinct_rollup, rollup_on_changes, row_changes
from stratalake.plans import stages
from stratalake.plans.stages import publish
from stratalake.sources import storage
from stratalake.sources.sinks import read_table
from stratalake.streaming import gold as gold_module
from stratalake.streaming import incremental_gold

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "kind", "country", "state")])
BY = ["country", "state"]
ROWS = [("1", "a", "us", "x"), ("2", "b", "us", "x"), ("3", "a", "us", "y z/=%+é"), ("4", None, "de", None), ("5", "a", None, "w"), ("5", "c", "fr", "w")]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*SCHEMA.names).collect()), key=str)


def folders(path):
    return {n for n in os.listdir(path) if n.startswith("v-")}


def test_dynamic_replaces_only_its_partitions(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    publish(frame(spark, ROWS), t, [], partition_cols=BY)
    first = storage.current_version(spark, t)
    planned = read_table(spark, t, SCHEMA)
    new = [("9", "z", "us", "y z/=%+é"), ("8", "z", None, "w"), ("7", "z", "it", "n")]
    publish(frame(spark, new), t, [Check("c").is_unique("id")], partition_cols=BY, overwrite="dynamic")
    want = [r for r in ROWS if r[2:] not in {n[2:] for n in new}] + new
    assert rows_of(read_table(spark, t, SCHEMA)) == sorted(want, key=str)
    assert rows_of(planned) == sorted(ROWS, key=str)  # the version before, whole
    now = storage.current_version(spark, t)
    assert len(now.parts) == 2 and first.folder in now.parts
    # again and again: folders go as nothing needs them, shared ones stay
    for k in range(4):
        publish(frame(spark, [(f"n{k}", "z", "us", "x")]), t, [], partition_cols=BY, overwrite="dynamic")
    want = [r for r in want if r[2:] != ("us", "x")] + [("n3", "z", "us", "x")]
    assert rows_of(read_table(spark, t, SCHEMA)) == sorted(want, key=str)
    assert len(folders(t)) == 4  # first, second, current, previous
    assert storage.clean_table(spark, t) == []
    publish(frame(spark, ROWS[:1]), t, [], partition_cols=BY)
    publish(frame(spark, ROWS[:2]), t, [])
    assert rows_of(read_table(spark, t, SCHEMA)) == sorted(ROWS[:2], key=str) and len(folders(t)) == 2
    with pytest.raises(ValueError, match="not partitioned that way"):
        publish(frame(spark, ROWS), t, [], partition_cols=BY, overwrite="dynamic")
    with pytest.raises(ValueError, match="overwrite"):
        publish(frame(spark, ROWS), t, [], partition_cols=BY, overwrite="some")


def test_dynamic_onto_nothing_and_of_nothing(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    publish(frame(spark, ROWS), t, [], partition_cols=BY, overwrite="dynamic")
    publish(frame(spark, []), t, [], partition_cols=BY, overwrite="dynamic")
    assert rows_of(read_table(spark, t, SCHEMA)) == sorted(ROWS, key=str)
    publish(frame(spark, []), t, [], partition_cols=BY, overwrite="changed")
    assert rows_of(read_table(spark, t, SCHEMA)) == []


def test_uniqueness_is_that_of_the_whole_table(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    publish(frame(spark, ROWS[:4]), t, [], partition_cols=BY)
    before = folders(t)
    with pytest.raises(VerificationError):
        publish(frame(spark, [("1", "z", "it", "n")]), t, [Check("c").is_unique("id")], partition_cols=BY, overwrite="dynamic")
    assert folders(t) == before and rows_of(read_table(spark, t, SCHEMA)) == sorted(ROWS[:4], key=str)


@pytest.mark.parametrize("overwrite", ["static", "dynamic", "changed"])
def test_a_crash_before_the_note_changes_nothing(spark, tmp_dir, monkeypatch, overwrite):
    t = os.path.join(tmp_dir, "t")
    publish(frame(spark, ROWS), t, [], partition_cols=BY)
    before = folders(t)

    def die(*a, **k):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(storage, "write_note", die)
        with pytest.raises(KeyboardInterrupt):
            publish(frame(spark, ROWS[:1]), t, [], partition_cols=BY, overwrite=overwrite)
    assert rows_of(read_table(spark, t, SCHEMA)) == sorted(ROWS, key=str) and folders(t) == before


def test_a_publish_that_came_between_wins(spark, tmp_dir, monkeypatch):
    t = os.path.join(tmp_dir, "t")
    publish(frame(spark, ROWS), t, [], partition_cols=BY)
    write = stages._write

    def meanwhile(*a, **k):
        monkeypatch.setattr(stages, "_write", write)
        publish(frame(spark, ROWS[:2]), t, [], partition_cols=BY)
        write(*a, **k)

    monkeypatch.setattr(stages, "_write", meanwhile)
    with pytest.raises(RuntimeError, match="meanwhile"):
        publish(frame(spark, ROWS[3:]), t, [], partition_cols=BY, overwrite="dynamic")
    assert rows_of(read_table(spark, t, SCHEMA)) == sorted(ROWS[:2], key=str)


def test_unchanged_partitions_keep_their_files(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")

    def put(rows):
        publish(frame(spark, rows).repartition(3), t, [Check("c").is_complete("id")], partition_cols=BY, overwrite="changed")
        assert rows_of(read_table(spark, t, SCHEMA)) == sorted(rows, key=str)
        return storage.current_version(spark, t)

    a = put(ROWS)
    b = put(ROWS[::-1])
    assert b.where() == a.where() and len(folders(t)) == 1  # nothing new is left behind
    c = put([("1", "changed", "us", "x"), *ROWS[1:4], ROWS[5], ("6", "a", "it", "n")])
    gone, came = changed_partitions(b, c)
    assert {len(gone), len(came)} == {2} and len(gone & came) == 1
    files = read_table(spark, t, SCHEMA, version=c, only=came).inputFiles()
    assert files and all(c.folder in f for f in files)
    assert set(c.parts[c.folder]) == came


def test_row_changes(spark):
    a = frame(spark, [*ROWS, ROWS[0], ROWS[3]])
    b = frame(spark, [*ROWS[1:], ("9", None, None, None)])
    got = {tuple(r) for r in row_changes(a, b, SCHEMA.names).collect()}
    assert got == {(*ROWS[0], -2), (*ROWS[3], -1), ("9", None, None, None, 1)}
    got = {tuple(r) for r in row_changes(a, b, SCHEMA.names, distinct=True).collect()}
    assert got == {(*ROWS[0], -1), ("9", None, None, None, 1)}


def versions(seed):
    rng = random.Random(seed)
    rows = [(str(rng.randrange(60)), rng.choice("abc"), rng.choice(["us", "de", None]), rng.choice("xyz")) for _ in range(150)]
    yield rows
    rows = [r for r in rows if r[3] != "z"] + [("new", "a", "us", "x"), ("n2", "d", "it", "v")]
    yield rows
    yield [(r[0], "b" if r[2] == "de" else r[1], *r[2:]) for r in rows][:-20] + rows[:3]


@pytest.mark.parametrize("keys", [["country", "state", "kind"], ["kind"], ["state", "country"]])
def test_counting_changes_equals_counting_all(spark, tmp_dir, keys):
    t = os.path.join(tmp_dir, "t")
    counted, old = None, None
    for rows in versions(1):
        publish(frame(spark, rows), t, [], partition_cols=BY, overwrite="changed")
        new = storage.current_version(spark, t)
        want = sorted(map(tuple, distinct_rollup(frame(spark, rows), keys, "id", "n").collect()), key=str)
        if old is not None:
            got = gold_module.counted_on_changes(spark, t, SCHEMA, old, new, counted, keys, "id", "n", BY)
            assert sorted(map(tuple, got.collect()), key=str) == want
            shared = set(old.where().items()) & set(new.where().items())
            if len(keys) > 1 and shared:  # partitions that both versions share are not read
                read = {"/".join(f.split("/")[-4:-1]) for f in got.inputFiles()}
                assert not read & {f"{folder}/{d}" for d, folder in shared}
        counted, old = spark.createDataFrame(want, ", ".join(f"{k} string" for k in keys) + ", n long"), new
    plain = rollup_on_changes(counted, frame(spark, rows), frame(spark, ROWS), frame(spark, ROWS), keys, "id", "n")
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, distinct_rollup(frame(spark, ROWS), keys, "id", "n").collect()), key=str)


def gold_run(spark, tmp_dir, **kw):
    s, g, c = (os.path.join(tmp_dir, n) for n in ("silver", "gold", "ckpt"))
    kw = {"checks": [], **kw}
    done = incremental_gold(spark, s, g, SCHEMA, c, alias="n", **kw)
    return done, sorted(map(tuple, read_table(spark, g).collect()), key=str) if storage.exists(spark, g) else None


def full(spark, rows):
    return sorted(map(tuple, distinct_rollup(frame(spark, rows), ["country", "state", "kind"], "id", "n").collect()), key=str)


def test_gold_follows_silver(spark, tmp_dir, monkeypatch):
    s = os.path.join(tmp_dir, "silver")
    assert gold_run(spark, tmp_dir) == ([], None)
    used = []
    counts = gold_module.counted_on_changes
    monkeypatch.setattr(gold_module, "counted_on_changes", lambda *a: used.append(1) or counts(*a))
    rows = list(versions(2))
    for k, r in enumerate(rows):
        publish(frame(spark, r), s, [], partition_cols=BY, overwrite="changed")
        assert gold_run(spark, tmp_dir) == ([k + 1], full(spark, r))
        gold = storage.current_version(spark, os.path.join(tmp_dir, "gold"))
        assert gold_run(spark, tmp_dir) == ([], full(spark, r))  # nothing new, nothing published
        assert storage.current_version(spark, os.path.join(tmp_dir, "gold")) == gold
    assert len(used) == 2
    # several publishes, one of them lost its log entry in a crash: the newest counts
    for r in (rows[0], rows[1]):
        publish(frame(spark, r), s, [], partition_cols=BY)
    os.remove(os.path.join(s, "_log", "000000005.json"))
    assert gold_run(spark, tmp_dir) == ([5], full(spark, rows[1]))
    # gold published by someone else is not built upon
    publish(spark.createDataFrame([("us", "x", "q", 99)], "country string, state string, kind string, n long"), os.path.join(tmp_dir, "gold"), [])
    publish(frame(spark, rows[2]), s, [], partition_cols=BY, overwrite="changed")
    n = len(used)
    assert gold_run(spark, tmp_dir) == ([6], full(spark, rows[2])) and len(used) == n


def test_a_version_published_meanwhile_is_not_mixed_in(spark, tmp_dir, monkeypatch):
    s = os.path.join(tmp_dir, "silver")
    rows = list(versions(3))
    publish(frame(spark, rows[0]), s, [], partition_cols=BY)

    def meanwhile(df, *a, **k):
        monkeypatch.setattr(gold_module, "publish", publish)
        for r in (*rows[1:], rows[1]):  # more versions than are kept, had the one counted not been pinned
            publish(frame(spark, r), s, [], partition_cols=BY)
        return publish(df, *a, **k)

    monkeypatch.setattr(gold_module, "publish", meanwhile)
    assert gold_run(spark, tmp_dir) == ([1], full(spark, rows[0]))
    assert len(folders(s)) == 3  # pinned, current, previous
    assert gold_run(spark, tmp_dir) == ([4], full(spark, rows[1]))
    assert len(folders(s)) == 2


def test_a_rejected_rollup_leaves_gold(spark, tmp_dir):
    s = os.path.join(tmp_dir, "silver")
    publish(frame(spark, ROWS[:2]), s, [], partition_cols=BY)
    checks = [Check("c").satisfies("n < 2", "small")]
    assert gold_run(spark, tmp_dir, checks=checks) == ([1], full(spark, ROWS[:2]))
    publish(frame(spark, [*ROWS, ("7", "a", "us", "x")]), s, [], partition_cols=BY)
    with pytest.raises(VerificationError):
        gold_run(spark, tmp_dir, checks=checks)
    assert gold_run(spark, tmp_dir, checks=checks) == ([], full(spark, ROWS[:2]))  # not retried
    publish(frame(spark, ROWS[1:]), s, [], partition_cols=BY)
    assert gold_run(spark, tmp_dir, checks=checks) == ([3], full(spark, ROWS[1:]))


def test_several_consumers_pin_for_themselves(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    held = []
    for k in range(5):
        publish(frame(spark, ROWS[: k + 1]), t, [], partition_cols=BY)
        if k in (0, 1):
            held.append(storage.current_version(spark, t))
            storage.pin(spark, t, f"c{k}", [held[-1]])
    assert len(folders(t)) == 4
    assert rows_of(read_table(spark, t, SCHEMA, version=held[0])) == rows_of(frame(spark, ROWS[:1]))
    assert storage.clean_table(spark, t) == []
    storage.pin(spark, t, "c0")
    assert len(folders(t)) == 3 and not storage.version_exists(spark, t, held[0])


def test_row_digests_see_every_column(spark, tmp_dir):
    t = os.path.join(tmp_dir, "t")
    schema = "id string, x double, tags array<string>, p int"
    for tags in (["a", "b"], ["a", "b"], ["ab"], None):
        publish(spark.createDataFrame([("1", float("nan"), tags, 3), ("2", None, [], None)], schema), t, [], partition_cols=["p"], overwrite="changed")
    v = storage.current_version(spark, t)
    assert len(v.parts) == 2  # p=3 changed at last, p=null never
    assert read_table(spark, t, v and T.StructType.fromDDL(schema)).where(F.col("p").isNull()).count() == 1
