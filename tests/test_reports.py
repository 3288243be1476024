"""Kept reports: one for each version verified, and assertions that look back over them."""

import os

import pytest
from pyspark.sql import functions as F

from stratalake.operators import Check, Recent, VerificationError, verify
from stratalake.plans import kept_reports, publish, recent_means
from stratalake.sources import read_table, storage

SIZE = Check("c").has_size(Recent(lo=0.5, hi=2.0, last=2)).is_complete("id")


def rows(spark, n):
    return spark.range(n).withColumn("id", F.col("id").cast("string"))


def sizes(spark, reports, table):
    kept = kept_reports(spark, reports, table).where(F.col("constraint") == "Size(*)")
    return sorted(((r.number, r.metric, r.constraint_status) for r in kept.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_a_drop_is_rejected_and_kept(spark, tmp_dir):
    t, rep = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "rep")
    assert kept_reports(spark, rep).count() == 0
    for n in (10, 20):
        publish(rows(spark, n), t, [SIZE], reports=rep)
    for n in (7, 31):  # the mean is 15
        with pytest.raises(VerificationError, match=r"Size\(\*\)"):
            publish(rows(spark, n), t, [SIZE], reports=rep)
    assert read_table(spark, t).count() == 20
    publish(rows(spark, 8), t, [SIZE], reports=rep)
    publish(rows(spark, 7), t, [SIZE], reports=rep)  # the mean of 20 and 8 is 14
    ok, bad = "Success", "Failure"
    assert sizes(spark, rep, t) == [(1, 10.0, ok), (2, 20.0, ok), (3, 8.0, ok), (4, 7.0, ok), (None, 7.0, bad), (None, 31.0, bad)]
    means = {r["constraint"]: (r["mean"], r["versions"]) for r in recent_means(kept_reports(spark, rep, t), 3, before=4).collect()}
    assert means == {"Size(*)": (38 / 3, 3), "Completeness(id)": (1.0, 3)}


def test_reports_of_tables_stay_apart(spark, tmp_dir):
    rep = os.path.join(tmp_dir, "rep")
    for name, n in (("a=1/b %", 4), ("z", 400)):
        publish(rows(spark, n), os.path.join(tmp_dir, f"t{n}"), [SIZE], reports=rep, table_name=name)
    assert sizes(spark, rep, "a=1/b %") == [(1, 4.0, "Success")]
    assert sizes(spark, rep, "z") == [(1, 400.0, "Success")]
    assert kept_reports(spark, rep).count() == 4


def test_empty_versions_and_too_few_of_them(spark, tmp_dir):
    t, rep = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "rep")
    two = Check("c").has_size(Recent(lo=0.9, least=2))
    for n in (5, 0, 3):  # one version is too few; the mean of 5 and 0 is 2.5
        publish(rows(spark, n), t, [two], reports=rep)
    assert [s[:2] for s in sizes(spark, rep, t)] == [(1, 5.0), (2, 0.0), (3, 3.0)]


def test_without_kept_reports_there_is_nothing_to_look_back_on(spark, tmp_dir):
    with pytest.raises(ValueError, match="kept reports"):
        verify(rows(spark, 3), SIZE)
    t = os.path.join(tmp_dir, "t")
    with pytest.raises(ValueError, match="kept reports"):
        publish(rows(spark, 3), t, [SIZE])
    assert storage.current_version(spark, t) is None


def test_a_publish_that_dies_leaves_no_report_and_a_lost_one_is_passed_over(spark, tmp_dir, monkeypatch):
    t, rep = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "rep")
    publish(rows(spark, 10), t, [SIZE], reports=rep)
    promote, drop = storage.promote, "stratalake.plans.stages.drop_report"

    def fails(*a, **k):
        raise RuntimeError("no note")

    monkeypatch.setattr(storage, "promote", fails)
    with pytest.raises(RuntimeError, match="no note"):
        publish(rows(spark, 12), t, [SIZE], reports=rep)
    assert sizes(spark, rep, t) == [(1, 10.0, "Success")]
    with monkeypatch.context() as m:  # the driver died: nobody took the report back
        m.setattr(drop, lambda *a: None)
        with pytest.raises(RuntimeError, match="no note"):
            publish(rows(spark, 13), t, [SIZE], reports=rep)
    monkeypatch.setattr(storage, "promote", promote)
    drop_by = Check("c").has_size(Recent(hi=1.35)).is_complete("id")  # 14 is 1.4 times 10: the lost report is no version
    with pytest.raises(VerificationError):
        publish(rows(spark, 14), os.path.join(tmp_dir, "t"), [drop_by], reports=rep)
    publish(rows(spark, 14), t, [SIZE], reports=rep)
    assert sizes(spark, rep, t) == [(1, 10.0, "Success"), (2, 14.0, "Success"), (None, 14.0, "Failure")]


@pytest.mark.parametrize("mean, lo, hi, value, ok", [(10.0, 0.5, None, 5.0, True), (10.0, 0.5, None, 4.9, False), (-10.0, 0.5, 2.0, -20.0, True), (-10.0, 0.5, 2.0, -4.0, False), (None, 0.5, 2.0, 0.0, True)])
def test_bounds(mean, lo, hi, value, ok):
    assert Recent(lo=lo, hi=hi).bound(mean, 0 if mean is None else 3)(value) is ok
