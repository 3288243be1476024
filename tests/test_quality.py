"""Data-quality constraints: one passing and one failing frame per constraint,
plus empty and all-NULL inputs, the report contract and the gate."""

import pytest

from stratalake.operators import Check, VerificationError, at_least, gate, type_histogram, verify
from stratalake.operators.quality import REPORT_SCHEMA

SCHEMA = "id string, state string, latitude double, flag boolean, n int"


@pytest.fixture(scope="module")
def good(spark):
    return spark.createDataFrame(
        [("a", "x", 1.5, True, 1), ("b", "y", -80.0, False, 2), ("c", "z", None, None, 3)], SCHEMA
    )


@pytest.fixture(scope="module")
def bad(spark):
    return spark.createDataFrame(
        [("1", None, 100.0, True, None), ("1", "12", 10.0, None, 2), (None, "2.5", 95.0, None, 3)], SCHEMA
    )


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def all_null(spark):
    return spark.createDataFrame([(None, None, None, None, None)] * 2, SCHEMA)


def metric(report, constraint):
    rows = [r for r in report.collect() if r.constraint == constraint]
    assert len(rows) == 1, constraint
    return rows[0]


def test_report_schema(good):
    rep = verify(good, Check("c").is_complete("id"))
    assert [(f.name, f.dataType) for f in rep.schema] == [(f.name, f.dataType) for f in REPORT_SCHEMA]


def test_completeness(good, bad, empty, all_null):
    chk = Check("c").is_complete("id")
    assert metric(verify(good, chk), "Completeness(id)").metric == 1.0
    r = metric(verify(bad, chk), "Completeness(id)")
    assert r.metric == pytest.approx(2 / 3) and r.constraint_status == "Failure"
    r = metric(verify(empty, chk), "Completeness(id)")
    assert r.metric is None and r.constraint_status == "Failure" and r.constraint_message.startswith("Empty")
    assert metric(verify(all_null, chk), "Completeness(id)").metric == 0.0


def test_uniqueness(good, bad, empty, all_null, spark):
    chk = Check("c").is_unique("id")
    assert metric(verify(good, chk), "Uniqueness(id)").constraint_status == "Success"
    # non-null ids: "1", "1" -> no value occurs once
    assert metric(verify(bad, chk), "Uniqueness(id)").metric == 0.0
    assert metric(verify(empty, chk), "Uniqueness(id)").metric is None
    assert metric(verify(all_null, chk), "Uniqueness(id)").metric is None
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "1"), ("b", None)], "x string, y string")
    r = metric(verify(df, Check("c").is_unique("x", "y")), "Uniqueness(x,y)")
    assert r.metric == pytest.approx(2 / 4)


def test_data_type_text_classes(spark):
    vals = ["1.5", "-2.", ".", " 3", "+7", "", "007", "true", "false", "True", "5.0E-5", "1.0E7", "abc", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    h = type_histogram(df, "s").first().asDict()
    # Fractional: 1.5 -2. . ; Integral: " 3" +7 "" 007 ; Boolean: true false ; String: True 5.0E-5 1.0E7 abc
    assert h == {"n_null": 1, "n_fractional": 3, "n_integral": 4, "n_boolean": 2, "n_string": 4}
    rep = verify(df, Check("t").has_data_type("s", "Numeric").has_data_type("s", "String"))
    assert metric(rep, "DataType(s,Numeric)").metric == pytest.approx(7 / 13)
    assert metric(rep, "DataType(s,String)").metric == pytest.approx(4 / 13)


def test_data_type_typed_columns(good, empty, all_null):
    chk = Check("t").has_data_type("latitude", "Numeric").has_data_type("n", "Integral") \
        .has_data_type("flag", "Boolean").has_data_type("state", "String")
    rep = verify(good, chk)
    assert {r.constraint: r.metric for r in rep.collect()} == {
        "DataType(latitude,Numeric)": 1.0, "DataType(n,Integral)": 1.0,
        "DataType(flag,Boolean)": 1.0, "DataType(state,String)": 1.0,
    }
    assert all(r.metric is None for r in verify(empty, chk).collect())
    assert all(r.metric == 0.0 for r in verify(all_null, chk).collect())


def test_compliance(good, bad, empty):
    pred = "latitude >= -90 AND latitude <= 90"
    strict = Check("c").satisfies(pred, "lat")
    lenient = Check("c").satisfies(pred, "lat", nulls="pass")
    assert metric(verify(good, strict), "Compliance(lat)").metric == pytest.approx(2 / 3)
    assert metric(verify(good, lenient), "Compliance(lat)").constraint_status == "Success"
    assert metric(verify(bad, lenient), "Compliance(lat)").metric == pytest.approx(1 / 3)
    assert metric(verify(empty, strict), "Compliance(lat)").metric is None


def test_assertions_bound_and_callable(good):
    pred = "latitude >= -90 AND latitude <= 90"
    lazy = verify(good, Check("c").satisfies(pred, "lat", assertion=at_least(0.5)))
    assert metric(lazy, "Compliance(lat)").constraint_status == "Success"
    # A callable runs on the driver over the metric; the vacuous range form always passes.
    vac = verify(good, Check("c").satisfies(pred, "lat", assertion=lambda r: -90 <= r <= 90))
    assert metric(vac, "Compliance(lat)").constraint_status == "Success"
    boom = verify(good, Check("c").is_complete("id", assertion=lambda r: 1 / 0))
    assert metric(boom, "Completeness(id)").constraint_status == "Failure"


def test_check_status_and_levels(bad):
    rep = verify(bad, Check("e").is_complete("id"), Check("w", level="Warning").is_complete("state"),
                 Check("ok").is_complete("n", assertion=at_least(0.5)))
    st = {r.check: r.check_status for r in rep.collect()}
    assert st == {"e": "Error", "w": "Warning", "ok": "Success"}


def test_gate(good, bad):
    gate(verify(good, Check("c").is_complete("id").is_unique("id")))
    gate(verify(bad, Check("w", level="Warning").is_complete("id")))  # warnings do not block
    with pytest.raises(VerificationError) as e:
        gate(verify(bad, Check("c").is_complete("id").is_unique("id")))
    assert {f["constraint"] for f in e.value.failures} == {"Completeness(id)", "Uniqueness(id)"}


def test_missing_column(good):
    with pytest.raises(ValueError, match="nope"):
        verify(good, Check("c").is_complete("nope"))


def test_single_scan_for_scan_metrics(spark):
    """Completeness / type / compliance metrics of all checks share one aggregate."""
    df = spark.range(100).selectExpr("CAST(id AS STRING) AS id", "id * 1.0 AS x")
    chk1 = Check("a").is_complete("id").has_data_type("id", "Numeric")
    chk2 = Check("b").satisfies("x > 3", "pos").has_data_type("x", "Numeric")
    plan = verify(df, chk1, chk2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
    assert "PythonUDF" not in plan


def test_observed_verification_matches_verify_and_sits_in_result_stage(spark, tmp_dir):
    from stratalake.operators.quality import ObservedVerification
    from stratalake.sources import read_table, write_partitioned

    df = spark.createDataFrame(
        [("a", "x", 1.5, True, 1), ("b", "x", 100.0, None, 2), ("b", None, None, None, None)], SCHEMA
    )
    chk = (Check("c").is_complete("id").is_unique("id").has_data_type("id", "String")
           .satisfies("latitude <= 90", "lat").is_complete("n", assertion=at_least(0.5)))
    ov = ObservedVerification(df, chk)
    write_partitioned(df, tmp_dir, ["id"], observe=ov.attach)
    got = sorted(tuple(r) for r in ov.report(read_table(spark, tmp_dir, df.schema)).collect())
    want = sorted(tuple(r) for r in verify(df, chk).collect())
    assert got == want
    fresh = ObservedVerification(df, chk)
    plan = fresh.attach(df.hint("rebalance", "id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange")  # metrics above the shuffle


def test_exchange_on_the_key_carries_only_key_and_count(spark):
    import re

    from .conftest import SF_SMALL

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    df = orders.selectExpr("o_orderkey AS id", "cast(o_orderkey % 7 as string) AS s", "o_totalprice AS x")
    chk = Check("c").is_unique("id").is_complete("s").has_data_type("s", "Numeric").satisfies("x >= 0", "x")
    m = verify(df, chk)
    plan = m._jdf.queryExecution().executedPlan().toString()
    on_key = [x for x in re.findall(r"Exchange hashpartitioning\(id.*\n.*HashAggregate\(keys=\[id.*", plan)]
    assert on_key, plan
    for x in on_key:
        functions = re.search(r"functions=\[([^\]]*)\]", x)[1]
        assert functions == "partial_count(1)", x
    got = {r.constraint: r.metric for r in m.collect()}
    assert got["Uniqueness(id)"] == 1.0 and got["DataType(s,Numeric)"] == 1.0 and got["Compliance(x)"] == 1.0


def test_checks_of_one_name_keep_their_own_status(bad):
    """Both ways of deciding agree: a check's status follows its own constraints only."""
    def both(assertion):
        one = Check("same").is_complete("id", **assertion)
        two = Check("same", level="Warning").satisfies("n > 0 OR n IS NULL", "n")
        return sorted((r.check_level, r.check_status, r.constraint_status) for r in verify(bad, one, two).collect())

    want = [("Error", "Error", "Failure"), ("Warning", "Success", "Success")]
    assert both({}) == want
    assert both({"assertion": lambda v: v == 1.0}) == want
