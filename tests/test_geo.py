"""Coordinate repair: truth table for atomic and sequential modes."""

import math

import pytest

from stratalake.operators import inversion_counts, inversion_flags, repair_coordinates

INF = float("inf")
NAN = float("nan")
N = None
# (lat, lon) -> inverted, atomic result, sequential result
CASES = [
    ((40, -75), False, (40, -75), (40, -75)),
    ((90, 180), False, (90, 180), (90, 180)),
    ((-90, -180), False, (-90, -180), (-90, -180)),
    ((-120, 40), True, (40, -120), (40, 40)),
    ((120, 40), True, (40, 120), (40, 40)),
    ((200, 50), True, (50, N), (50, 50)),
    ((-100, -90), True, (-90, -100), (-90, -90)),
    ((50, 200), True, (N, 50), (N, N)),
    ((40, -200), True, (N, 40), (N, N)),
    ((120, 200), True, (N, 120), (N, N)),
    ((100, 150), False, (N, 150), (N, 150)),
    ((170, -170), False, (N, -170), (N, -170)),
    ((200, 100), False, (N, 100), (N, 100)),
    ((200, 200), False, (N, N), (N, N)),
    ((N, 40), None, (N, 40), (N, 40)),
    ((N, 200), None, (N, N), (N, N)),
    ((95, N), None, (N, N), (N, N)),
    ((NAN, 40), True, (40, N), (40, 40)),
    ((INF, 40), True, (40, N), (40, 40)),
    ((-INF, 40), True, (40, N), (40, 40)),
    ((40, NAN), True, (N, 40), (N, N)),
]


@pytest.fixture(scope="module")
def geo(spark):
    rows = [(i, *(None if v is None else float(v) for v in c[0])) for i, c in enumerate(CASES)]
    return spark.createDataFrame(rows, "i int, latitude float, longitude float")


def _eq(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(b):
        return math.isnan(a)
    return a == pytest.approx(b)


@pytest.mark.parametrize("mode,idx", [("atomic", 2), ("sequential", 3)])
def test_truth_table(geo, mode, idx):
    out = {r.i: (r.latitude, r.longitude) for r in repair_coordinates(geo, mode=mode).collect()}
    for i, case in enumerate(CASES):
        want = case[idx]
        got = out[i]
        assert _eq(got[0], want[0]) and _eq(got[1], want[1]), (case[0], mode, got, want)


def test_inverted_flag(geo):
    out = {r.i: r.inverted for r in inversion_flags(geo).collect()}
    assert [out[i] for i in range(len(CASES))] == [c[1] for c in CASES]


def test_types_preserved(geo):
    out = repair_coordinates(geo)
    assert dict(out.dtypes) == {"i": "int", "latitude": "float", "longitude": "float"}


def test_counts(geo):
    got = {r.inverted: r.n_rows for r in inversion_counts(geo).collect()}
    assert got == {True: 11, False: 7, None: 3}


def test_atomic_is_one_projection(spark):
    df = spark.range(100).selectExpr("id", "CAST(id * 3 - 150 AS DOUBLE) AS latitude",
                                     "CAST(id * 5 - 250 AS DOUBLE) AS longitude")
    base = df._jdf.queryExecution().optimizedPlan().toString().count("Project")
    plan = repair_coordinates(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == base + 1
    physical = repair_coordinates(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in physical


def test_bad_mode(geo):
    with pytest.raises(ValueError):
        repair_coordinates(geo, mode="other")


def test_missing_column(spark):
    df = spark.createDataFrame([(1.0,)], "latitude double")
    with pytest.raises(ValueError, match="longitude"):
        repair_coordinates(df)
